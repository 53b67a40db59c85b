"""Subject-predicate-object triples from documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.functions.text import clean_string, iri, journal_id, project_year

GRAPH = "http://example.org/graph"
#: Types of literals; 'iri' stands for a node.
TYPES = ("string", "integer", "int", "dateTime", "iri")


def attributes(df: DataFrame, kind: str, key: str, fields: dict[str, tuple[str, str]], graph: str = GRAPH) -> DataFrame:
    """G1, G4. (s, p, o, o_type) of the columns of ``df``: {column: (predicate, type)}, and the type triple. A missing value gives no triple."""
    s = iri(graph, kind.lower(), F.col(key).cast("string"))
    own = [F.struct(F.lit("a").alias("p"), F.lit(f"<{graph}#{kind}>").alias("o"), F.lit("iri").alias("o_type"))]
    own += [F.struct(F.lit(f"<{graph}#{p}>").alias("p"), F.col(c).cast("string").alias("o"), F.lit(t).alias("o_type")) for c, (p, t) in fields.items()]
    return df.select(s.alias("s"), F.inline(F.array(*own))).where("o is not null")


def multi_valued(df: DataFrame, subject: Column, predicate: str, values: Column, kind: str = "string", graph: str = GRAPH) -> DataFrame:
    """G2, G5, G6. One triple for each distinct value of an array."""
    return df.select(subject.alias("s"), F.explode(F.array_distinct(values)).alias("o")).where("o is not null").select("s", F.lit(f"<{graph}#{predicate}>").alias("p"), F.col("o").cast("string").alias("o"), F.lit(kind).alias("o_type"))


def links(df: DataFrame, kind: str, key: str, predicate: str, targets: Column, target_kind: str, graph: str = GRAPH) -> DataFrame:
    """G3. One triple for each linked document."""
    ids = df.select(iri(graph, kind.lower(), F.col(key).cast("string")).alias("s"), F.explode(targets).alias("t"))
    return ids.select("s", F.lit(f"<{graph}#{predicate}>").alias("p"), iri(graph, target_kind.lower(), F.col("t").cast("string")).alias("o"), F.lit("iri").alias("o_type"))


def _typed(nodes: DataFrame, node: Column, kind: str, graph: str) -> DataFrame:
    return nodes.select(node.alias("s"), F.lit("a").alias("p"), F.lit(f"<{graph}#{kind}>").alias("o"), F.lit("iri").alias("o_type")).distinct()


def _linked(rows: DataFrame, s: Column, predicate: str, o: Column, kind: str = "iri", graph: str = GRAPH) -> DataFrame:
    return rows.select(s.alias("s"), F.lit(f"<{graph}#{predicate}>").alias("p"), o.alias("o"), F.lit(kind).alias("o_type"))


def journal_issues(df: DataFrame, document: Column, issues: Column, graph: str = GRAPH) -> DataFrame:
    """G2, F14. Five triples for each of the (title, volume, year) in ``issues``: type, title, volume, year, and the document that it contains. What is missing gives no triple."""
    rows = df.select(document.alias("doc"), F.explode(F.array_distinct(issues)).alias("j")).select("doc", "j.*")
    node = iri(graph, "journal_issue", journal_id(F.col("title"), F.col("volume"), F.col("year")))
    own = [("a", F.lit(f"<{graph}#JournalIssue>"), "iri"), (f"<{graph}#containsPublication>", F.col("doc"), "iri")]
    own += [(f"<{graph}#has{c.title()}>", F.col(c), "string") for c in ("title", "volume", "year")]
    return rows.select(node.alias("s"), F.inline(F.array(*(F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(t).alias("o_type")) for p, o, t in own)))).where("o is not null").distinct()


def content(df: DataFrame, key: str, names: Column, graph: str = GRAPH) -> DataFrame:
    """G5. For (family, name) entries of a document: its content node of each family, and the samples that it mentions."""
    e = df.select(F.col(key).cast("string").alias("k"), F.explode(names).alias("d")).select("k", "d.family", "d.name").distinct()
    document = iri(graph, "document", F.col("k"))
    node = iri(graph, "document", F.concat("k", F.lit("/"), "family", F.lit("_datasets")))
    sample = iri(graph, "datasample", F.col("name"))
    has = _linked(e, document, "hasContent", node, graph=graph).distinct()
    return has.union(_typed(e, node, "DocumentContent", graph)).union(_typed(e, sample, "DataSample", graph)).union(_linked(e, node, "mentionsDataSample", sample, graph=graph))


def fact_content(df: DataFrame, key: str, facts: dict[str, Column], graph: str = GRAPH) -> DataFrame:
    """G6, F21. The node of a document's plain text with the years, luminosity, energy and campaigns that it mentions (``text.facts``). Spaces of a luminosity become '_', an energy is written small and without spaces."""
    e = df.select(F.col(key).cast("string").alias("k"), *(facts[c].alias(c) for c in ("years", "luminosity", "energy", "campaigns")))
    document, node = iri(graph, "document", F.col("k")), iri(graph, "document", F.concat("k", F.lit("/plain_text")))
    luminosity = iri(graph, "luminosity", F.replace(F.col("luminosity"), F.lit(" "), F.lit("_")))
    energy = F.concat(F.lit(f"<{graph}#"), F.lower(F.replace(F.col("energy"), F.lit(" "), F.lit(""))), F.lit(">"))
    name = lambda x: F.lit(f"<{graph}#{x}>")
    triple = lambda s, p, o, t="iri": F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit(t).alias("o_type"))
    typed = lambda s, kind: triple(s, F.lit("a"), name(kind))
    of_campaign = lambda c: iri(graph, "campaign", c)
    own = F.array(
        triple(document, name("hasContent"), node), typed(node, "DocumentContent"), typed(luminosity, "Luminosity"),
        triple(node, name("mentionsLuminosity"), luminosity), triple(node, name("mentionsEnergy"), energy),
    )
    lists = F.transform("years", lambda y: triple(node, name("mentionsDataTakingYear"), y, "string")), F.transform("campaigns", lambda c: typed(of_campaign(c), "Campaign")), F.transform("campaigns", lambda c: triple(node, name("mentionsCampaign"), of_campaign(c)))
    # the texts are searched once; what has a null part is not known
    rows = e.select(F.inline(F.concat(own, *(F.coalesce(x, F.slice(own, 1, 0)) for x in lists))))
    return rows.where("s is not null and o is not null").distinct()


def data_periods(df: DataFrame, graph: str = GRAPH) -> DataFrame:
    """G7, F22, F23, S29. Triples of data periods (period, periodLevel, projectName, description, status); a project's own triples come once."""
    key = F.concat_ws("_", "projectName", "period")
    rows = df.withColumns({"_key": key, "_year": project_year("projectName"), "_text": F.replace(F.col("description"), F.lit("\n"), F.lit(" "))})
    fields = {"period": ("hasPeriod", "string"), "periodLevel": ("hasLevel", "string"), "_text": ("hasDescription", "string"), "status": ("hasStatus", "string"), "_year": ("hasYear", "integer")}
    projects = df.select("projectName").distinct()
    return attributes(rows, "DataPeriod", "_key", fields, graph).union(links(rows, "DataPeriod", "_key", "isPartOf", F.array("projectName"), "Project", graph)).union(attributes(projects, "Project", "projectName", {"projectName": ("hasName", "string")}, graph))


def listed_entities(lines: DataFrame, kind: str, graph: str = GRAPH) -> DataFrame:
    """G8, S28. Entities of a text list (value), one a line; lines that begin with # are remarks."""
    named = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.trim("value").alias("name")).distinct()
    return attributes(named, kind, "name", {"name": ("hasName", "string")}, graph)


def turtle(triples: DataFrame) -> DataFrame:
    """The triples as lines 's p o .'."""
    literal = F.concat(F.lit('"'), clean_string("o"), F.lit('"'), F.when(F.col("o_type") == "string", F.lit("")).otherwise(F.concat(F.lit("^^xsd:"), F.col("o_type"))))
    return triples.select(F.concat_ws(" ", "s", "p", F.when(F.col("o_type") == "iri", F.col("o")).otherwise(literal), F.lit(".")).alias("value"))
