"""Text of papers and their metadata (F13-F30, A30, J-1 to J-6)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taskspire.functions.names import as_column
from taskspire.functions.times import years

# The patterns of facts in a paper's text.
CAMPAIGN = r"(mc11(?![abc])|mc11[abc]|mc12(?![ab])|mc12[ab]|pro1[045]|repro0[389]|repro1[4-9]|repro20|repro04_v1|repro05_v2|t0pro0[089]|t0pro1[1234579]|t0pro20|t0pro04_v1|t0proc03_v1)"
ENERGY = r"(\d+\.?\d*) (G|T)eV"
LUMINOSITY = r"(\d+\.?\d*) ?(m|n|p|f)b(?:−|\(cid:0\))1"
COLLISIONS = r"(proton-proton|heavy-ion|pp) collisions"
YEAR = r"(?s)(?:acquired|collected|measured|recorded).{0,100}?(20\d\d((\+|-| and )20\d\d)?)"
PAPER_NAME = r"[A-Z0-9-]+-20\d\d-[A-Z0-9-]+"
LINK, LINK_HOST = r"(.*)\n? ?(https?://{host}/record/\d+)", "cds.cern.ch"
INTERVAL = r"\[(?:[0-9][\\/][0-9\\/\n]+|[0-9]+-[0-9]+)\]"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
# Families of dataset names, in the order in which they are sought; verbose patterns.
FAMILIES = {
    "montecarlo": r"mc\d\d \n*_\n* [a-zA-Z\d!]+ \n*\.\n* [\dINTERVAL!]+ (\n*[._]\n*[a-zA-Z\d\-:!]+)+ (\n*_\n*[a-z]\d+)+ (_tid\d+(_\d\d)?)?",
    "physcont": r"[a-zA-Z\d\-_\.:!]+ \n*\.\n* PhysCont \n*\.\n* [a-zA-Z\d\-_\.:!]+ \n*\.\n* [t0proge]+\d\d_v?\d\d (\n*_\n*[a-z]\d+)*",
    "calibration": r"data\d\d_calib \n*\.\n* [\dINTERVAL!]+ \n*\.\n* [a-zA-Z\d\-_\.:!]+ \n*\.\n* RAW",
    "realdata": r"data\d\d \n*_\n* [a-zA-Z\d!]+ \n*\.\n* [\dINTERVAL!]+ \n*\.\n* [a-zA-Z\d\-_\.:!]+",
    "database": r"ddo \n*\.\n* [\dINTERVAL!]+ \n*\.\n* [a-zA-Z\d\-_\.:!]+",
}


def found(text: Column, pattern: str, group: int) -> Column:
    """The first match's group, or null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def clean_string(c: Column | str) -> Column:
    """F13. ASCII only, quotes escaped or removed, newlines and backslashes escaped: for a literal in quotes."""
    c = F.regexp_replace(as_column(c), r"[^\x00-\x7F]", "")
    for old, new in (("\\", "\\\\"), ("\n", "\\n"), ("'", "\\'"), ('"', "")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def journal_id(title: Column, volume: Column, year: Column) -> Column:
    """F14. The known parts joined by '_', without spaces."""
    return F.replace(F.concat_ws("_", title, volume, year), F.lit(" "), F.lit(""))


def iri(graph: str, kind: str, key: Column) -> Column:
    """F15."""
    return F.concat(F.lit(f"<{graph}/{kind}/"), key, F.lit(">"))


def first_starting(codes: Column, prefix: str) -> Column:
    """F16, F17. The first element that begins with ``prefix``."""
    return F.get(F.filter(codes, lambda x: x.startswith(prefix)), F.lit(0))


def keywords(text: Column) -> Column:
    """F18."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x))


def without_ligatures(c: Column | str) -> Column:
    """F25."""
    c = as_column(c)
    for old, new in LIGATURES.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def project_year(project: Column | str) -> Column:
    """F22. '20' and the first two digits of a project's name."""
    digits = found(as_column(project), r"(\d\d)", 1)
    return F.when(digits.isNotNull(), F.concat(F.lit("20"), digits))


def facts(text: Column | str, first_pages: Column | str) -> dict[str, Column]:
    """F26, A30, D7, F30. Campaigns, energy, luminosity, collisions, years, the paper's name, and the projects that follow from them. What isn't found is null."""
    text, pages = as_column(text), as_column(first_pages)
    campaigns = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(CAMPAIGN), F.lit(1))))
    energy = found(pages, ENERGY, 0)
    collisions = found(F.lower(pages), COLLISIONS, 1)
    taken = years(found(text, YEAR, 1))
    short = F.replace(energy, F.lit(" "), F.lit(""))
    simulated = F.get(F.filter(campaigns, lambda c: c.startswith("mc")), F.lit(0))
    return {
        "campaigns": campaigns,
        "energy": energy,
        "luminosity": F.replace(F.replace(found(pages, LUMINOSITY, 0), F.lit("−"), F.lit("-")), F.lit("(cid:0)"), F.lit("-")),
        "collisions": F.when(collisions == "pp", "proton-proton").otherwise(collisions),
        "years": taken,
        "paper_name": found(pages, PAPER_NAME, 0),
        "links": links(pages),
        "project_simulated": F.when(simulated.isNotNull() & short.isNotNull(), F.concat_ws("_", simulated, short)),
        "projects_real": F.when(short.isNotNull(), F.transform(taken, lambda y: F.concat(F.lit("data"), F.substring(y, 3, 2), F.lit("_"), short))),
    }


def links(pages: Column, host: str = LINK_HOST) -> Column:
    """The titles and addresses of linked records of a host; of equal titles the last counts."""
    pattern = LINK.format(host=re.escape(host))
    names, urls = (F.regexp_extract_all(pages, F.lit(pattern), F.lit(g)) for g in (1, 2))
    pairs = F.arrays_zip(names.alias("k"), urls.alias("v"))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def range_ids(text: Column | str) -> Column:
    """F29. 'X-Y' as all numbers, where a short Y completes the digits of X ('104920-3' ends at 104923); another text as it is."""
    c = as_column(text)
    first, last = F.split_part(c, F.lit("-"), F.lit(1)), F.split_part(c, F.lit("-"), F.lit(2))
    whole = F.concat(F.left(first, F.greatest(F.length(first) - F.length(last), F.lit(0))), last)
    a, b = first.try_cast("long"), whole.try_cast("long")
    return F.when(c.rlike(r"^\d+-\d+$") & (a <= b), F.transform(F.sequence(a, b), lambda x: x.cast("string"))).otherwise(F.array(c))


#: An interval of more numbers than this is no list of datasets; it stands for none.
MOST_NUMBERS = 100_000
_MASK = re.compile(r"INTERVAL(\d+)!")
_SWAPPED = str.maketrans("_ ", " _")
_FAMILIES = {k: re.compile(v, re.X) for k, v in FAMILIES.items()}


def expand_interval(body: str) -> list[str]:
    """F28. '[1/2/3]' or '[9-12]' as its numbers, padded with zeros to the width of the longest. A short end completes the digits of the first ('[104920-3]' ends at 104923); reversed or boundless intervals give none."""
    inner = body.strip("[]").replace("\n", "")
    if "-" not in inner:
        return [x for x in re.split(r"[\\/]", inner) if x]
    first, last = inner.split("-")
    last = first[: max(0, len(first) - len(last))] + last
    width = max(len(first), len(last))
    a, b = int(first), int(last)
    return [f"{i:0{width}d}" for i in range(a, b + 1)] if b - a < MOST_NUMBERS else []


def dataset_names(text: str | None) -> list[tuple[str, str]]:
    """F27, F28. (family, name) of all dataset names in a text, each once for a family.

    Bracketed intervals become numbered marks, of numbers that the text doesn't use itself. A family is sought in one scan of
    the text as it stands and one with spaces and underscores exchanged, so that names written with spaces are found; what a
    scan finds is left out of the next. A name with intervals stands for one name for each of their values, in step, as long
    as the shortest.
    """
    if not text:
        return []
    base = 1 + max((int(n) for n in _MASK.findall(text)), default=-1)
    intervals: list[list[str]] = []

    def mask(m: re.Match) -> str:
        intervals.append(expand_interval(m[0]))
        return f"INTERVAL{base + len(intervals) - 1}!"

    rest, out = re.sub(INTERVAL, mask, text), []
    for family, pattern in _FAMILIES.items():
        for _ in range(2):
            pieces, at, seen = [], 0, {}
            for m in pattern.finditer(rest):
                pieces.append(rest[at : m.start()])
                at = m.end()
                seen[m[0].replace("\n", "").strip()] = None
            rest = ("".join(pieces) + rest[at:]).translate(_SWAPPED)
            for name in seen:
                own = [int(n) - base for n in _MASK.findall(name) if int(n) >= base]
                values = zip(*(intervals[n] for n in own), strict=False) if own else [()]
                out += [(family, _MASK.sub(lambda m, v=dict(zip(own, x, strict=True)): v.get(int(m[1]) - base, m[0]), name)) for x in values]
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("family", T.StringType()), T.StructField("name", T.StringType())])))
def dataset_names_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``dataset_names`` over a column: leaving out what one family has taken can't be said in SQL."""
    for s in texts:
        yield pd.Series([[{"family": f, "name": n} for f, n in dataset_names(t)] for t in s])


def by_path(variant: Column, path: str) -> Column:
    """J-1. The value at a dotted path of a variant; quoted keys may hold dots."""
    keys = re.findall(r'"([^"]+)"|([^.]+)', path)
    return F.try_variant_get(variant, "$" + "".join(f"['{a or b}']" for a, b in keys), "string")


def first_known(prefix: str, *columns: Column) -> Column:
    """J-2, A29. The first column that is neither null nor empty, after ``prefix``."""
    value = F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))
    return F.when(value.isNotNull(), F.concat(F.lit(prefix), value))


def not_null_text(c: Column) -> Column:
    """J-6. The text 'null' stands for no value."""
    return F.nullif(c, F.lit("null"))
