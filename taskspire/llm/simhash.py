"""Operator 4, document fingerprints by SimHash, with DataFrame functions only.

The terms of a text are its pairs of neighbouring words, each weighted by how often it occurs. A term's hash votes for or
against each bit, and a fingerprint keeps the bits with more votes for than against. Permuted block tables find all
fingerprints within a Hamming radius: of radius + 1 blocks at least one is equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.llm.common import materialize

#: Bits of a fingerprint, in 64-bit words.
BITS = 128
#: Neighbours in id order are found within buckets of ids: rows of a bucket, and the least and greatest number of buckets.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 1500, 200, 20_000
#: The buckets' bounds are quantiles of about so many ids a bucket; they only balance the work.
IDS_A_BUCKET = 50
#: The query searches all fingerprints for those within RADIUS bits of each row whose doc_id is divisible by EVERY.
RADIUS, EVERY = 3, 50
#: Tasks over which the fingerprints of one block are dealt.
SALTS = 8
LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """A hash for each pair of neighbouring words (of the only word, if there is one); none if there are no words."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    pairs = lambda w: F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda x, i: F.xxhash64(x, F.coalesce(F.get(w, i + 1), F.lit(""))))
    # bound once, so that the split is not done again for each use
    return F.flatten(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, pairs(w)).otherwise(F.array().cast("array<bigint>"))))


def _lanes(hashed: Column) -> list[Column]:
    """32 sums for 64 bits: bit i votes in the low half of lane i, bit i + 32 in the high half."""
    return [F.sum(F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit(LANES))) for i in range(32)]


def fingerprints(texts: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys``, n_terms and a fingerprint of BITS bits, in hexadecimal, for each row of ``texts``; without terms it is all zeros. ``keys`` must tell rows apart."""
    votes = texts.select(*keys, F.explode_outer(terms(F.col(column))).alias("h"))
    words = BITS // 64
    hashes = [F.col("h")] + [F.when(F.col("h").isNotNull(), F.xxhash64("h", F.lit(k))) for k in range(1, words)]
    summed = votes.groupBy(*keys).agg(F.count("h").alias("n_terms"), *(c.alias(f"v{k}_{i}") for k, h in enumerate(hashes) for i, c in enumerate(_lanes(h))))
    half = lambda c, high: F.shiftrightunsigned(c, 32) if high else c.bitwiseAND(F.lit(0xFFFFFFFF))
    def word(k: int) -> Column:
        bits = F.lit(0).cast("long")
        for i in range(64):
            bits = bits.bitwiseOR(F.when(2 * half(F.col(f"v{k}_{i % 32}"), i >= 32) > F.col("n_terms"), F.lit(1 << i if i < 63 else -(2**63)).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.lower(F.lpad(F.hex(bits), 16, "0"))

    return summed.select(*keys, "n_terms", F.concat(*(word(k) for k in range(words))).alias("fingerprint"))


EMPTY = "0" * (BITS // 4)


def likeness(a: Column, b: Column) -> Column:
    """The cosine that two fingerprints' share of equal bits stands for, cut to 0..1."""
    differ = hamming(a, b)
    return F.greatest(F.lit(0.0), F.round(F.cos(differ * (3.141592653589793 / BITS)), 6))


def with_neighbour(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text and the keys own and next, by descending doc_id (ties by text); after the last comes the first.

    Null texts count as empty, a null id as the least. The ids are cut at about their quantiles into buckets, which are sorted apart;
    the first rows of each bucket are also dealt to the bucket before it.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.select("_id").count()
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, n // BUCKET_ROWS))
    share = min(1.0, buckets * IDS_A_BUCKET / max(n, 1))
    ids = sorted(r[0] for r in rows.where(F.pmod(F.xxhash64("_id", F.lit("cut")), F.lit(1 << 20)) < int(share * (1 << 20))).select("_id").collect())
    cuts = sorted({ids[i * len(ids) // buckets] for i in range(1, buckets)}, reverse=True) if ids else []
    # two levels of cuts, so that a row is compared with about twice the root of their number; bucket 0 has the greatest ids
    wide = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i : i + wide] for i in range(0, len(cuts), wide)] or [[]]
    above = lambda values: F.size(F.filter(values, lambda c: c > F.col("_id")))
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<bigint>")
    tops = longs([g[-1] for g in groups[:-1]])
    inner = F.array(*map(longs, groups))
    rows = rows.withColumn("_group", above(tops)).withColumn("bucket", F.col("_group") * wide + above(F.get(inner, F.col("_group")))).drop("_group")
    sizes = {r[0]: (r[1], r[2]) for r in rows.groupBy("bucket").agg(F.count("*"), F.max("_id")).collect()}  # at most MOST_BUCKETS rows
    order = sorted(sizes)
    after = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}
    spark = docs.sparkSession
    first_of = F.broadcast(spark.createDataFrame([(sizes[after[b]][1], b) for b in order], "_id long, before int"))
    guests = rows.join(first_of, "_id").select("doc_id", "_id", "text", F.col("before").alias("bucket"), F.lit(1).alias("guest"))
    ordered = Window.partitionBy("bucket").orderBy("guest", F.desc("_id"), "text")
    both = rows.select("doc_id", "_id", "text", "bucket", F.lit(0).alias("guest")).unionByName(guests)
    placed = both.withColumns({"place": F.row_number().over(ordered), "next_text": F.lead("text").over(ordered), "next_is_guest": F.lead("guest").over(ordered)}).where("guest = 0")
    follow = F.broadcast(spark.createDataFrame([(b, after[b]) for b in order], "bucket int, after int"))
    last = F.col("next_is_guest") == 1
    return placed.join(follow, "bucket").select(
        "doc_id", "text", "next_text", F.struct("bucket", "place").alias("own"), F.when(last, F.struct(F.col("after").alias("bucket"), F.lit(1).alias("place"))).otherwise(F.struct("bucket", (F.col("place") + 1).alias("place"))).alias("next")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The contract's row for each document: its fingerprint, the one of its edited text, and their likeness.

    No words: the fingerprint of zeros. A lone document is its own neighbour. Equal texts have equal fingerprints.
    """
    near = with_neighbour(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    versions = F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("t")), F.struct(F.lit(1).alias("version"), edited.alias("t")))
    # one row for each version; what the result needs of the text travels with the vote sums' key
    about = near.select("doc_id", "own", "next", n.cast("long").alias("n_chars"), F.sha2(F.encode(edited, "UTF-8"), 256).alias("edited_sha256"), F.explode(versions).alias("v")).select("*", "v.version", "v.t").drop("v")
    votes = fingerprints(about.withColumn("about", F.struct("doc_id", "own", "next", "n_chars", "edited_sha256")), ["about", "version"], "t")
    return votes.groupBy("about").agg(F.max(F.when(F.col("version") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("version") == 1, F.col("fingerprint"))).alias("edited_fingerprint")).select("about.*", "fingerprint", "edited_fingerprint")


def hamming(a: Column, b: Column) -> Column:
    differ = F.lit(0)
    for k in range(BITS // 64):
        part = lambda c: F.conv(F.substring(c, 16 * k + 1, 16), 16, -10).cast("long")  # noqa: B023, E731
        differ = differ + F.bit_count(part(a).bitwiseXOR(part(b)))
    return differ


def within_radius(queries: DataFrame, fps: DataFrame, radius: int, carry: tuple[str, ...] = (), equal: bool = False) -> DataFrame:
    """All pairs (query, fingerprint) of a distinct fingerprint of ``queries`` and one of ``fps`` that differ in 1 to ``radius`` bits, or with ``equal`` in none.

    radius + 1 block tables: whatever lies within the radius shares at least one block with the query. A pair is made only
    in the first table in which it meets, so none is made twice and nothing has to be made distinct. The fingerprints of a
    block are dealt to SALTS tasks, to each of which its queries go. Columns of ``fps`` to ``carry`` along must be the same
    in all rows of a fingerprint. Null fingerprints meet none.
    """
    digits = BITS // 4
    if not 0 <= radius < digits:
        raise ValueError(f"the radius must be under {digits}, so that no block is empty")
    cuts = [round(i * digits / (radius + 1)) for i in range(radius + 2)]
    block = lambda c, i: F.substring(c, cuts[i] + 1, cuts[i + 1] - cuts[i])
    tables = lambda d, name, *more: d.select(F.col("fingerprint").alias(name), *more).distinct().select(name, *more, F.posexplode(F.array(*(block(F.col(name), i) for i in range(radius + 1)))).alias("place", "block"))
    q, f = F.col("query"), F.col("fingerprint")
    earlier = F.lit(False)
    for i in range(radius):
        earlier = earlier | ((F.col("place") > i) & (block(q, i) == block(f, i)))
    asked = tables(queries, "query").withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    pairs = asked.join(tables(fps, "fingerprint", *carry).withColumn("salt", F.pmod(F.hash("fingerprint"), F.lit(SALTS))), ["place", "block", "salt"])
    return pairs.where((F.lit(equal) | (q != f)) & ~earlier & (hamming(q, f) <= radius)).select("query", "fingerprint", *carry)


def neighbour_counts(rows: DataFrame, asked: Column, radius: int) -> DataFrame:
    """(fingerprint, n_within) for each fingerprint of a row that is ``asked``: how many other rows lie within the radius. Equal fingerprints are searched once and counted by their copies."""
    copies = rows.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    pairs = within_radius(rows.where(asked), copies, radius, ("copies",), equal=True)
    return pairs.groupBy(F.col("query").alias("fingerprint")).agg((F.sum("copies") - 1).alias("n_within"))


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_within: for rows whose doc_id is divisible by EVERY, how many other documents' fingerprints lie within RADIUS bits, found by the block tables; else null."""
    found = materialize(fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "fingerprints")
    zeros = F.lit(EMPTY)
    rows = found.select("doc_id", "own", "next", "n_chars", "edited_sha256", F.coalesce("fingerprint", zeros).alias("fingerprint"), F.coalesce("edited_fingerprint", zeros).alias("edited_fingerprint"))
    following = rows.select(F.col("own").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    asked = F.coalesce(F.col("doc_id") % EVERY == 0, F.lit(False))
    # two parts, so that only the rows that are asked for meet the counts; both use one shuffle of the followers
    parts = rows.where(~asked).join(following, "next").withColumn("n_within", F.lit(None).cast("long")), rows.where(asked).join(following, "next").join(neighbour_counts(rows, asked, RADIUS), "fingerprint")
    near = likeness(F.col("fingerprint"), F.col("edited_fingerprint")), likeness(F.col("fingerprint"), F.col("next_fingerprint"))
    return parts[0].unionByName(parts[1]).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near[0].alias("near_edited"), near[1].alias("near_next"), "n_within")


QUERIES = {"op4_fingerprints": op4_fingerprints}
SQL: dict[str, str] = {}
