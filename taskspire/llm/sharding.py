"""Operator 2, sharding by histogram sort.

Rows are ordered by (MD5 of the text, doc_id), so equal texts are neighbours. The splitters of that order are found by
counting exact bytes below candidate key boundaries over all partitions, each round refining only the cells that still hold
a splitter; no row is sorted for it. Then every row is dealt once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taskspire.llm.common import materialize

#: Bytes that a row costs besides its text.
ROW_BYTES = 16
#: A splitter may move to the edge of a group of equal texts if the group has at most this share of a shard's bytes.
GROUP_TOLERANCE = 0.02
#: Hexadecimal digits by which a round refines a boundary: 256 probes for each.
DIGITS = 2
#: Rows are dealt in segments of a shard, so that one shard isn't one task: bytes of a segment, and most segments.
SEGMENT_BYTES, SEGMENTS = 4 * 2**20, 20_000
#: 32 digits of the text's MD5, 16 of doc_id (biased to sort as unsigned).
TEXT_DIGITS = 32
#: Sorts after every digit. Beyond so many parts, a round refines by one digit.
AFTER, MANY_PARTS = "~", 1000


def with_key(docs: DataFrame) -> DataFrame:
    """Adds size, text_crc32 and the sort key. A null text counts as empty; a null doc_id sorts as the least id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    biased = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).bitwiseXOR(F.lit(-(2**63)).cast("long"))
    return docs.withColumns({
        "size": (F.octet_length(text) + ROW_BYTES).cast("long"),
        "text_crc32": F.crc32(F.encode(text, "UTF-8")).cast("long"),
        "sort_key": F.concat(F.md5(F.encode(text, "UTF-8")), F.lpad(F.hex(biased), 16, "0")),
    })


def splitters(keyed: DataFrame, parts: int, group_tolerance: float, shards: int) -> tuple[list[str], int]:
    """The parts - 1 keys at which a part begins, in order, and the bytes of all rows.

    Part j begins at the edge between rows that is nearest to total * j / parts bytes; within a group of equal texts that
    is small enough, at the group's nearer edge instead. The driver reads at most parts * 256 counts a round (parts * 16
    where there are more than MANY_PARTS parts).
    """
    spark = keyed.sparkSession
    total = keyed.agg(F.sum("size")).first()[0] or 0
    #: open cells: prefix -> bytes before it, and the targets that fall into it
    cells: dict[str, tuple[int, list[int]]] = {"": (0, list(range(1, parts)))} if total else {}
    found: dict[int, str] = {}
    most = group_tolerance * total / shards
    digits = DIGITS if parts <= MANY_PARTS else 1
    while cells:
        width = len(next(iter(cells)))
        rows = keyed if not width else keyed.join(F.broadcast(spark.createDataFrame([(c,) for c in cells], "cell string")), F.substring("sort_key", 1, width) == F.col("cell"), "left_semi")
        probes = rows.groupBy(F.substring("sort_key", 1, width + digits).alias("cell")).agg(F.sum("size"), F.min("sort_key"), F.max("sort_key"))
        below: dict[str, list[tuple[str, int, str, str]]] = {}
        for r in sorted(probes.collect()):
            below.setdefault(r[0][:width], []).append(tuple(r))
        narrower: dict[str, tuple[int, list[int]]] = {}
        for prefix, (before, targets) in cells.items():
            rest = list(targets)
            for cell, size, low, high in below[prefix]:
                inside = [j for j in rest if before * parts < j * total <= (before + size) * parts]
                rest = rest[len(inside) :]
                one_key, one_group = low == high, low[:TEXT_DIGITS] == high[:TEXT_DIGITS] and size <= most
                if inside and (one_key or one_group):
                    # nothing to refine: the part begins at the nearer edge of these rows
                    start, end = (low[:TEXT_DIGITS], low[:TEXT_DIGITS] + AFTER) if one_group else (low[:-1] + chr(ord(low[-1]) - 1) + AFTER, low + AFTER)
                    found |= {j: start if 2 * j * total < (2 * before + size) * parts else end for j in inside}
                elif inside:
                    narrower[cell] = (before, inside)
                before += size
        cells = narrower
    return [found.get(j, AFTER) for j in range(1, parts)], total


def shard_rows(docs: DataFrame, shards: int = 40, group_tolerance: float = GROUP_TOLERANCE, segment_bytes: int = SEGMENT_BYTES, with_documents: bool = True) -> DataFrame:
    """All rows of ``docs`` with size, text_crc32, shard (0 to shards - 1) and slot (from 0, gapless in a shard); without their other columns but doc_id, if ``with_documents`` is off.

    Law: the shards' bytes are near equal. Equal texts lie in one shard, but for groups larger than ``group_tolerance`` of
    a shard, which may be cut. Empty table: no rows. Rows that are equal in text and doc_id share a key and one shard;
    their slots are in any order. Columns of ``docs`` named like ours are replaced.
    """
    docs = docs.drop("size", "text_crc32", "sort_key", "segment", "shard", "slot", "segment_start")
    keyed = with_key(docs)
    small = keyed.select("sort_key", "size") if with_documents else keyed.select("sort_key", "size", "doc_id", "text_crc32")
    small = materialize(small, "shard-keys")
    rows = keyed if with_documents else small
    n = small.agg(F.sum("size")).first()[0] or 0
    a_shard = max(1, min(-(-n // (shards * segment_bytes)), SEGMENTS // shards))
    cuts, _ = splitters(small, shards * a_shard, group_tolerance, shards)

    @F.pandas_udf("int")
    def segment_of(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for k in keys:
            yield pd.Series([bisect_left(cuts, x) for x in k], dtype="int32")

    counts = dict(small.groupBy(segment_of("sort_key").alias("segment")).count().collect()) if n else {}
    starts, at = [], 0
    for s in range(shards * a_shard):
        at = 0 if s % a_shard == 0 else at
        starts.append((s, at))
        at += counts.get(s, 0)
    spark = docs.sparkSession
    dealt = rows.withColumn("segment", segment_of("sort_key"))
    order = Window.partitionBy("segment").orderBy("sort_key")
    offsets = F.broadcast(spark.createDataFrame(starts, "segment int, segment_start long"))  # at most SEGMENTS rows
    return (
        dealt.withColumn("slot", F.row_number().over(order).cast("long"))
        .join(offsets, "segment")
        .withColumns({"slot": F.col("slot") - 1 + F.col("segment_start"), "shard": F.floor(F.col("segment") / a_shard).cast("int")})
        .drop("segment", "segment_start", "sort_key")
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes. Null text: 16 bytes, CRC 0."""
    got = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40, with_documents=False)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op2_sharding": op2_sharding}
SQL: dict[str, str] = {}
