"""Comparison of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(source: DataFrame, store: DataFrame, key: str = "_id") -> DataFrame:
    """J21. Source rows that the store lacks ('missing'), or in which a field differs ('different', with the names of those fields). Service fields aren't compared; a field that the store has no column for counts as differing unless it is null."""
    fields = [c for c in source.columns if c != key and not c.startswith("_")]
    s = store.select(key, F.lit(True).alias("_there"), *(F.col(c).alias(f"_s_{c}") for c in fields if c in store.columns))
    other = lambda c: F.col(f"_s_{c}") if c in store.columns else F.lit(None)
    named = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(other(c)), F.lit(c)) for c in fields)))
    j = source.join(s, key, "left").select(key, F.col("_there").isNull().alias("_gone"), named.alias("fields"))
    return j.where(F.col("_gone") | (F.size("fields") > 0)).select(key, F.when(F.col("_gone"), "missing").otherwise("different").alias("problem"), F.when(~F.col("_gone"), F.array_join("fields", ",")).alias("fields"))


def compare(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """J23. Full comparison of two tables by the first of ``keys`` that both have: rows of one side only, and rows that differ."""
    key = next((k for k in keys if k in a.columns and k in b.columns), None)
    if key is None:
        raise ValueError(f"none of {keys} is in both")
    fields = sorted(({*a.columns} | {*b.columns}) - {key})
    side = lambda d, p: d.select(F.col(key), F.lit(True).alias(f"_{p}"), *((F.col(c) if c in d.columns else F.lit(None)).cast("string").alias(f"{p}_{c}") for c in fields))
    j = side(a, "a").join(side(b, "b"), key, "full_outer")
    same = reduce(lambda x, y: x & y, (F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in fields), F.lit(True))
    found = F.when(F.col("_a").isNull(), "only_b").when(F.col("_b").isNull(), "only_a").when(~same, "different")
    return j.select(F.col(key).cast("string").alias("key"), found.alias("problem")).where("problem is not null")
