"""Upserts into document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order`` (ties: the greatest row). One aggregate with partial sums, no sort."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max_by(F.struct(order, *rest), F.struct(order, *rest)).alias("_d")).select(key, "_d.*")


def index_upsert(store: DataFrame, updates: DataFrame, key: str = "_id", order: str = "version") -> DataFrame:
    """U1. Insert or overwrite whole documents; of several updates of a key the last counts."""
    new = last_of_each(updates, key, order)
    return store.join(new, key, "left_anti").unionByName(new.select(*store.columns), allowMissingColumns=True)


def partial_upsert(store: DataFrame, updates: DataFrame, key: str = "_id", incomplete: str = "_incomplete", flag: str = "_update_required") -> DataFrame:
    """U2, U3. Update the fields that an update has; insert where the key is new.

    An incomplete update sets ``flag`` only on the document that it inserts; a complete one clears it. Keys of updates are unique.
    """
    fields = [c for c in store.columns if c not in (key, flag)]
    u = updates.select(key, F.coalesce(incomplete, F.lit(False)).alias("_inc"), *(F.col(c).alias(f"_u_{c}") for c in fields if c in updates.columns), F.lit(True).alias("_new"))
    s = store.withColumn("_old", F.lit(True))
    j = s.join(u, key, "full_outer")
    merged = [F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in updates.columns else F.col(c) for c in fields]
    state = F.when(F.col("_new").isNull(), F.col(flag)).when(F.col("_inc"), F.when(F.col("_old").isNull(), F.lit(True)).otherwise(F.col(flag))).otherwise(F.lit(False))
    return j.select(key, *merged, state.alias(flag))


def action(df: DataFrame, default: str = "index") -> DataFrame:
    """U4. 'update' where the row says so or is incomplete, else the default."""
    asked = [F.coalesce(F.col(c), F.lit(False)) for c in ("_update", "_incomplete") if c in df.columns]
    p = F.lit(False)
    for a in asked:
        p = p | a
    return df.withColumn("_action", F.when(p, "update").otherwise(default))


def routed(df: DataFrame, aliases: dict[str, str], default: str, column: str = "_index") -> DataFrame:
    """K5. The target of each row: its own by the map of aliases, or the default. To be written with partitionBy(column)."""
    pairs = [F.lit(x) for kv in aliases.items() for x in kv]
    own = F.col(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(F.element_at(F.create_map(*pairs), own) if pairs else F.lit(None), own, F.lit(default)))


def union_all(*frames: DataFrame) -> DataFrame:
    """U5, U6, J24, S18. Rows of all tables; columns that one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
