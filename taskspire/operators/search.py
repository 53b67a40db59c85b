"""Keyword search over tasks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.functions.names import name_fields, name_tokens, plain_tokens


def glob_pattern(word: str) -> str:
    """A pattern for a keyword with ? and *."""
    return "^" + "".join("." if c == "?" else ".*" if c == "*" else re.escape(c) for c in word.lower()) + "$"


def split_keywords(words: list[str]) -> tuple[list[str], list[str]]:
    """Plain keywords, and the fields of those with wildcards."""
    plain = [w.lower() for w in words if not set(w) & {"?", "*"}]
    wild = [f for w in words if set(w) & {"?", "*"} for f in re.split(r"\.+", w.lower()) if f and f != "*"]
    return plain, wild


def all_tokens(df: DataFrame, names: tuple[str, ...] = ("taskname", "primary_input", "parent_taskname", "ami_tags")) -> Column:
    """P12. The tokens of all text fields; names are cut by their own rules as well as kept whole."""
    parts: list[Column] = []
    for c, kind in df.dtypes:
        if kind == "string":
            parts.append(F.coalesce(plain_tokens(c), F.array()))
            parts.append(F.when(F.col(c).isNotNull(), F.array(F.lower(c))).otherwise(F.array()))
            if c in names:
                parts.append(F.coalesce(name_tokens(c), F.array()))
        elif kind == "array<string>":
            parts.append(F.coalesce(F.transform(c, lambda x: F.lower(x)), F.array()))
        elif kind in ("int", "bigint", "smallint"):
            parts.append(F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("string"))).otherwise(F.array()))
    return F.concat(*parts)


def _like(pattern: str):
    return lambda field: field.rlike(pattern)


def keyword_search(tasks: DataFrame, words: list[str], size: int | None = 2000, ds_size: int | None = 20) -> DataFrame:
    """Tasks that have all keywords, in order of their id, each with its first datasets. Keywords with ? or * are matched with the fields of the task's name."""
    plain, wild = split_keywords(words)
    if not plain and not wild:
        raise ValueError("no keywords")
    p = F.lit(True)
    if plain:
        p = p & (F.size(F.array_except(F.array(*map(F.lit, plain)), all_tokens(tasks))) == 0)
    for w in wild:
        p = p & F.coalesce(F.exists(name_fields("taskname"), _like(glob_pattern(w))), F.lit(False))
    out = tasks.where(p)
    if ds_size is not None and "output_dataset" in tasks.columns:
        out = out.withColumn("output_dataset", F.slice(F.coalesce("output_dataset", F.array().cast(dict(tasks.dtypes)["output_dataset"])), 1, ds_size))
    return out.orderBy("taskid").limit(size) if size is not None else out
