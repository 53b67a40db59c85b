"""Dataset, task and container names: parts, formats, scopes, tokens (inventory F1-F8, F12, P14, P17-P19, R4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def data_format(name: Column | str) -> Column:
    """F1. The data format in a dataset's name: the fifth of more than five fields; of user's and group's names the seventh of more than seven."""
    parts = F.split(as_column(name), r"\.")
    own = F.get(parts, F.lit(0)).rlike("^(user|group)")
    return F.when(own, F.when(F.size(parts) > 7, F.get(parts, F.lit(6)))).when(F.size(parts) > 5, F.get(parts, F.lit(4)))


def scope(name: Column | str) -> Column:
    """F2. What stands before ':'; else the first field, or for user's and group's names the first two."""
    c = as_column(name)
    parts = F.split(c, r"\.")
    first = F.get(parts, F.lit(0))
    return F.when(c.contains(":"), F.substring_index(c, ":", 1)).when(first.rlike("^(user|group)"), F.concat_ws(".", first, F.get(parts, F.lit(1)))).otherwise(first)


def normalized(name: Column | str) -> Column:
    """F3. The name without its scope."""
    return F.regexp_replace(as_column(name), "^[^:]*:", "")


def container(name: Column | str) -> Column:
    """F4. The container of a dataset: its name without scope and without the task's suffix."""
    return F.regexp_replace(normalized(name), "_tid.+", "")


def hashtags(text: Column | str) -> Column:
    """F5. A comma-separated list in lower case, each element trimmed; null stays null."""
    return F.transform(F.split(F.lower(as_column(text)), ","), lambda x: F.trim(x))


def formats(text: Column | str) -> Column:
    """F6."""
    return F.split(as_column(text), r"\.")


def name_tags(taskname: Column | str) -> Column:
    """F7. The last field of a task's name."""
    return F.element_at(F.split(as_column(taskname), r"\."), -1)


def format_steps(output_formats: Column | str, tag: Column | str) -> Column:
    """F8. 'format:tag' for each format but LOG; null if none is left or there is no tag."""
    t = as_column(tag)
    out = F.transform(F.filter(as_column(output_formats), lambda f: f != "LOG"), lambda f: F.concat_ws(":", f, t))
    return F.when((F.size(out) > 0) & t.isNotNull(), out)


def name_tokens(text: Column | str) -> Column:
    """P14. The tokens of a dataset's name: only letters, digits and _ / . * ? - count, cut at '.' and '_', lower case."""
    return F.filter(F.split(F.lower(F.regexp_replace(as_column(text), r"[^a-zA-Z0-9_/.*?-]", "")), r"\.+|_+"), lambda t: t != "")


def name_fields(text: Column | str) -> Column:
    """P14. As ``name_tokens``, but cut at '.' only."""
    return F.filter(F.split(F.lower(F.regexp_replace(as_column(text), r"[^a-zA-Z0-9_/.*?-]", "")), r"\.+"), lambda t: t != "")


def plain_tokens(text: Column | str) -> Column:
    """The tokens of running text: runs of letters and digits, lower case."""
    return F.filter(F.split(F.lower(as_column(text)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def lower_names(df: DataFrame) -> DataFrame:
    """P18. Column names in lower case."""
    return df.toDF(*(c.lower() for c in df.columns))


def without_service_fields(df: DataFrame) -> DataFrame:
    """P17. Without the columns whose names begin with '_'."""
    return df.drop(*(c for c in df.columns if c.startswith("_")))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """P19. Columns renamed by a map; names that aren't there do no harm."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def as_array(c: Column | str, kind: str) -> Column:
    """R4. A scalar as an array of one; arrays stay, null stays."""
    return as_column(c) if kind.startswith("array") else F.when(as_column(c).isNotNull(), F.array(as_column(c)))


def with_suffix(values: Column | str, suffix: Column | str) -> Column:
    """R5. 'value:suffix' for each element; null if there is no array or no suffix."""
    s = as_column(suffix)
    return F.when(s.isNotNull(), F.transform(as_column(values), lambda x: F.concat_ws(":", x, s)))
