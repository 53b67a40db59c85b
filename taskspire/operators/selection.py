"""The compiler of selection parameters to a predicate."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.schema import BAD_STATUSES, FIELD_ALIASES


class SelectionError(ValueError):
    """The parameters can't be compiled."""


def by_prefix(values: Any, prefixes: str = "|&!", default: str = "|") -> dict[str, list]:
    """Values sorted by their one-character prefix, which is taken off: '|' any of, '&' all of, '!' none of."""
    out: dict[str, list] = {p: [] for p in prefixes}
    for v in values if isinstance(values, (list, tuple, set)) else [values]:
        if isinstance(v, str) and v[:1] in out and v[:1]:
            out[v[0]].append(v[1:])
        else:
            out[default].append(v)
    return {k: v for k, v in out.items() if v}


def matches(df: DataFrame, field: str, value: Any) -> Column:
    """P2, P3, P5. Equality; any of a list; for arrays, any element; None: the field is missing. A missing field gives null."""
    c, is_array = F.col(field), dict(df.dtypes)[field].startswith("array")
    if value is None:
        return (c.isNull() | (F.size(c) == 0)) if is_array else c.isNull()
    if isinstance(value, (list, tuple, set)):
        if None in value:
            return matches(df, field, [v for v in value if v is not None]) | matches(df, field, None)
        kind = dict(df.dtypes)[field]
        if is_array:
            return F.arrays_overlap(c, F.array(*map(F.lit, value)).cast(kind))
        return c.isin(*value)
    return F.array_contains(c, F.lit(value).cast(dict(df.dtypes)[field][6:-1])) if is_array else c == value


def negated(p: Column) -> Column:
    """P4. Also true where the field is missing."""
    return ~F.coalesce(p, F.lit(False))


def selection(df: DataFrame, params: dict[str, Any], allow_all: bool = False) -> Column:
    """P1. One predicate of {field: None | scalar | list | {'|': [...], '!': [...], '&': [...]}}.

    Names may be aliases. '&' (all of) is refused unless ``allow_all``. No parameters at all, or an unknown field, is an error.
    """
    if not params:
        raise SelectionError("no selection parameters")
    parts: list[Column] = []
    for name, value in params.items():
        field = FIELD_ALIASES.get(name, name)
        if field not in df.columns:
            raise SelectionError(f"unknown field: {name}")
        sorted_values = value if isinstance(value, dict) else {"|": value}
        for kind, v in sorted_values.items():
            if kind == "|":
                parts.append(matches(df, field, v[0] if isinstance(v, (list, tuple)) and len(v) == 1 else v))
            elif kind == "!":
                for x in v if isinstance(v, (list, tuple, set)) else [v]:
                    parts.append(negated(matches(df, field, x)))
            elif kind == "&" and allow_all:
                parts.extend(matches(df, field, x) for x in (v if isinstance(v, (list, tuple, set)) else [v]))
            elif kind == "&":
                raise NotImplementedError("'all of' is not supported; allow_all turns it on")
            else:
                raise SelectionError(f"unknown kind of condition: {kind}")
    return reduce(lambda a, b: a & b, parts)


def in_range(field: str, **bounds: Any) -> Column:
    """P8. gt, gte, lt, lte; a missing field doesn't match."""
    ops = {"gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__"}
    return reduce(lambda a, b: a & b, (getattr(F.col(field), ops[k])(v) for k, v in bounds.items()))


def not_bad(statuses: Iterable[str] = BAD_STATUSES) -> Column:
    """P10. The status isn't one of those of failure; an unknown status is fine."""
    return negated(F.col("status").isin(*statuses))


def ended_after_start() -> Column:
    """P9."""
    return F.coalesce(F.col("end_time") > F.col("start_time"), F.lit(False))


def incomplete(*required: str) -> Column:
    """P20. Whether one of the required fields is missing."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in required))


def having_child(parents: DataFrame, children: DataFrame, key: str, condition: Column) -> DataFrame:
    """J11, P9. Parents of which a child fits, once each."""
    return parents.join(children.where(condition).select(key), key, "left_semi")


def having_parent(children: DataFrame, parents: DataFrame, key: str, condition: Column) -> DataFrame:
    """J12. Children whose parent fits."""
    return children.join(parents.where(condition).select(key), key, "left_semi")
