"""Fields of bibliographic records, given as variants: a field may be an object, a list of objects, or a plain value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskspire.functions.text import clean_string, first_starting, keywords


def value(record: Column, path: str) -> Column:
    """The text at a path; null if there is none or null stands there."""
    return F.try_variant_get(record, path, "string")


def known(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def each_value(record: Column, path: str, key: str) -> Column:
    """The known values of a key in a list of objects; null if no list stands at the path."""
    return known(F.transform(F.try_variant_get(record, path, "array<variant>"), lambda x: value(x, f"$.{key}")))


def of_first(record: Column, path: str, key: str) -> Column:
    """The value of a key in an object, or in the first object of a list that knows it."""
    return F.coalesce(F.get(each_value(record, path, key), F.lit(0)), value(record, f"{path}.{key}"))


def listed(record: Column, path: str) -> Column:
    """A plain value as a list of one, a list as its known values; null if nothing is there."""
    many, one = F.try_variant_get(record, path, "array<string>"), value(record, path)
    return F.coalesce(known(many), F.when(one.isNotNull(), F.array(one)))


def arxiv_code(record: Column) -> Column:
    """F16."""
    return clean_string(first_starting(listed(record, "$.primary_report_number"), "arXiv"))


def internal_number(record: Column) -> Column:
    """F17. The internal report number; of a single object without one its primary number."""
    return F.coalesce(of_first(record, "$.report_number", "internal"), value(record, "$.report_number.primary_report_number"))


def report_number(record: Column) -> Column:
    """F17."""
    return of_first(record, "$.report_number", "report_number")


def keyword_list(record: Column) -> Column:
    """F18. The terms of a list, or one term cut at its commas."""
    return F.coalesce(each_value(record, "$.keywords", "term"), keywords(value(record, "$.keywords.term")))


def description(record: Column) -> dict[str, Column]:
    """F19. Abstract, title, number and date of creation of a record."""
    return {
        "abstract": clean_string(of_first(record, "$.abstract", "summary")),
        "title": clean_string(value(record, "$.title.title")),
        "record_id": value(record, "$.recid").try_cast("int"),
        "creation_date": clean_string(value(record, "$.creation_date")),
    }


def dois(record: Column) -> Column:
    """F20."""
    return listed(record, "$.doi")


def journals(record: Column) -> Column:
    """G2. The journal issues of a record as (title, volume, year): one object or a list of them."""
    issue = "struct<title:string,volume:string,year:string>"
    one, many = F.try_variant_get(record, "$.journal", issue), F.try_variant_get(record, "$.journal", f"array<{issue}>")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))
