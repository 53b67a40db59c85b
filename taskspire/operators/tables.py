"""Tables in papers: reconstruction from placed lines of text, and the choice of those that list datasets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What captions and column heads of dataset tables say, and what ids look like.
CAPTION = r"(?i)(?:sample|dataset|run)"
HEAD = r"^(?:d[cs]?[-_ ]?|mc[-_ ]?|data ?|dataset ?|period|request ?|run ?|sample ?)(?:id|number|period|range|sample|set)"
ID, ID_RANGE = r"^\d{4,8}$", r"^\d{4,8}-\d{1,8}$"
#: Least and greatest share of ids in the column.
COVERAGE = (0.7, 1.0)
#: Lines lie in one row if their heights overlap by this share of the lower one.
SAME_ROW = 0.5


def reconstruct_page(lines: pd.DataFrame) -> pd.DataFrame:
    """Rows and cells of one page from its lines (paper, page, x0, x1, y0, y1, text). Lines whose heights overlap form a row; columns are the groups of overlapping spans of all rows with two cells or more; a row ends the table if it has one cell only."""
    lines = lines.sort_values(["y1", "x0"], ascending=[False, True])
    rows: list[list] = []
    for line in lines.itertuples(index=False):
        last = rows[-1] if rows else None
        overlap = min(last[0].y1, line.y1) - max(last[0].y0, line.y0) if last else -1
        if last and overlap >= SAME_ROW * min(last[0].y1 - last[0].y0, line.y1 - line.y0):
            last.append(line)
        else:
            rows.append([line])
    out, table, open_ = [], 0, False
    columns: list[list[float]] = []
    number = 0
    for row in rows:
        if len(row) < 2:
            open_ = False
            continue
        if not open_:
            table, open_, columns, number = table + 1, True, [], 0
        for cell in sorted(row, key=lambda c: c.x0):
            at = next((i for i, (a, b) in enumerate(columns) if min(b, cell.x1) > max(a, cell.x0)), None)
            if at is None:
                columns.append([cell.x0, cell.x1])
                columns.sort()
                at = columns.index([cell.x0, cell.x1])
            else:
                columns[at] = [min(columns[at][0], cell.x0), max(columns[at][1], cell.x1)]
            out.append((cell.paper, cell.page, table, number, at, cell.text))
        number += 1
    return pd.DataFrame(out, columns=["paper", "page", "table_no", "row_no", "column_no", "text"])


def reconstruct(lines: DataFrame) -> DataFrame:
    """F31. ``reconstruct_page`` for each page: a page is a bounded group, and placing its cells depends on all rows before."""
    return lines.groupBy("paper", "page").applyInPandas(reconstruct_page, "paper string, page int, table_no int, row_no int, column_no int, text string")


def id_share(value: Column) -> Column:
    """A31. Of a group, the share of values that are ids or ranges of ids."""
    return F.avg(F.when(F.trim(value).rlike(ID) | F.trim(value).rlike(ID_RANGE), 1.0).otherwise(0.0))


def dataset_tables(cells: DataFrame, captions: DataFrame, keys: tuple[str, ...] = ("paper", "page", "table_no")) -> DataFrame:
    """F32. (keys, column_no, share) of the columns that list datasets: in tables whose caption (keys, caption) speaks of samples, under a head that says so, and with enough ids below it."""
    likely = cells.join(captions.where(F.col("caption").rlike(CAPTION)).select(*keys).distinct(), list(keys))
    heads = likely.where((F.col("row_no") == 0) & F.lower(F.trim("text")).rlike(HEAD)).select(*keys, "column_no").distinct()
    below = likely.where("row_no > 0").join(heads, [*keys, "column_no"])
    return below.groupBy(*keys, "column_no").agg(id_share(F.col("text")).alias("share")).where(F.col("share").between(*COVERAGE))
