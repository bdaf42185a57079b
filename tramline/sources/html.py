"""Elements of HTML pages, and tables of them as rows."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def element_text(column: str, tag: str) -> Column:
    """Text of the first element of a kind, '' if there is none."""
    return F.regexp_extract(column, f"<{tag}>([^<]*)</{tag}>", 1)


def count_tag(column: str, pattern: str) -> Column:
    return F.regexp_count(F.col(column), F.lit(pattern))


class _Tables(HTMLParser):
    """Cells of all tables: tables of rows of (is header, text)."""

    def __init__(self):
        super().__init__()
        self.tables: list[list[list[tuple[bool, str]]]] = []
        self._open: list[bool] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.tables[-1][-1].append((tag == "th", ""))
            self._open.append(True)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._open:
            self._open.pop()

    def handle_data(self, data):
        if self._open and self.tables and self.tables[-1] and self.tables[-1][-1]:
            head, text = self.tables[-1][-1][-1]
            self.tables[-1][-1][-1] = (head, text + data)


def tables_of(page: str) -> list[list[list[tuple[bool, str]]]]:
    parser = _Tables()
    parser.feed(page or "")
    return [[[(head, " ".join(text.split())) for head, text in row] for row in t if row] for t in parser.tables]


def table_cells(pages: DataFrame, id_column: str, html_column: str) -> DataFrame:
    """(id, table_no, row_no, cell_no, is_header, text) of every cell."""
    id_type = pages.schema[id_column].dataType.simpleString()

    def run(frames):
        for frame in frames:
            out = [(i, t, r, c, head, text) for i, page in zip(frame[id_column], frame[html_column], strict=True) for t, table in enumerate(tables_of(page)) for r, row in enumerate(table) for c, (head, text) in enumerate(row)]
            yield pd.DataFrame(out, columns=[id_column, "table_no", "row_no", "cell_no", "is_header", "text"])

    return pages.select(id_column, html_column).mapInPandas(run, f"{id_column} {id_type}, table_no int, row_no int, cell_no int, is_header boolean, text string")


def train_times(cells: DataFrame, id_column: str) -> DataFrame:
    """(id, direction, position, stop, first_train, last_train) of schedule tables.

    A table whose second header says "To ..." is of that direction, any other is ``circular``; '-' is no time.
    """
    head = cells.where("is_header AND row_no = 0").groupBy(id_column, "table_no").agg(F.max(F.when(F.col("cell_no") == 1, F.col("text"))).alias("second"))
    direction = F.when(F.col("second").startswith("To "), F.trim(F.expr("substring(second, 4)"))).otherwise("circular")
    cell = lambda i: F.max(F.when(F.col("cell_no") == i, F.col("text")))
    body = cells.where("NOT is_header").groupBy(id_column, "table_no", F.col("row_no").alias("position")).agg(cell(0).alias("stop"), cell(1).alias("first_train"), cell(2).alias("last_train"))
    time = lambda c: F.when(~F.col(c).isin("-", ""), F.col(c)).alias(c)
    return body.join(head, [id_column, "table_no"], "left").select(id_column, F.coalesce(direction, F.lit("circular")).alias("direction"), "position", "stop", time("first_train"), time("last_train"))
