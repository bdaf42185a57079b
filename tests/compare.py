"""Rows of a query against rows of its SQL."""

from __future__ import annotations


def cell(value):
    import datetime
    import decimal

    if value is None or value != value:
        return None
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    return round(value, 6) if isinstance(value, float) else value


def same_rows(spark_df, duck_rows, duck_columns):
    """Rows of both, columns by name, in any order."""
    columns = sorted(spark_df.columns)
    assert columns == sorted(duck_columns)
    mine = sorted((tuple(cell(r[c]) for c in columns) for r in spark_df.collect()), key=repr)
    place = [duck_columns.index(c) for c in columns]
    theirs = sorted((tuple(cell(r[i]) for i in place) for r in duck_rows), key=repr)
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        assert all(x == y or isinstance(x, float) and abs(x - y) < 1e-5 for x, y in zip(a, b, strict=True)), (a, b)
