"""Compares a query with its SQL as DuckDB runs it on the same tables."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(x) for x in value])
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def agree(spark, query, sql, folder):
    frame = query(spark, folder)
    names = sorted(frame.columns)
    got = Counter(tuple(plain(row[c]) for c in names) for row in frame.select(*names).toArrow().to_pylist())
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    want = Counter(tuple(plain(dict(zip(columns, row, strict=True))[c]) for c in names) for row in result.fetchall())
    assert got == want
