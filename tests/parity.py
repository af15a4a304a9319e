"""Run registered queries against their SQL answers and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def differences(spark, con, sf_dir, query, statement):
    """(columns, rows) on either side only; both empty when results are equal. Types must agree too."""
    frame = query(spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(statement)
    names = [c[0] for c in cursor.description]
    expected = _rows(names, cursor.fetchall())
    columns = sorted(frame.columns), sorted(names)
    if columns[0] != columns[1]:
        return columns, []
    if got == expected:
        return [], []
    ours, theirs = set(got) - set(expected), set(expected) - set(got)
    return [], [f"rows {len(got)} / {len(expected)}", *sorted(ours)[:3], "---", *sorted(theirs)[:3]]
