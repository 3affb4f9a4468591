"""Side-by-side check of a registered query and its SQL."""

from __future__ import annotations

import datetime
import math
import pathlib

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else a short text on the difference."""
    df = query(spark, sf_dir)
    left_names, left = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    right_names, right = _rows([d[0] for d in rel.description], rel.fetchall())
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference {a} / {b} of {left_names}"
    return None
