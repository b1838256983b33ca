"""Spark result against DuckDB result: same columns, same rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def normal(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """``None`` if equal, else a short description."""
    mine = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        only_mine, only_theirs = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
        return f"rows {len(mine[1])} != {len(theirs[1])}; e.g. {list(only_mine)[:2]} / {list(only_theirs)[:2]}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{mine[0]}: {a} != {b}"[:3000]
    return None
