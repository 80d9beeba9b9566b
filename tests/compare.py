"""A query against its oracle: columns, row count, values (doubles by 12 digits) and kinds of types."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
from pyspark.sql import SparkSession

from brindle.session import TABLES


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}") + 0.0
    if isinstance(x, decimal.Decimal):
        return float(f"{x:.12g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(rows, columns):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in at) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


def kinds(rows):
    """Python types by column: a date is not a timestamp, a text not a number."""
    fix = {decimal.Decimal: float, bool: bool}
    return [{fix.get(type(x), type(x)) for x in col if x is not None} or {None} for col in zip(*rows)] if rows else []


def compared(spark: SparkSession, run, oracle: str, sf_dir: str, con: duckdb.DuckDBPyConnection) -> None:
    df = run(spark, sf_dir)
    mine = rows_of([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(oracle)
    theirs_columns = [d[0] for d in cur.description]
    theirs = rows_of(cur.fetchall(), theirs_columns)
    assert sorted(df.columns) == sorted(theirs_columns)
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not wrong, wrong[:3]
    assert kinds(mine) == kinds(theirs), (kinds(mine), kinds(theirs))
    assert datetime
