"""A registered query: its Spark form and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from brindle.session import table


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def sql(text: str, oracle: str | None = None) -> Query:
    """A query in SQL with its tables in braces; the oracle is the same text unless the dialects differ."""
    names = sorted(set(re.findall(r"\{(\w+)\}", text)))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})

    return Query(run, re.sub(r"\{(\w+)\}", r"\1", oracle or text))


def frame(build: Callable[..., DataFrame], tables: str, oracle: str | None) -> Query:
    """A query on DataFrames: build takes the named tables in order."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(*(table(spark, sf_dir, n) for n in tables.split()))

    return Query(run, oracle)
