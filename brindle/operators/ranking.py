"""Ranking helpers: the best rows of each group, filters on windows, frames of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, place: str | None = None) -> DataFrame:
    """The first k rows of each group. Spark keeps k rows of each group before it shuffles (WindowGroupLimit)."""
    name = place or "_place"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col(name) <= k)
    return out if place else out.drop(name)


def qualify(df: DataFrame, value: Column, condition) -> DataFrame:
    """Rows for which condition(value) holds, where value is a window expression."""
    return df.withColumn("_value", value).where(condition(F.col("_value"))).drop("_value")


def sum_over_groups(df: DataFrame, by: list[str], order: str, value: str, before: int, name: str) -> DataFrame:
    """A GROUPS frame: the sum of value over the rows of this and the `before` preceding distinct values of order."""
    rank = Window.partitionBy(*by).orderBy(order)
    ranked = df.withColumn("_g", F.dense_rank().over(rank))
    frame = Window.partitionBy(*by).orderBy("_g").rangeBetween(-before, 0)
    return ranked.withColumn(name, F.sum(value).over(frame)).drop("_g")
