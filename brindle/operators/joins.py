"""Joins that Spark has no operator for: by nearest time, and by ranges, without comparing all pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, columns: list[str], inclusive: bool = True, span: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each row of left with `columns` of the last row of right of the same `by` at or before (or strictly before) its time.

    Both sides are put in one sequence for each key and the last row of right is carried along: one shuffle and one sort,
    whatever the number of rows of right before each row of left. Rows of left whose time is null get nulls; keys
    that are null never meet; of rows of right at one time the one with the greatest columns counts. Names of `columns` must not be in left.

    span: for keys with more rows than a task should sort, a function of time that never falls (a day, say). Sequences are then of a key
    and a span; what earlier spans leave comes from their last rows, of which there is one for each key and span.
    """
    after, before = (1, 0) if inclusive else (0, 1)
    l = left.select(F.struct(*left.columns).alias("_l"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col(left_time).alias("_t"), F.lit(after).alias("_side"), F.lit(None).cast(right.select(F.struct(*columns)).schema[0].dataType).alias("_r"))
    r = right.where(F.col(right_time).isNotNull())
    r = r.select(F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col(right_time).alias("_t"), F.lit(before).alias("_side"), F.struct(*columns).alias("_r"))
    keys = [f"_k{i}" for i in range(len(by))]
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)) & F.col("_t").isNotNull()
    every = l.unionByName(r)
    parts = keys
    if span is not None:
        parts, every = [*keys, "_span"], every.withColumn("_span", span(F.col("_t")))
    order = Window.partitionBy(*parts).orderBy("_t", "_side", F.col("_r").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    out = every.withColumn("_got", F.when(known, F.last("_r", ignorenulls=True).over(order))).where("_l is not null")
    if span is not None:
        # the last row of right of each key and span, and what it is for the spans behind
        ends = every.where(known).groupBy(*parts).agg(F.max(F.when(F.col("_r").isNotNull(), F.struct("_t", "_r")))["_r"].alias("_end"))
        carried = ends.select(*(F.col(c).alias(f"{c}_") for c in parts), F.last("_end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
        out = out.join(carried, reduce(lambda a, b: a & b, (F.col(c) == F.col(f"{c}_") for c in parts)), "left").withColumn("_got", F.when(known, F.coalesce("_got", "_earlier")))
    return out.select("_l.*", *(F.col(f"_got.{c}").alias(c) for c in columns))


def range_join(left: DataFrame, right: DataFrame, left_value: Column, right_low: Column, right_high: Column, width: float) -> DataFrame:
    """Pairs with right_low <= left_value < right_high (numbers), by buckets of `width`: an equality join on the buckets that
    a range touches, the range itself as filter. width should be about the length of the ranges."""
    l = left.withColumn("_bucket", F.floor(left_value / width))
    r = right.withColumn("_bucket", F.explode(F.sequence(F.floor(right_low / width), F.floor(right_high / width))))
    return l.join(r, "_bucket").where((left_value >= right_low) & (left_value < right_high)).drop("_bucket")


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int) -> DataFrame:
    """An inner join on a key that few values of which hold most of left: left is dealt over `salts`, right repeated for each."""
    l = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return l.join(r, [key, "_salt"]).drop("_salt")


def not_in(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of left whose `key` is NOT IN the `value`s of right, as SQL has it: none if one of these is null, all if there are none; a key that is null stays only then.

    Spark's own null-aware join broadcasts right whatever its size and holds it on the driver. Here one number (by a scalar subquery) says whether right has
    rows and nulls, and what is left is an anti join like any other: shuffled, or broadcast where right is below the threshold.
    """
    kind = right.agg(F.max(F.when(F.col(value).isNull(), 2).otherwise(1))).scalar()  # null: no rows; 2: a null among them
    asked = left.where(kind.isNull() | ((kind == 1) & F.col(key).isNotNull()))
    values = right.select(F.col(value).alias("_value")).where("_value is not null")
    return asked.join(values, F.col(key) == F.col("_value"), "left_anti")


def broadcast_below(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df marked for broadcast if it has at most `most` rows (counted no further than that), else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
