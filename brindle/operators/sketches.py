"""Sketches that are stored once and rolled up without the rows they came from.

A row of a stored table holds, for its group, an HLL and a theta sketch of distinct keys, a KLL sketch of a measure, and exact
counts, sums and extremes. Any coarser grouping is made of them by merging, which gives what the rows themselves would: HLL and theta unions
are those of the unions of keys, KLL's stay within the same rank error. New rows are a sketch of their own, merged in without
touching the old. Theta sketches also tell what two groups have in common. All merges are aggregates with partial sums: a
group's sketches never meet in one place before they are merged, and each is of bounded size.

Groups without keys or measures (null all over) have null sketches, which merge as nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the number of registers (HLL), of entries (theta); KLL's k. Relative error at these: HLL 1.04 / sqrt(2**LG), theta 1 / sqrt(2**LG), KLL's rank 1.33 % at 200.
HLL_LG, THETA_LG, KLL_K = 12, 14, 800
FIELDS = ("n", "total", "least", "most", "hll", "theta", "kll")


def sketched(rows: DataFrame, by: list[str | Column], key: str, measure: str) -> DataFrame:
    """A row for each group of `by`: the group, and FIELDS of its keys and measures."""
    value = F.col(measure).cast("double")
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.hll_sketch_agg(key, HLL_LG).alias("hll"), F.theta_sketch_agg(key, THETA_LG).alias("theta"), F.kll_sketch_agg_double(value, KLL_K).alias("kll"),
    )


def rolled_up(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """The same for coarser groups, from sketches alone."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta", THETA_LG).alias("theta"), F.kll_merge_agg_double("kll", KLL_K).alias("kll"),
    )


def distinct_hll() -> Column:
    return F.hll_sketch_estimate("hll")


def distinct_theta(sketch: str | Column = "theta") -> Column:
    return F.theta_sketch_estimate(sketch)


def quantile(q: float) -> Column:
    return F.kll_sketch_get_quantile_double("kll", F.lit(q))


def in_common(a: str | Column, b: str | Column) -> Column:
    """Estimate of how many keys two groups share."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b))
