"""The queries of the library by name: each pairs a Spark form with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.plans import extension, relational, scalars, sources, streams
from brindle.plans.query import Query
from brindle.session import table


def regional_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue in ASIA by the supplier's nation, for customers of the same nation."""
    t = lambda name: table(spark, sf_dir, name)
    nations = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(revenue.alias("revenue"))
    )


REGIONAL_REVENUE = """
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY n_name
"""


def _every() -> dict[str, Query]:
    return {"regional_revenue": Query(regional_revenue, REGIONAL_REVENUE)} | relational.QUERIES | scalars.QUERIES | sources.QUERIES | streams.QUERIES | extension.QUERIES


def queries() -> dict:
    return {name: q.run for name, q in _every().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in _every().items() if q.oracle}
