"""Sessions and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; on a cluster use its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("brindle")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; only Spark's reader touches the path, so any Hadoop file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> None:
    """Temporary views of the tables, for SQL."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
