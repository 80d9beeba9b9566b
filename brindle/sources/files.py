"""Reading and writing files, each format with what it needs to give back the rows it got."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text formats keep milliseconds unless told otherwise.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Options by format, for writing and reading alike.
OPTIONS: dict[str, dict[str, str]] = {
    "parquet": {}, "orc": {}, "json": {"ignoreNullFields": "false", "timestampNTZFormat": MICROS}, "text": {},
    "csv": {"header": "true", "timestampNTZFormat": MICROS, "nullValue": "\\N", "escape": '"', "emptyValue": ""}, "xml": {"rowTag": "row", "timestampNTZFormat": MICROS, "nullValue": "\\N"},
}


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists", partition_by: list[str] | None = None, **options: str) -> None:
    writer = df.write.format(kind).mode(mode).options(**(OPTIONS[kind] | options))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: StructType | str | None = None, **options: str) -> DataFrame:
    """Text formats want a schema: inferring one reads everything twice."""
    reader = spark.read.format(kind).options(**(OPTIONS[kind] | options))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, modificationTime, length, content of each file. Select what is needed: content is read only if asked for."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def compacted(df: DataFrame, path: str, cluster_by: list[str], rows_per_file: int = 1_000_000) -> None:
    """Write sorted by ranges of cluster_by, so that filters on them skip files and row groups."""
    df.repartitionByRange(*map(F.col, cluster_by)).sortWithinPartitions(*cluster_by).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
