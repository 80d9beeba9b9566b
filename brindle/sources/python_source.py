"""A data source in Python: numbers with their squares, read in partitions, as a pattern for sources of one's own."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Squares(DataSource):
    """Options: rows (how many), partitions."""

    @classmethod
    def name(cls) -> str:
        return "squares"

    def schema(self) -> str:
        return "n bigint, square bigint"

    def reader(self, schema) -> DataSourceReader:
        return SquaresReader(int(self.options.get("rows", "100")), int(self.options.get("partitions", "4")))


class SquaresReader(DataSourceReader):
    def __init__(self, rows: int, parts: int):
        self.rows, self.parts = rows, parts

    def partitions(self) -> list[InputPartition]:
        step = -(-self.rows // self.parts) or 1
        return [InputPartition((a, min(a + step, self.rows))) for a in range(0, self.rows, step)] or [InputPartition((0, 0))]

    def read(self, partition):
        begin, end = partition.value
        for n in range(begin, end):
            yield n, n * n


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Squares)
