"""The extension surface: functions in Python, by batches of Arrow or pandas, and in SQL."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@F.udf(StringType(), useArrow=True)
def initials(name: str) -> str:
    """First letters of the words, row by row."""
    return "".join(w[0] for w in name.split()) if name else name


@F.arrow_udf(DoubleType())
def discounted(price: pa.Array, discount: pa.Array) -> pa.Array:
    return pc.multiply(price, pc.subtract(1.0, discount))


@F.pandas_udf(DoubleType())
def spread(v: pd.Series) -> float:
    """An aggregate: greatest minus least."""
    return float(v.max() - v.min())


@F.udtf(returnType="word string, place int")
class Words:
    """A row for each word."""

    def eval(self, text: str):
        for k, w in enumerate(text.split() if text else []):
            yield w, k


@F.udtf
class Runs:
    """Runs of rows with equal values in one column, within a partition, in its order: TABLE(t) PARTITION BY ... ORDER BY ..., and the names of three columns.

    The output's types are those of the columns named (analyze). A partition streams through: nothing but the run at hand is held.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, of: AnalyzeArgument, first: AnalyzeArgument) -> AnalyzeResult:
        kinds = {f.name: f.dataType for f in rows.dataType.fields}
        for name in (key, of, first):
            if not name.isConstantExpression or name.value not in kinds:
                raise ValueError(f"no such column: {name.value}")
        fields = [StructField(n.value, kinds[n.value]) for n in (key, of, first)]
        return AnalyzeResult(StructType([*fields, StructField("length", LongType())]), partitionBy=[PartitioningColumn(key.value)], orderBy=[OrderingColumn(first.value)])

    def __init__(self):
        self.run = None

    def eval(self, row, key: str, of: str, first: str):
        if self.run and self.run[1] == row[of]:
            self.run[3] += 1
            return
        if self.run:
            yield tuple(self.run)
        self.run = [row[key], row[of], row[first], 1]

    def terminate(self):
        if self.run:
            yield tuple(self.run)


@F.udtf(returnType="user_id long, gap_start timestamp_ntz, seconds long")
class Gaps:
    """Times between a user's events of more than `least` seconds; the call says PARTITION BY and ORDER BY."""

    def __init__(self):
        self.last = None

    def eval(self, row, least: int):
        if self.last is not None:
            seconds = int((row["ts"] - self.last).total_seconds())
            if seconds > least:
                yield row["user_id"], self.last, seconds
        self.last = row["ts"]


def centred(pdf: pd.DataFrame) -> pd.DataFrame:
    """A group's values less its median."""
    return pdf.assign(value=(pdf["value"] - pdf["value"].median()).round(6))


def long_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield b.filter(pc.greater(pc.utf8_length(b.column("p_name")), 10))
