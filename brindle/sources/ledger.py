"""A table format with a log of commits, as a data source in Python: parquet segments, and one log entry for each write.

    <path>/data/<name>.parquet      a segment, written by one task
    <path>/log/<number>.json        a commit: its segments with rows and bounds of each column, and whether it replaces what was before

A reader sees what the log names and nothing else, so a task or job that failed leaves no rows; abort deletes its segments. Reading a table
takes the log on the driver (a line for each segment) and segments in tasks:

- columns: those of the schema that is asked for (`load(..., columns)`), no others are read;
- filters: comparisons, null tests, sets and prefixes are pushed down. Segments whose bounds rule them out are not opened, in the others
  parquet's row groups are skipped and rows are filtered before they become Spark's; what cannot be pushed goes back to Spark;
- as a stream: an offset is a number of commits, a batch is the segments of those between two offsets. A commit that replaces is an error for a stream that has
  read what it replaces.

Written as a batch (append, overwrite) or as a stream. A stream's commit carries the stream's name and batch number, and a batch that is
already in the log is not written again: exactly once, if the stream is given a name of its own (option `stream`). One writer at a time for a
table: the log's numbers are not contended for. Paths are local ones, file: URIs or what pyarrow's file systems open; all machines must see them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as api
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "ledger"
SEGMENT_ROWS = 1_000_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path.rstrip("/")) if path.startswith("/") else pafs.FileSystem.from_uri(path.rstrip("/"))


@dataclass
class Segment(api.InputPartition):
    """A part of a table; bounds are least, greatest and number of nulls by column, of types that JSON can say."""

    file: str
    rows: int
    bounds: dict = field(default_factory=dict)


@dataclass
class Written(api.WriterCommitMessage):
    segments: list


class Log:
    def __init__(self, path: str):
        self.fs, self.base = file_system(path)

    def numbers(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.base}/log", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))

    def entry(self, number: int) -> dict:
        with self.fs.open_input_stream(f"{self.base}/log/{number:020d}.json") as f:
            return json.loads(f.read())

    def segments(self, after: int = 0, until: int | None = None) -> list[Segment]:
        """Of commits `after` + 1 to `until` (all); what a commit replaced before them does not count."""
        out: list[Segment] = []
        for n in self.numbers():
            if n > after and (until is None or n <= until):
                one = self.entry(n)
                if one["replaces"]:
                    if after:
                        raise ValueError(f"commit {n} replaces rows that the stream has read")
                    out = []
                out += [Segment(**s) for s in one["segments"]]
        return out

    def batch(self, stream: str) -> int:
        """The last batch of a stream that is in the log, or -1."""
        return max((e["batch"] for e in map(self.entry, self.numbers()) if e["stream"] == stream), default=-1)

    def commit(self, segments: list[Segment], replaces: bool, stream: str | None = None, batch: int | None = None) -> None:
        """Whole or not at all: the entry is written under another name first."""
        number = max(self.numbers(), default=0) + 1
        self.fs.create_dir(f"{self.base}/log", recursive=True)
        held = {"segments": [s.__dict__ for s in segments], "replaces": replaces, "stream": stream, "batch": batch}
        aside = f"{self.base}/log/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(aside) as f:
            f.write(json.dumps(held).encode())
        self.fs.move(aside, f"{self.base}/log/{number:020d}.json")

    def drop(self, messages) -> None:
        for s in (s for m in messages if m for s in m.segments):
            self.fs.delete_file(f"{self.base}/data/{s.file}")


def _plain(x):
    """A bound as JSON has it; None if there is no such form."""
    return x if isinstance(x, (int, str)) and not isinstance(x, bool) and (not isinstance(x, str) or len(x) <= 64) else None


def _bounds(table: pa.Table) -> dict:
    out = {}
    for name, column in zip(table.column_names, table.columns):
        if pa.types.is_integer(column.type) or pa.types.is_string(column.type):
            ends = pc.min_max(column)
            least, most = _plain(ends["min"].as_py()), _plain(ends["max"].as_py())
            known = least is not None and most is not None
            out[name] = {"min": least if known else None, "max": most if known else None, "nulls": column.null_count}
    return out


def write_segments(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    """A task's rows, SEGMENT_ROWS to a segment."""
    fs, base = file_system(path)
    fs.create_dir(f"{base}/data", recursive=True)
    done: list[Segment] = []
    held: list[pa.RecordBatch] = []

    def flush() -> None:
        nonlocal held
        table = pa.Table.from_batches(held)
        name = f"{uuid.uuid4().hex}.parquet"
        with fs.open_output_stream(f"{base}/data/{name}") as f:
            pq.write_table(table, f)
        done.append(Segment(name, table.num_rows, _bounds(table)))
        held = []

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SEGMENT_ROWS:
                flush()
    if held:
        flush()
    return Written(done)


_COMPARED = {
    api.EqualTo: lambda c, v: c == v, api.GreaterThan: lambda c, v: c > v, api.GreaterThanOrEqual: lambda c, v: c >= v,
    api.LessThan: lambda c, v: c < v, api.LessThanOrEqual: lambda c, v: c <= v,
}


def expression(f: api.Filter, schema: StructType):
    """The filter for pyarrow, where it says the same there; else None."""
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name is None or name not in schema.names:
        return None
    column, kind = pc.field(name), schema[name].dataType.typeName()
    if isinstance(f, api.IsNull):
        return column.is_null()
    if isinstance(f, api.IsNotNull):
        return column.is_valid()
    if kind not in ("string", "integer", "long", "short", "byte"):  # Spark and pyarrow differ on NaN and on zones
        return None
    if type(f) in _COMPARED:
        return _COMPARED[type(f)](column, f.value) if f.value is not None else None
    if isinstance(f, api.In):
        return column.isin(list(f.value)) if all(v is not None for v in f.value) else None
    if isinstance(f, api.StringStartsWith):
        return pc.starts_with(column, f.value)
    return None


def ruled_out(f: api.Filter, bounds: dict, rows: int) -> bool:
    """Whether the bounds of a segment leave no row to the filter."""
    b = bounds.get(f.attribute[0])
    if b is None:
        return False
    if isinstance(f, api.IsNull):
        return b["nulls"] == 0
    if isinstance(f, api.IsNotNull):
        return b["nulls"] == rows
    low, high = b["min"], b["max"]
    if low is None:
        return False
    if isinstance(f, api.EqualTo):
        return not low <= f.value <= high
    if isinstance(f, api.GreaterThan):
        return high <= f.value
    if isinstance(f, api.GreaterThanOrEqual):
        return high < f.value
    if isinstance(f, api.LessThan):
        return low >= f.value
    if isinstance(f, api.LessThanOrEqual):
        return low > f.value
    if isinstance(f, api.In):
        return not any(low <= v <= high for v in f.value)
    if isinstance(f, api.StringStartsWith):
        return high < f.value or low[: len(f.value)] > f.value
    return False


def read_segment(path: str, schema: StructType, segment: Segment, condition) -> Iterator[pa.RecordBatch]:
    fs, base = file_system(path)
    want = to_arrow_schema(schema)
    data = ds.dataset(f"{base}/data/{segment.file}", filesystem=fs, format="parquet")
    for batch in data.to_batches(columns=schema.names, filter=condition, batch_size=10_000):
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, want)], schema=want)


class Reader(api.DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.filters = path, schema, []

    def pushFilters(self, filters: list[api.Filter]):
        for f in filters:
            if expression(f, self.schema) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Segment]:
        return [s for s in Log(self.path).segments() if not any(ruled_out(f, s.bounds, s.rows) for f in self.filters)] or [Segment("", 0)]

    def read(self, partition: Segment):
        if not partition.file:
            return
        condition = None
        for f in self.filters:
            one = expression(f, self.schema)
            condition = one if condition is None else condition & one
        yield from read_segment(self.path, self.schema, partition, condition)


class StreamReader(api.DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"commits": 0}

    def latestOffset(self) -> dict:
        return {"commits": max(Log(self.path).numbers(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return Log(self.path).segments(start["commits"], end["commits"])

    def read(self, partition: Segment):
        yield from read_segment(self.path, self.schema, partition, None)


class Writer(api.DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator):
        return write_segments(self.path, iterator)

    def commit(self, messages) -> None:
        Log(self.path).commit([s for m in messages if m for s in m.segments], self.overwrite)

    def abort(self, messages) -> None:
        Log(self.path).drop(messages)


class StreamWriter(api.DataSourceStreamArrowWriter):
    def __init__(self, path: str, stream: str):
        self.path, self.stream = path, stream

    def write(self, iterator):
        return write_segments(self.path, iterator)

    def commit(self, messages, batchId: int) -> None:
        log = Log(self.path)
        if batchId <= log.batch(self.stream):  # a batch run again after it was committed
            log.drop(messages)
        else:
            log.commit([s for m in messages if m for s in m.segments], False, self.stream, batchId)

    def abort(self, messages, batchId: int) -> None:
        Log(self.path).drop(messages)


class Ledger(api.DataSource):
    """Options: path; stream, the name of a stream that writes."""

    @classmethod
    def name(cls) -> str:
        return NAME

    @property
    def path(self) -> str:
        return self.options["path"]

    def schema(self) -> StructType:
        """That of the last segment in the log."""
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, base = file_system(self.path)
        for s in reversed(Log(self.path).segments()):
            with fs.open_input_file(f"{base}/data/{s.file}") as f:
                return from_arrow_schema(pq.read_schema(f))
        raise ValueError("an empty ledger: give its schema")

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.path, schema)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.path, schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.path, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.path, self.options.get("stream", os.path.basename(self.path)))


def register(spark: SparkSession) -> None:
    """Makes the format known; filters are pushed to sources in Python only where this setting says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Ledger)


def save(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.format(NAME).mode(mode).option("path", path).save()


def load(spark: SparkSession, path: str, schema: StructType, columns: list[str] | None = None) -> DataFrame:
    """schema: the table's; columns: those to read."""
    wanted = StructType([schema[c] for c in columns]) if columns else schema
    return spark.read.format(NAME).schema(wanted).option("path", path).load()


def load_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.format(NAME).schema(schema).option("path", path).load()


def save_stream(df: DataFrame, path: str, checkpoint: str, stream: str) -> None:
    """Run to the end of what is there."""
    df.writeStream.format(NAME).outputMode("append").option("path", path).option("stream", stream).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
