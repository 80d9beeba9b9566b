import os

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import datasource as api
from pyspark.sql import functions as F

from brindle.plans.workspace import workspace
from brindle.sources import ledger

COLUMNS = "id long, name string, x double, at timestamp_ntz"


@pytest.fixture
def path(spark):
    ledger.register(spark)
    return workspace(spark)


def numbered(spark, begin, end, parts=4):
    return spark.range(begin, end, 1, parts).selectExpr("id", "if(id % 5 = 0, null, concat('n', lpad(id, 4, '0'))) as name", "id / 3 as x", "timestamp_ntz '2024-01-01' + make_dt_interval(0, id) as at")


def segments(path):
    return ledger.Log(path).segments()


def test_round_trip(spark, path):
    rows = numbered(spark, 0, 500)
    ledger.save(rows, path)
    assert sorted(map(tuple, ledger.load(spark, path, rows.schema).collect())) == sorted(map(tuple, rows.collect()))
    assert spark.read.format("ledger").option("path", path).load().schema.names == rows.schema.names
    assert sum(s.rows for s in segments(path)) == 500


def read_with(path, schema, *filters):
    """The filters that are left to Spark, the segments that are opened, and the rows that leave them."""
    reader = ledger.Reader(path, schema)
    left = list(reader.pushFilters(list(filters)))
    parts = reader.partitions()
    return left, [p for p in parts if p.file], [r for p in parts for b in reader.read(p) for r in b.to_pylist()]


def test_filters_reach_the_files(spark, path):
    schema = numbered(spark, 0, 1).schema
    ledger.save(numbered(spark, 0, 400), path)
    left, opened, rows = read_with(path, schema, api.GreaterThanOrEqual(("id",), 350), api.IsNotNull(("name",)))
    assert not left and len(opened) == 1 and [r["id"] for r in rows] == [k for k in range(350, 400) if k % 5]
    left, opened, rows = read_with(path, schema, api.In(("id",), (3, 399)), api.StringStartsWith(("name",), "n0"))
    assert not left and len(opened) == 2 and [r["id"] for r in rows] == [3, 399]
    left, opened, rows = read_with(path, schema, api.EqualTo(("name",), "zz"))
    assert not left and not opened and not rows
    left, opened, rows = read_with(path, schema, api.GreaterThan(("x",), 100.0), api.StringEndsWith(("name",), "1"))
    assert len(left) == 2 and len(opened) == 4 and len(rows) == 400


def test_filters_are_in_the_plan(spark, path):
    rows = numbered(spark, 0, 400)
    ledger.save(rows, path)
    got = ledger.load(spark, path, rows.schema, ["id", "x"]).where("id > 390 and x < 131")
    assert [r.id for r in got.orderBy("id").collect()] == [391, 392]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan ledger" in plan and "131.0" in plan and "390" not in plan  # what was pushed is no filter of Spark's any more
    assert got.schema.names == ["id", "x"]


def test_only_the_columns_asked_for_are_read(spark, path, monkeypatch):
    rows = numbered(spark, 0, 50)
    ledger.save(rows, path)
    read = []
    real = ledger.ds.dataset

    class Watched:
        def __init__(self, *a, **k):
            self.of = real(*a, **k)

        def to_batches(self, columns, **k):
            read.append(columns)
            return self.of.to_batches(columns=columns, **k)

    monkeypatch.setattr(ledger.ds, "dataset", Watched)
    one = rows.select("x").schema
    assert sum(b.num_rows for s in segments(path) for b in ledger.read_segment(path, one, s, None)) == 50
    assert read and all(c == ["x"] for c in read)


@pytest.mark.parametrize("condition", ["id = 7", "name is null", "name > 'n0100' and name <= 'n0200'", "id in (1, 2, 1000)", "name like 'n01%'", "name like '%7'", "not (id < 300)", "x > 50 or id = 1", "x is null", "name <=> null", "id % 7 = 3"])
def test_filters_equal_sparks_own(spark, path, condition):
    rows = numbered(spark, 0, 400)
    ledger.save(rows, path)
    assert sorted(r.id for r in ledger.load(spark, path, rows.schema).where(condition).collect()) == sorted(r.id for r in rows.where(condition).collect())


def test_a_failed_task_leaves_no_rows(spark, path):
    rows = numbered(spark, 0, 100)
    ledger.save(rows, path)
    bad = rows.withColumn("name", F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException):
        ledger.save(bad, path)
    assert ledger.load(spark, path, rows.schema).count() == 100
    assert len(ledger.Log(path).numbers()) == 1


def test_what_is_aborted_is_deleted(spark, path):
    batch = pa.RecordBatch.from_pydict({"id": [1, 2]})
    written = ledger.write_segments(path, iter([batch]))
    ledger.Writer(path, False).abort([written, None])
    assert os.listdir(ledger.file_system(path)[1] + "/data") == []


def test_overwrite_and_append(spark, path):
    rows = numbered(spark, 0, 90)
    ledger.save(rows.where("id < 10"), path)
    ledger.save(rows.where("id >= 50"), path, "overwrite")
    ledger.save(rows.where("id = 20"), path)
    assert sorted(r.id for r in ledger.load(spark, path, rows.schema).collect()) == [20, *range(50, 90)]


def test_streams_read_each_commit_once(spark, path):
    sink, checkpoint = workspace(spark), workspace(spark)
    schema = numbered(spark, 0, 1).schema
    for k in range(3):
        ledger.save(numbered(spark, 100 * k, 100 * k + 100), path)
        ledger.save_stream(ledger.load_stream(spark, path, schema), sink, checkpoint, "copy")
        assert ledger.load(spark, sink, schema).count() == 100 * (k + 1)
    ledger.save_stream(ledger.load_stream(spark, path, schema), sink, checkpoint, "copy")
    assert sorted(r.id for r in ledger.load(spark, sink, schema).collect()) == list(range(300))


def test_a_batch_that_runs_again_is_not_written_twice(path):
    writer = ledger.StreamWriter(path, "s")
    for n in (0, 1, 1, 0, 2):
        writer.commit([ledger.write_segments(path, iter([pa.RecordBatch.from_pydict({"n": [n]})]))], n)
    assert [s.bounds["n"]["min"] for s in segments(path)] == [0, 1, 2]
    assert len(os.listdir(ledger.file_system(path)[1] + "/data")) == 3


def test_a_stream_does_not_pass_over_replaced_rows(spark, path):
    rows = numbered(spark, 0, 10)
    ledger.save(rows, path)
    ledger.save(rows, path, "overwrite")
    assert len(ledger.StreamReader(path, rows.schema).partitions({"commits": 0}, {"commits": 2})) == len(segments(path))
    with pytest.raises(ValueError):
        ledger.StreamReader(path, rows.schema).partitions({"commits": 1}, {"commits": 2})


def test_empty_tables(spark, path):
    schema = numbered(spark, 0, 1).schema
    ledger.save(numbered(spark, 0, 0), path)
    assert ledger.load(spark, path, schema).count() == 0
    assert ledger.load(spark, workspace(spark), schema).count() == 0
