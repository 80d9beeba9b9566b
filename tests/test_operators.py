"""Helpers on inputs that the tables lack: nulls, ties, empty sides, late events; and the plans they should have."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brindle.functions.vectors import cosine, dot
from brindle.operators.joins import asof_join, broadcast_below, not_in, range_join, salted_join
from brindle.operators.ranking import sum_over_groups, top_k
from brindle.plans import registry
from brindle.plans.workspace import workspace
from brindle.session import table
from brindle.streaming import windows as w


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("inclusive, want", [(True, [(1, "b"), (2, None), (3, "c"), (4, None), (5, None)]), (False, [(1, "a"), (2, None), (3, "c"), (4, None), (5, None)])])
def test_asof_nulls_and_ties(spark, inclusive, want):
    left = spark.createDataFrame([(1, "x", 5), (2, "x", 0), (3, "y", 9), (4, None, 9), (5, "x", None)], "id int, k string, t int")
    right = spark.createDataFrame([("x", 1, "a"), ("x", 5, "b"), ("x", 6, "z"), ("y", 2, "c"), ("y", 2, "b"), (None, 1, "n"), ("x", None, "q")], "k string, t int, v string")
    assert sorted(map(tuple, asof_join(left, right, ["k"], "t", "t", ["v"], inclusive).select("id", "v").collect())) == want
    for span in (1, 3, 100):
        got = asof_join(left, right, ["k"], "t", "t", ["v"], inclusive, lambda t: F.floor(t / span))
        assert sorted(map(tuple, got.select("id", "v").collect())) == want
    assert asof_join(left, right.limit(0), ["k"], "t", "t", ["v"]).where("v is not null").count() == 0


def test_range_join_is_not_quadratic(spark):
    a = spark.range(50).select((F.col("id") * 3).alias("x"))
    b = spark.range(20).select((F.col("id") * 7).alias("lo"), (F.col("id") * 7 + 10).alias("hi"))
    got = range_join(a, b, F.col("x"), F.col("lo"), F.col("hi"), 10)
    assert sorted(map(tuple, got.select("x", "lo").collect())) == sorted((3 * x, 7 * y) for x in range(50) for y in range(20) if 7 * y <= 3 * x < 7 * y + 10)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_salted_join_equals_join(spark):
    a = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    b = spark.createDataFrame([(0, "z"), (1, "o")], "k long, v string")
    assert sorted(map(tuple, salted_join(a, b, "k", 5).select("id", "v").collect())) == sorted(map(tuple, a.join(b, "k").select("id", "v").collect()))


@pytest.mark.parametrize("keys, values", [([1, 2, None], [2, 2, 3]), ([1, 2, None], [2, None]), ([1, 2, None], []), ([], [2, None]), ([1, 2, 2, None], [None]), ([1, 1, None], [2])])
def test_not_in_is_sqls(spark, keys, values):
    left, right = spark.createDataFrame([(k,) for k in keys], "k long"), spark.createDataFrame([(v,) for v in values], "v long")
    want = spark.sql("SELECT k FROM {l} WHERE k NOT IN (SELECT v FROM {r})", l=left, r=right)
    order = lambda df: sorted(df.collect(), key=str)
    assert order(not_in(left, right, "k", "v")) == order(want)
    assert order(not_in(left, left.where("k = 1"), "k", "k")) == order(left.where("k <> 1" if 1 in keys else "true"))


@pytest.mark.parametrize("name", ["j9_not_in", "j9_not_in_null"])
def test_not_in_obeys_the_broadcast_threshold(spark, sf_dir, name):
    """Spark's null-aware join broadcasts its right side whatever its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(registry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "Broadcast" not in p, p


def test_broadcast_only_below(spark):
    a = spark.range(1000)
    assert "BroadcastHashJoin" in plan(a.join(broadcast_below(spark.range(10), 10), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(a.join(broadcast_below(spark.range(11), 10), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(top_k(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice")], 2))


def test_groups_frame_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (4, 1), (9, None)], "o int, v int").withColumn("k", F.lit(1))
    got = {(r.o, r.v): r.s for r in sum_over_groups(df, ["k"], "o", "v", 1, "s").collect()}
    assert got == {(1, 10): 30, (1, 20): 30, (2, 5): 35, (4, 1): 6, (9, None): 1}


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [tuple(r) for r in df.select(dot(F.col("a"), F.col("b")), F.round(cosine(F.col("a"), F.col("b")), 6)).collect()] == [(11.0, 0.98387), (0.0, None), (None, None)]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(registry.queries()["p2_filter"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,150000.0)" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan(registry.queries()["s5_partitioned"](spark, sf_dir))


@pytest.mark.parametrize("name", ["a1_grouped", "a5_cube", "w4_rows_frame", "w7_groups_frame", "j14_asof"])
def test_partitioning_changes_nothing(spark, sf_dir, name, monkeypatch):
    from brindle.plans import query

    run = registry.queries()[name]
    want = sorted(map(str, run(spark, sf_dir).collect()))
    monkeypatch.setattr(query, "table", lambda s, d, n: table(s, d, n).repartition(8))
    assert sorted(map(str, run(spark, sf_dir).collect())) == want


@pytest.mark.parametrize("name", ["a1_grouped", "j6_full_outer", "j14_asof", "w1_ranks", "o2_top_k", "f5_vectors", "x5_grouped_map", "f3_dates"])
def test_empty_tables(spark, sf_dir, name, monkeypatch):
    from brindle.plans import query

    monkeypatch.setattr(query, "table", lambda s, d, n: table(s, d, n).limit(0))
    assert registry.queries()[name](spark, sf_dir).count() == 0


def test_late_events_are_dropped_after_the_watermark(spark):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    path = workspace(spark)
    for k, rows in enumerate(([(1, at(0, 10))], [(2, at(5, 0))], [(3, at(6, 0))], [(4, at(0, 20))])):
        spark.createDataFrame([(i, t, 1, "view") for i, t in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string").coalesce(1).write.mode("append").parquet(f"{path}/b{k}")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string"
    checkpoint, out = workspace(spark), workspace(spark)
    for upto in range(1, 5):
        src = spark.readStream.schema(schema).parquet(f"{path}/b[0-{upto - 1}]")
        late = w.run_to_files(w.tumbling(src, "1 hour", "1 hour"), out, checkpoint)
        assert late == (upto == 4)
    got = sorted((r.start.hour, r.n) for r in spark.read.parquet(out).collect())
    assert got[0] == (0, 1)


def test_the_state_store_of_other_queries_stays(spark, sf_dir):
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    registry.queries()["t7_state"](spark, sf_dir)
    assert spark.conf.get(conf) == before != w.ROCKSDB


def test_restart_loses_and_repeats_nothing(spark, sf_dir):
    path, out, checkpoint = workspace(spark), workspace(spark), workspace(spark)
    events = table(spark, sf_dir, "events")
    for part in ("event_id < 300", "event_id >= 300"):
        events.where(part).write.mode("append").parquet(path)
        w.run_to_files(spark.readStream.schema(events.schema).parquet(path), out, checkpoint)
    assert spark.read.parquet(out).count() == events.count() == spark.read.parquet(out).select("event_id").distinct().count()
