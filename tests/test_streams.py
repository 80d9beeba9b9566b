"""Keyed state, timers, upserts and sketches, beyond what the queries' rows show."""

import pytest
from pyspark.sql import functions as F

from brindle.operators import sketches
from brindle.plans import streams
from brindle.plans.workspace import workspace
from brindle.streaming import visits
from brindle.streaming import windows as w
from brindle.streaming.upserts import Upserts

EVENTS = "event_id long, user_id long, event_type string, ts timestamp_ntz"


@pytest.fixture
def rocksdb(spark):
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    spark.conf.set(conf, w.ROCKSDB)
    yield
    spark.conf.set(conf, before)


def batches(spark, *parts):
    """A stream of one file and batch for each part."""
    path = workspace(spark)
    for part in parts:
        spark.sql(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)


def at(*rows):
    return " UNION ALL ".join(f"SELECT {e}L AS event_id, {u}L AS user_id, '{k}' AS event_type, timestamp_ntz '2024-01-01 {t}' AS ts" for e, u, k, t in rows)


def run(spark, df):
    out = workspace(spark)
    w.run_to_files(df, out, workspace(spark))
    return spark.read.schema(df.schema).parquet(out).orderBy("user_id", "start").collect()


def test_visits_end_by_timer_and_by_event(spark, rocksdb):
    stream = batches(
        spark,
        at((1, 1, "a", "08:00:00"), (2, 1, "b", "08:10:00"), (3, 2, "a", "08:05:00")),
        at((4, 1, "a", "08:30:00"), (5, 1, "c", "09:00:00")),
        at((6, 3, "a", "12:00:00")),
        at((7, 3, "a", "12:20:00"), (8, 3, "z", "13:30:00")),
        at((9, 4, "a", "14:00:00")),
    )
    got = [(r.user_id, str(r.start)[11:], str(r.end)[11:], r.n, r.kinds, r.events) for r in run(spark, visits.visits(stream, 1800, "1 hour"))]
    assert got == [
        (1, "08:00:00", "09:00:00", 3, "a:2,b:1", "1,2,4"),  # the next event came just as late as the gap
        (1, "09:00:00", "09:30:00", 1, "c:1", "5"),  # nobody came: the watermark passed
        (2, "08:05:00", "08:35:00", 1, "a:1", "3"),
        (3, "12:00:00", "12:50:00", 2, "a:2", "6,7"),
    ]  # user 3's last visit and user 4's are open still


def test_visits_of_many_users_share_state(spark, rocksdb):
    """Each user was a call of the processor and some twenty requests to the state in each batch."""
    part = "SELECT id AS event_id, id % 3000 AS user_id, 'a' AS event_type, timestampadd(SECOND, CAST(id / 10 AS INT), timestamp_ntz '2024-01-01 08:00:00') AS ts FROM range({}, {})"
    out, checkpoint = workspace(spark), workspace(spark)
    w.run_to_files(visits.visits(batches(spark, part.format(0, 4500), part.format(4500, 9000)), 1800, "1 hour", buckets=2), out, checkpoint)
    assert spark.read.parquet(out).count() == 0
    assert 0 < sum(spark.read.format("statestore").option("stateVarName", v).load(checkpoint).count() for v in ("alarm", "open")) < 100
    w.run_to_files(visits.visits(batches(spark, part.format(0, 4500), part.format(4500, 9000), at((99999, 3000, "z", "14:00:00"))), 1800, "1 hour", buckets=2), out := workspace(spark), workspace(spark))
    assert sorted((r.user_id, r.n, r.kinds, r.events) for r in spark.read.parquet(out).collect()) == [(u, 3, "a:3", f"{u},{u + 3000},{u + 6000}") for u in range(3000)]


def test_long_visits_keep_all_events(spark, rocksdb):
    part = "SELECT id AS event_id, id % 2 AS user_id, concat('k', id % 4) AS event_type, timestampadd(SECOND, CAST(id / 10 AS INT), timestamp_ntz '2024-01-01 08:00:00') AS ts FROM range({}, {})"
    cuts = [0, 300, 700, 710, 30000, 30001]
    stream = batches(spark, *(part.format(a, b) for a, b in zip(cuts, cuts[1:])), at((99999, 3, "z", "14:00:00")))
    got = sorted((r.user_id, r.n, r.kinds, r.events) for r in run(spark, visits.visits(stream, 1800, "1 hour", buckets=1)))
    assert got == [(0, 15001, "k0:7501,k2:7500", ",".join(map(str, range(0, 30001, 2)))), (1, 15000, "k1:7500,k3:7500", ",".join(map(str, range(1, 30001, 2))))]


def test_visits_with_events_out_of_order_and_nulls(spark, rocksdb):
    null = "SELECT {}L AS event_id, CAST(null AS BIGINT) AS user_id, {} AS event_type, {} AS ts"
    stream = batches(
        spark,
        at((1, 1, "a", "08:30:00"), (2, 0, "a", "08:30:00")) + " UNION ALL " + null.format(3, "null", "timestamp_ntz '2024-01-01 08:31:00'") + " UNION ALL " + null.format(4, "'x'", "CAST(null AS timestamp_ntz)"),
        at((5, 1, "b", "08:10:00"), (6, 0, "b", "07:50:00")) + " UNION ALL " + null.format(7, "null", "timestamp_ntz '2024-01-01 08:40:00'"),
        at((8, 2, "a", "12:00:00")),
    )
    got = {(r.user_id, str(r.start)[11:], str(r.end)[11:], r.n, r.kinds, r.events) for r in run(spark, visits.visits(stream, 1800, "1 hour"))}
    assert got == {(1, "08:10:00", "09:00:00", 2, "a:1,b:1", "1,5"), (0, "07:50:00", "08:20:00", 1, "b:1", "6"), (0, "08:30:00", "09:00:00", 1, "a:1", "2"), (None, "08:31:00", "09:10:00", 2, None, "3,7")}


def test_visits_are_emitted_only_after_the_watermark(spark, rocksdb):
    stream = batches(spark, at((1, 1, "a", "08:00:00")), at((2, 2, "a", "09:29:00")))
    assert run(spark, visits.visits(stream, 1800, "1 hour")) == []
    stream = batches(spark, at((1, 1, "a", "08:00:00")), at((2, 2, "a", "09:30:00")))
    assert [r.user_id for r in run(spark, visits.visits(stream, 1800, "1 hour"))] == [1]


def test_state_outlives_a_restart(spark, rocksdb):
    path, out, checkpoint = workspace(spark), workspace(spark), workspace(spark)
    for part in (at((1, 1, "a", "08:00:00")), at((2, 1, "b", "08:10:00")), at((3, 2, "a", "12:00:00"))):
        spark.sql(part).coalesce(1).write.mode("append").parquet(path)
        df = visits.visits(spark.readStream.schema(EVENTS).parquet(path), 1800, "1 hour")
        w.run_to_files(df, out, checkpoint)
    assert [(r.user_id, r.n, r.events) for r in spark.read.parquet(out).collect()] == [(1, 2, "1,2")]


def test_keys_are_forgotten(spark, rocksdb):
    """With no time to live to speak of each batch's rows are first again."""
    parts = [at((k, 1, "a", f"0{k}:00:00")) for k in range(1, 5)]
    for ttl, want in ((3600, [1]), (0.001, [1, 2, 3, 4])):
        df = visits.first_seen(batches(spark, *parts), ttl)
        out = workspace(spark)
        w.run_to_files(df, out, workspace(spark), idle_batches=False)
        assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == want


def numbered(keys):
    return f"SELECT id AS event_id, id % {keys} AS user_id, 'a' AS event_type, timestamp_ntz '2024-01-01 08:00:00' AS ts FROM range({{}}, {{}})"


def test_many_keys_share_state(spark, rocksdb):
    """Each key was a call of the processor and two rows of state: some milliseconds a key and batch."""
    part = numbered(6000)
    df = visits.first_seen(batches(spark, part.format(1000, 4000), part.format(2000, 7000), part.format(6000, 12000)), 3600, buckets=2)
    out, checkpoint = workspace(spark), workspace(spark)
    w.run_to_files(df, out, checkpoint, idle_batches=False)
    assert sorted((r.user_id, r.event_id) for r in spark.read.parquet(out).collect()) == [(e % 6000, e) for e in sorted(range(1000, 7000), key=lambda e: e % 6000)]
    assert sum(spark.read.format("statestore").option("stateVarName", v).load(checkpoint).count() for v in ("count", "pages")) < 100


def test_null_keys_are_remembered(spark, rocksdb):
    part = "SELECT event_id, user_id, event_type, timestamp_ntz '2024-01-01 08:00:00' AS ts FROM VALUES {} AS t(event_id, user_id, event_type)"
    parts = [part.format("(5L, null, 'a'), (4L, null, 'a'), (6L, 0L, 'a'), (7L, 0L, null)"), part.format("(8L, null, 'a'), (9L, null, null), (1L, 0L, ''), (2L, 0L, null), (3L, -1L, 'a')")]
    out = workspace(spark)
    w.run_to_files(visits.first_seen(batches(spark, *parts), 3600), out, workspace(spark), idle_batches=False)
    assert sorted(map(tuple, spark.read.parquet(out).select("event_id", "user_id", "event_type").collect())) == [(1, 0, ""), (3, -1, "a"), (4, None, "a"), (6, 0, "a"), (7, 0, None), (9, None, None)]


def test_late_rows_are_counted_beyond_the_progress_that_is_kept(spark, sf_dir):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        df = w.tumbling(streams.ordered_stream(spark, sf_dir, *streams._PARTS, streams._LATE, streams._PARTS[3]), "1 hour", "1 hour")
        late = w.run_to_files(df, workspace(spark), workspace(spark))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert late > 0


SCHEMA = "k long, v string, t long"


def upserts(spark, buckets=8):
    return Upserts(spark, workspace(spark), spark.createDataFrame([], SCHEMA).schema, "k", "t", buckets)


def rows(spark, *of):
    return spark.createDataFrame(list(of), SCHEMA)


def test_a_replayed_batch_changes_nothing(spark):
    t = upserts(spark)
    assert t.upsert(rows(spark, (1, "a", 1), (2, "b", 1), (None, "n", 1)), 0)
    assert t.upsert(rows(spark, (2, "c", 2), (2, "d", 3), (3, "e", 0)), 1)
    now = sorted(map(str, t.table().collect()))
    assert not t.upsert(rows(spark, (2, "x", 9)), 1) and not t.upsert(rows(spark, (1, "x", 9)), 0)
    assert sorted(map(str, t.table().collect())) == now
    assert {(r.k, r.v) for r in t.table().collect()} == {(1, "a"), (2, "d"), (3, "e"), (None, "n")}


def test_new_rows_win_whatever_their_order(spark):
    t = upserts(spark)
    t.upsert(rows(spark, (1, "a", 5)), 0)
    t.upsert(rows(spark, (1, "b", 2)), 1)
    assert [r.v for r in t.table().collect()] == ["b"]


def test_a_batch_that_died_is_written_anew(spark):
    t = upserts(spark)
    t.upsert(rows(spark, (1, "a", 1)), 0)
    rows(spark, (7, "torn", 1)).selectExpr("*", "3 as bucket").write.partitionBy("bucket").parquet(f"{t.path}/data/batch=1")  # no manifest
    assert [r.k for r in t.table().collect()] == [1]
    assert t.upsert(rows(spark, (2, "b", 1)), 1)
    assert sorted(r.k for r in t.table().collect()) == [1, 2]


def test_only_touched_buckets_are_written(spark):
    t = upserts(spark, 16)
    t.upsert(spark.range(500).selectExpr("id as k", "'a' as v", "id as t"), 0)
    t.upsert(rows(spark, (5, "b", 1)), 1)
    where = t._where()
    assert sorted(where.values()) == [0] * 15 + [1] and t.table().count() == 500


def test_empty_batches_and_tables(spark):
    t = upserts(spark)
    assert t.table().count() == 0 and t.last() == -1
    assert t.upsert(rows(spark), 0) and t.table().count() == 0 and t.last() == 0


def test_sketches_merge_to_what_the_rows_give(spark):
    rows = spark.range(20_000).selectExpr("id % 7 as a", "id % 3 as b", "id % 5000 as k", "id as v")
    fine = sketches.sketched(rows, ["a", "b"], "k", "v")
    for by in (["a"], []):
        got = {tuple(r[c] for c in by): r for r in sketches.rolled_up(fine, by).select(*by, "n", "total", "least", "most", sketches.distinct_hll().alias("h"), sketches.distinct_theta().alias("t"), sketches.quantile(0.5).alias("m")).collect()}
        want = {tuple(r[c] for c in by): r for r in rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most"), F.countDistinct("k").alias("d"), F.median("v").alias("m")).collect()}
        assert got.keys() == want.keys()
        for k, r in got.items():
            x = want[k]
            assert (r.n, r.total, r.least, r.most) == (x.n, x.total, x.least, x.most)
            assert abs(r.h - x.d) <= 0.05 * x.d and abs(r.t - x.d) <= 0.03 * x.d and abs(r.m - x.m) <= 0.01 * 20_000


def test_sketches_of_nulls(spark):
    rows = spark.createDataFrame([(1, None, None), (1, None, None), (2, 5, 1.0)], "g long, k long, v double")
    got = {r.g: r for r in sketches.rolled_up(sketches.sketched(rows, ["g"], "k", "v"), ["g"]).select("g", "n", "least", sketches.distinct_hll().alias("h")).collect()}
    assert got[1].n == 2 and got[1].least is None and not got[1].h and got[2].h == 1
