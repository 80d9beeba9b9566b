"""Streaming queries over the events table, read as a stream of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.plans.query import Query
from brindle.plans.workspace import workspace
from brindle.session import table
from brindle.sources import files
from brindle.streaming import upserts, visits
from brindle.streaming import windows as w


def stream(spark, sf_dir, where: str = "true"):
    """The events, in four files and as many batches, in order."""
    path = workspace(spark)
    events = table(spark, sf_dir, "events")
    events.where(where).repartitionByRange(4, "event_id").sortWithinPartitions("event_id").write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


FILES = 4


def ordered_stream(spark, sf_dir, *parts: str):
    """The events of each condition in FILES files of their own, which are one batch, in this order (a condition has many more rows than files)."""
    path = workspace(spark)
    events = table(spark, sf_dir, "events")
    for part in parts:
        events.where(part).repartition(FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(path)


_PARTS = ("ts < timestamp_ntz '2024-01-10'", "ts >= timestamp_ntz '2024-01-10' and ts < timestamp_ntz '2024-01-20'", "ts >= timestamp_ntz '2024-01-20' and ts < timestamp_ntz '2024-01-27'", "ts >= timestamp_ntz '2024-01-27'")
_LATE = "ts < timestamp_ntz '2024-01-05'"  # once more, when the watermark has long passed


def _append(*parts):
    return _files(lambda s, d: w.tumbling(ordered_stream(s, d, *parts), "1 hour", "1 hour"))


def _restart(spark, sf_dir):
    path, out, checkpoint = workspace(spark), workspace(spark), workspace(spark)
    events = table(spark, sf_dir, "events")
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        events.where(part).write.mode("append").parquet(path)
        w.run_to_files(spark.readStream.schema(events.schema).parquet(path), out, checkpoint)
    return files.read(spark, out, schema=events.schema).select("event_id", "ts", "event_type")


def _complete(build):
    return lambda spark, sf_dir: w.run_complete(spark, build(stream(spark, sf_dir)), workspace(spark), workspace(spark))


def _files(build, idle_batches=True):
    def run(spark, sf_dir):
        out = workspace(spark)
        df = build(spark, sf_dir)
        w.run_to_files(df, out, workspace(spark), idle_batches)
        return files.read(spark, out, schema=df.schema)

    return run


def _keyed(build, idle_batches=True):
    """As _files(), with the state store that keyed state wants; other queries keep the store they had."""

    def run(spark, sf_dir):
        conf = "spark.sql.streaming.stateStore.providerClass"
        before = spark.conf.get(conf)
        spark.conf.set(conf, w.ROCKSDB)
        try:
            return _files(build, idle_batches)(spark, sf_dir)
        finally:
            spark.conf.set(conf, before)

    return run


def _upserts(spark, sf_dir):
    """The last event of each user, by batches, the last of which comes again with other rows."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    into = upserts.Upserts(spark, workspace(spark), events.schema, "user_id", "ts", 16)
    upserts.run_upserts(ordered_stream(spark, sf_dir, *_PARTS), into, workspace(spark))
    into.upsert(events.withColumn("event_id", F.lit(-1).cast("long")), into.last())
    return into.table()


def _state(spark, sf_dir):
    out = _keyed(lambda s, d: w.running_total(stream(s, d)))(spark, sf_dir)
    # files arrive in no fixed order, but each place is taken once
    return out.groupBy("user_id").agg(F.max("nth").alias("last"), F.countDistinct("nth").alias("places"), F.countDistinct("event_id").alias("events"))


def _each_batch(spark, sf_dir):
    out = workspace(spark)
    w.run_each_batch(stream(spark, sf_dir), lambda df, n: df.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{out}/batch={n}"), workspace(spark))
    return spark.read.parquet(out).groupBy("event_type").agg(F.sum("n").alias("n"))


_SESSIONS = """
WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s)
SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n FROM g GROUP BY user_id, k
"""

_VISITS = """
WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s),
t AS (SELECT user_id, k, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS kinds FROM (SELECT user_id, k, event_type, count(*) AS n FROM g GROUP BY ALL) GROUP BY ALL)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n, any_value(kinds) AS kinds, string_agg(event_id, ',' ORDER BY ts) AS events
FROM g JOIN t USING (user_id, k) GROUP BY user_id, k
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) OR k < (SELECT max(l.k) FROM g l WHERE l.user_id = g.user_id)
"""

_CLOSED = """
SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, n FROM (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
"""

QUERIES: dict[str, Query] = {
    "t1_watermark": Query(_append(*_PARTS), _CLOSED),
    "t8_late_data": Query(_append(*_PARTS, _LATE), _CLOSED),
    "t9_restart": Query(_restart, "SELECT event_id, ts, event_type FROM events"),
    "t2_tumbling": Query(_complete(lambda e: w.tumbling(e, "1 hour", "1 hour")), """SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end", event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"""),
    "t3_sliding": Query(_complete(lambda e: w.sliding(e, "1 hour", "30 minutes", "1 hour")), """SELECT s AS start, s + INTERVAL 1 HOUR AS "end", count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY 1, 2"""),
    "t4_sessions": Query(_files(lambda s, d: w.sessions(ordered_stream(s, d, *_PARTS), "30 minutes", "1 hour")), f'SELECT * FROM ({_SESSIONS}) WHERE "end" <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)'),
    "t4_sessions_batch": Query(lambda spark, d: w.sessions(table(spark, d, "events"), "30 minutes", "1 hour"), _SESSIONS),
    "t5_deduplicated": Query(_files(lambda s, d: w.deduplicated(stream(s, d).unionByName(stream(s, d)), ["event_id"], "90 days").select("event_id", "event_type")), "SELECT event_id, event_type FROM events"),
    "t6_stream_join": Query(_files(lambda s, d: w.followed(stream(s, d, "event_type = 'view'"), stream(s, d, "event_type = 'purchase'"), "6 HOURS", "40 days")), "SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR WHERE a.event_type = 'view' AND b.event_type = 'purchase'"),
    "t7_state": Query(_state, "SELECT user_id, count(*) AS last, count(*) AS places, count(*) AS events FROM events GROUP BY 1"),
    "t7_visits": Query(_keyed(lambda s, d: visits.visits(ordered_stream(s, d, *_PARTS), 30 * 60, "1 hour")), _VISITS),
    "t7_first_seen": Query(_keyed(lambda s, d: visits.first_seen(ordered_stream(s, d, *_PARTS), 24 * 3600), idle_batches=False), "SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type"),
    "t10_upserts": Query(_upserts, "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, max(ts) AS ts FROM events GROUP BY user_id"),
    "t10_each_batch": Query(_each_batch, "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1"),
}
