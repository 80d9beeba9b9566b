"""User functions of each kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import udfs
from brindle.plans.query import Query, frame
from brindle.session import table


def _sql_function(spark, sf_dir):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION brindle_net(price DOUBLE, off DOUBLE) RETURNS DOUBLE RETURN round(price * (1 - off), 4)")
    return spark.sql("SELECT l_orderkey, l_linenumber, brindle_net(l_extendedprice, l_discount) AS net FROM {lineitem}", lineitem=table(spark, sf_dir, "lineitem"))


def _udtf(spark, sf_dir):
    spark.udtf.register("brindle_words", udfs.Words)
    return spark.sql("SELECT p_partkey, word, CAST(place AS BIGINT) AS place FROM {part}, LATERAL brindle_words(p_name)", part=table(spark, sf_dir, "part"))


def _runs(spark, sf_dir):
    spark.udtf.register("brindle_runs", udfs.Runs)
    return spark.sql("SELECT user_id, event_type, event_id, length FROM brindle_runs(TABLE(SELECT user_id, event_type, event_id FROM {events}), 'user_id', 'event_type', 'event_id')", events=table(spark, sf_dir, "events"))


def _gaps(spark, sf_dir):
    spark.udtf.register("brindle_gaps", udfs.Gaps)
    return spark.sql("SELECT * FROM brindle_gaps(TABLE(SELECT user_id, ts FROM {events}) PARTITION BY (user_id) ORDER BY (ts), 36000)", events=table(spark, sf_dir, "events"))


QUERIES: dict[str, Query] = {
    "x1_udf": frame(lambda p: p.select("p_partkey", udfs.initials("p_name").alias("i")), "part", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1]), '') AS i FROM part"),
    "x2_arrow_udf": frame(lambda l: l.select("l_orderkey", "l_linenumber", F.round(udfs.discounted("l_extendedprice", "l_discount"), 4).alias("net")), "lineitem", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem"),
    "x3_udaf": frame(lambda e: e.groupBy("event_type").agg(F.round(udfs.spread("value"), 9).alias("s")), "events", "SELECT event_type, round(max(value) - min(value), 9) AS s FROM events GROUP BY 1"),
    "x4_udtf": Query(_udtf, "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) - 1 AS place FROM part"),
    "x4_table_runs": Query(_runs, "WITH g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) SELECT user_id, event_type, min(event_id) AS event_id, count(*) AS length FROM g GROUP BY user_id, event_type, k"),
    "x4_table_gaps": Query(_gaps, "SELECT user_id, gap_start, s AS seconds FROM (SELECT user_id, lag(ts) OVER w AS gap_start, floor(date_diff('microsecond', lag(ts) OVER w, ts) / 1e6)::BIGINT AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) WHERE s > 36000"),
    "x5_grouped_map": frame(lambda e: e.select("event_id", "user_id", "value").groupBy("user_id").applyInPandas(udfs.centred, "event_id long, user_id long, value double"), "events", "SELECT event_id, user_id, round(value - median(value) OVER (PARTITION BY user_id), 6) AS value FROM events"),
    "x5_batch_map": frame(lambda p: p.select("p_partkey", "p_name").mapInArrow(udfs.long_names, "p_partkey long, p_name string"), "part", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10"),
    "x6_sql_function": Query(_sql_function, "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem"),
}
