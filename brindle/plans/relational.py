
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brindle.operators import sketches
from brindle.operators.joins import asof_join, broadcast_below, not_in, range_join, salted_join
from brindle.operators.ranking import qualify, sum_over_groups, top_k
from brindle.plans.query import Query, frame, sql
from brindle.plans.workspace import workspace
from brindle.session import table

D = "CAST({} AS DECIMAL(15,2))"
REVENUE = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"

QUERIES: dict[str, Query] = {
    # projection and filter
    "p1_project": sql("SELECT l_orderkey, l_linenumber, round(l_quantity * 2, 2) AS twice, l_shipdate FROM {lineitem}"),
    "p2_filter": sql("SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice > 150000 AND o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'", "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice > 150000 AND o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'"),
    "p3_predicates": sql("SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size IN (11, 12, 13) THEN 'odd' ELSE 'large' END AS kind, coalesce(nullif(p_brand, 'Brand#11'), 'none') AS brand FROM {part} WHERE p_name LIKE '%a%'"),
    "p4_sample": Query(sql("SELECT l_orderkey, l_linenumber FROM {lineitem} TABLESAMPLE (10 PERCENT) REPEATABLE (7)").run),
    "p4_sample_bounds": frame(lambda l: _sampled(l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), "lineitem", "SELECT count(*) AS total, true AS near, 0::BIGINT AS others FROM lineitem"),
    "p5_pipe": sql("FROM {orders} |> WHERE o_totalprice > 150000 |> AGGREGATE count(*) AS n, max(o_totalprice) AS most GROUP BY o_orderstatus |> WHERE n > 5 |> SELECT o_orderstatus, n, most", "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS most FROM {orders} WHERE o_totalprice > 150000 GROUP BY o_orderstatus HAVING count(*) > 5"),
    "p5_recursive": sql("WITH RECURSIVE t(n, f) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 12) SELECT n, f, r_name FROM t JOIN {region} ON n % 5 = r_regionkey"),
    # joins
    "j1_broadcast": frame(lambda o, c: o.join(broadcast_below(c.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"), "orders customer", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'"),
    "j2_sort_merge": frame(lambda l, o: l.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(F.count("*").alias("n")), "lineitem orders", "SELECT o_orderpriority, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"),
    "j3_shuffle_hash": frame(lambda l, o: l.join(o.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderstatus").agg(F.count("*").alias("n")), "lineitem orders", "SELECT o_orderstatus, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"),
    "j4_theta": sql("SELECT a.n_name AS a, b.n_name AS b FROM {nation} a JOIN {nation} b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey <> b.n_regionkey"),
    "j5_cartesian": frame(lambda n, r: n.select("n_name").join(r.select("r_name").hint("shuffle_replicate_nl")), "nation region", "SELECT n_name, r_name FROM nation CROSS JOIN region"),
    "j6_full_outer": sql("SELECT c_custkey, o_orderkey FROM (SELECT * FROM {customer} WHERE c_acctbal > 5000) c FULL OUTER JOIN (SELECT * FROM {orders} WHERE o_totalprice > 100000) o ON c_custkey = o_custkey"),
    "j7_left_right_outer": sql("SELECT o_orderkey, s_suppkey, n_name FROM {orders} LEFT JOIN (SELECT * FROM {lineitem} WHERE l_quantity > 45) l ON o_orderkey = l_orderkey RIGHT JOIN {supplier} ON l_suppkey = s_suppkey LEFT JOIN {nation} ON s_nationkey = n_nationkey"),
    "j8_semi": frame(lambda o, l: o.join(l.where("l_quantity > 48"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_orderdate"), "orders lineitem", "SELECT o_orderkey, o_orderdate FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)"),
    "j8_anti": frame(lambda o, l: o.join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_orderdate"), "orders lineitem", "SELECT o_orderkey, o_orderdate FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"),
    "j9_not_in": frame(lambda o, l: not_in(o, l.where("l_quantity > 10"), "o_orderkey", "l_orderkey").select("o_orderkey"), "orders lineitem", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)"),
    "j9_not_in_null": frame(lambda o, l: not_in(o, l.select(F.nullif("l_orderkey", F.lit(7)).alias("v")), "o_orderkey", "v").select("o_orderkey"), "orders lineitem", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT nullif(l_orderkey, 7) FROM lineitem)"),
    "j10_scalar_subquery": sql("SELECT c_custkey, (SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey) AS most FROM {customer}"),
    "j10_exists": sql("SELECT s_suppkey FROM {supplier} WHERE EXISTS (SELECT 1 FROM {lineitem} WHERE l_suppkey = s_suppkey AND l_discount = 0.1 AND l_quantity > 49)"),
    "j11_lateral": sql("SELECT r_name, t.n_name FROM {region}, LATERAL (SELECT n_name FROM {nation} WHERE n_regionkey = r_regionkey ORDER BY n_name LIMIT 2) t"),
    "j11_lateral_outer": frame(lambda r, n: r.lateralJoin(n.where((F.col("n_regionkey") == F.col("r_regionkey").outer()) & (F.col("n_nationkey") < 8)).select("n_name").orderBy("n_name").limit(1), how="left").select("r_name", "n_name"), "region nation", "SELECT r_name, t.n_name FROM (SELECT * FROM region) r LEFT JOIN LATERAL (SELECT n_name FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey < 8 ORDER BY n_name LIMIT 1) t ON true"),
    "j12_interval": sql("SELECT a.event_id AS a, b.event_id AS b FROM {events} a JOIN {events} b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL '30' MINUTE", "SELECT a.event_id AS a, b.event_id AS b FROM {events} a JOIN {events} b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 30 MINUTE"),
    "j13_range": frame(lambda e: _near(e), "events", "SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON epoch_us(b.ts) >= epoch_us(a.ts) AND epoch_us(b.ts) < epoch_us(a.ts) + 60000000 WHERE a.event_type = 'purchase' AND b.event_type = 'view'"),
    "j14_asof": frame(lambda e: _asof(e, True), "events", "SELECT p.event_id, p.ts, v.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts"),
    "j14_asof_strict": frame(lambda e: _asof(e, False), "events", "SELECT p.event_id, p.ts, v.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts > v.ts"),
    "j14_asof_spans": frame(lambda e: _asof(e, True, lambda t: F.date_trunc("day", t)), "events", "SELECT p.event_id, p.ts, v.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts"),
    "j15_salted": frame(lambda l, s: salted_join(l.withColumnRenamed("l_suppkey", "k"), s.withColumnRenamed("s_suppkey", "k"), "k", 4).groupBy("s_nationkey").agg(F.count("*").alias("n")), "lineitem supplier", "SELECT s_nationkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1"),
    # aggregation
    "a1_grouped": sql(f"SELECT l_returnflag, l_linestatus, CAST(sum({D.format('l_quantity')}) AS DOUBLE) AS qty, CAST(sum({REVENUE}) AS DOUBLE) AS revenue, count(*) AS n, min(l_shipdate) AS first_ship, max(l_discount) AS most FROM {{lineitem}} GROUP BY l_returnflag, l_linestatus"),
    "a2_distinct": sql("SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey, l_suppkey) AS pairs FROM {lineitem} GROUP BY l_returnflag", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM {lineitem} GROUP BY l_returnflag"),
    "a3_collect": frame(lambda n: n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("names"), F.size(F.collect_list("n_name")).cast("long").alias("n")), "nation", "SELECT n_regionkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS names, count(n_name) AS n FROM nation GROUP BY 1"),
    "a4_grouping_sets": sql("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) AS BIGINT) AS g FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())"),
    "a5_cube": sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY CUBE (o_orderstatus, o_orderpriority)"),
    "a5_rollup": sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "a6_filtered": sql("SELECT event_type, count(*) FILTER (WHERE value > 50) AS high, max(value) FILTER (WHERE user_id % 2 = 0) AS even_most FROM {events} GROUP BY event_type"),
    "a7_percentiles": sql("SELECT event_type, round(percentile(value, 0.9), 6) AS p90, round(median(value), 6) AS mid FROM {events} GROUP BY event_type", "SELECT event_type, round(quantile_cont(value, 0.9), 6) AS p90, round(median(value), 6) AS mid FROM {events} GROUP BY event_type"),
    "a7_mode": frame(lambda n: n.groupBy("l_returnflag").agg(F.mode("l_linestatus", True).alias("common")), "lineitem", "SELECT l_returnflag, arg_max(l_linestatus, (n, -ascii(l_linestatus))) AS common FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1"),
    "a8_approximate": frame(lambda e: e.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("users"), F.percentile_approx("value", 0.5, 10_000).alias("mid"), F.hll_sketch_estimate(F.hll_sketch_agg("user_id")).alias("hll")), "events", None),
    "a8_error": frame(lambda e: _errors(e), "events", "SELECT event_type, count(DISTINCT user_id) AS users, true AS near, true AS sketch, true AS mid FROM events GROUP BY 1"),
    "a8_rollup": Query(lambda spark, d: _rolled(spark, d), "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total, max(value) AS most, true AS hll, true AS theta, true AS kll FROM events GROUP BY 1"),
    "a8_common": Query(lambda spark, d: _common(spark, d), "SELECT date_trunc('week', ts) AS week, count(DISTINCT user_id) FILTER (event_type = 'view') AS views, true AS near FROM events GROUP BY 1"),
    "a9_arg_max": sql("SELECT event_type, max_by(event_id, ts) AS last_id, min_by(event_id, ts) AS first_id FROM {events} GROUP BY event_type", "SELECT event_type, arg_max(event_id, ts) AS last_id, arg_min(event_id, ts) AS first_id FROM {events} GROUP BY event_type"),
    "a9_listagg": sql("SELECT n_regionkey, listagg(n_name, '|') WITHIN GROUP (ORDER BY n_name) AS names FROM {nation} GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names FROM {nation} GROUP BY n_regionkey"),
    "a10_pivot": frame(lambda e: e.groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.count("event_id")), "events", "SELECT user_id, nullif(count(*) FILTER (event_type = 'click'), 0) AS click, nullif(count(*) FILTER (event_type = 'view'), 0) AS view, nullif(count(*) FILTER (event_type = 'purchase'), 0) AS purchase FROM events GROUP BY 1"),
    "a10_unpivot": frame(lambda l: l.select("l_orderkey", "l_linenumber", "l_discount", "l_tax").unpivot(["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "name", "amount"), "lineitem", "SELECT l_orderkey, l_linenumber, 'l_discount' AS name, l_discount AS amount FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem"),
    "a11_moments": sql("SELECT event_type, round(stddev_samp(value), 6) AS sd, round(var_pop(value), 4) AS var, round(corr(value, user_id), 6) AS cor, round(covar_pop(value, user_id), 3) AS cov FROM {events} GROUP BY event_type"),
    "a12_having": sql("SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) >= 15 AND max(o_totalprice) > 200000"),
    # windows
    "w1_ranks": sql("SELECT event_id, CAST(row_number() OVER w AS BIGINT) AS rn, CAST(rank() OVER v AS BIGINT) AS rk, CAST(dense_rank() OVER v AS BIGINT) AS dr, CAST(ntile(4) OVER w AS BIGINT) AS nt, round(percent_rank() OVER v, 9) AS pr, round(cume_dist() OVER v, 9) AS cd FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), v AS (PARTITION BY user_id ORDER BY event_type)"),
    "w2_lag_lead": sql("SELECT event_id, lag(event_id, 2, -1) OVER w AS before2, lead(event_type) OVER w AS following, nth_value(event_id, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"),
    "w3_first_last": sql("SELECT event_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"),
    "w4_rows_frame": frame(lambda e: e.select("event_id", F.sum(F.col("value").cast("decimal(15,4)")).over(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, 0)).cast("double").alias("s")), "events", "SELECT event_id, CAST(sum(CAST(value AS DECIMAL(15,4))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DOUBLE) AS s FROM events"),
    "w5_range_frame": sql("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '2' HOUR PRECEDING AND CURRENT ROW) AS n FROM {events}", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS n FROM {events}"),
    "w6_top_k": frame(lambda o: top_k(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "place").select("o_custkey", "o_orderkey", "place"), "orders", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders QUALIFY place <= 3"),
    "w7_groups_frame": frame(lambda p: sum_over_groups(p.select("p_partkey", "p_brand", F.col("p_size").cast("long").alias("p_size")), ["p_brand"], "p_size", "p_size", 2, "s"), "part", "SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size, CAST(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_size GROUPS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS s FROM part"),
    "w8_qualify": frame(lambda e: qualify(e.select("event_id", "user_id"), F.count("*").over(Window.partitionBy("user_id")), lambda n: n > 75), "events", "SELECT event_id, user_id FROM events QUALIFY count(*) OVER (PARTITION BY user_id) > 75"),
    # sort, limit, set operations
    "o1_sort": sql("SELECT s_suppkey, s_acctbal FROM {supplier} ORDER BY s_acctbal DESC, s_suppkey"),
    "o2_top_k": sql("SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"),
    "o3_offset": sql("SELECT c_custkey FROM {customer} ORDER BY c_acctbal, c_custkey LIMIT 15 OFFSET 30"),
    "u1_union_all": sql("SELECT n_name AS name FROM {nation} UNION ALL SELECT r_name FROM {region}"),
    "u1_union_by_name": frame(lambda c, s: c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal")).unionByName(s.select(F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"))), "customer supplier", "SELECT c_name AS name, c_acctbal AS bal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier"),
    "u2_intersect": sql("SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 0"),
    "u3_except_all": sql("SELECT l_suppkey FROM {lineitem} WHERE l_quantity > 40 EXCEPT ALL SELECT l_suppkey FROM {lineitem} WHERE l_quantity > 45"),
    "u4_except": sql("SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P'"),
    "u4_intersect_all": sql("SELECT l_suppkey FROM {lineitem} WHERE l_quantity > 40 INTERSECT ALL SELECT l_suppkey FROM {lineitem} WHERE l_returnflag = 'R'"),
    "u5_distinct": sql("SELECT DISTINCT p_brand, p_type FROM {part}"),
}


def _sampled(lines):
    """A tenth of the rows, within five standard deviations, and none that the table lacks."""
    part = lines.sample(0.1, seed=7)
    n, total, others = part.agg(F.count("*").alias("n")), lines.agg(F.count("*").alias("total")), part.exceptAll(lines).agg(F.count("*").alias("others"))
    return total.join(n).join(others).select("total", (F.abs(F.col("n") - F.col("total") * 0.1) <= 5 * F.sqrt(F.col("total") * 0.09)).alias("near"), "others")


def _errors(events):
    """Approximate against exact aggregates: distinct counts within three times the stated error, the median by rank within one in a thousand."""
    by = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("a"), F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12)).alias("h"), F.percentile_approx("value", 0.5, 10_000).alias("m"))
    ranks = events.join(broadcast_below(by.select(F.col("event_type").alias("_t"), "m")), F.col("event_type") == F.col("_t")).groupBy("_t").agg(F.avg((F.col("value") < F.col("m")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("m")).cast("double")).alias("upto"))
    near = lambda c, e: F.abs(F.col(c) - F.col("users")) <= F.greatest(F.lit(1.0), 3 * e * F.col("users"))
    return by.join(ranks, F.col("event_type") == F.col("_t")).select("event_type", "users", near("a", 0.02).alias("near"), near("h", 0.016).alias("sketch"), ((F.col("below") <= 0.501) & (F.col("upto") >= 0.499)).alias("mid"))


def _daily(spark, sf_dir):
    """Sketches of each day and event type, written in two goes, as days come in."""
    events, path = table(spark, sf_dir, "events"), workspace(spark)
    for part in ("ts < timestamp_ntz '2024-01-15'", "ts >= timestamp_ntz '2024-01-15'"):
        days = sketches.sketched(events.where(part), [F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type"], "user_id", "value")
        days.write.mode("append").parquet(path)
    return events, spark.read.parquet(path)


def _rolled(spark, sf_dir):
    """By event type, from the days' sketches: exact figures, and whether estimates are within three times their error (the median by its rank, within 1 %)."""
    events, days = _daily(spark, sf_dir)
    by = sketches.rolled_up(days, ["event_type"]).select("event_type", "n", F.round("total", 4).alias("total"), "most", sketches.distinct_hll().alias("h"), sketches.distinct_theta().alias("t"), sketches.quantile(0.5).alias("m"))
    exact = events.groupBy(F.col("event_type").alias("_t")).agg(F.countDistinct("user_id").alias("users"))
    ranks = events.join(broadcast_below(by.select(F.col("event_type").alias("_e"), "m")), F.col("event_type") == F.col("_e")).groupBy("_e").agg(F.avg((F.col("value") < F.col("m")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("m")).cast("double")).alias("upto"))
    near = lambda c, e: F.abs(F.col(c) - F.col("users")) <= F.greatest(F.lit(1.0), 3 * e * F.col("users"))
    both = by.join(exact, F.col("event_type") == F.col("_t")).join(ranks, F.col("event_type") == F.col("_e"))
    return both.select("event_type", "n", "users", "total", "most", near("h", 0.016).alias("hll"), near("t", 0.008).alias("theta"), ((F.col("below") <= 0.51) & (F.col("upto") >= 0.49)).alias("kll"))


def _common(spark, sf_dir):
    """Users with views and purchases in a week, by theta intersection of the weeks' sketches: whether within three times the error of the union."""
    events, days = _daily(spark, sf_dir)
    week = F.date_trunc("week", F.col("day")).cast("timestamp_ntz").alias("week")
    of = lambda kind, name: sketches.rolled_up(days.where(F.col("event_type") == kind), [week]).select(F.col("week").alias(f"_{name}"), F.col("theta").alias(name))
    got = of("view", "a").join(of("purchase", "b"), F.col("_a") == F.col("_b")).select("_a", sketches.in_common("a", "b").alias("est"))
    users = events.groupBy(F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week"), "user_id").agg(F.max((F.col("event_type") == "view").cast("int")).alias("v"), F.max((F.col("event_type") == "purchase").cast("int")).alias("p"))
    exact = users.groupBy("week").agg(F.sum("v").cast("long").alias("views"), F.sum(F.col("v") * F.col("p")).alias("both"), F.sum(F.greatest("v", "p")).alias("either"))
    return exact.join(got, F.col("week") == F.col("_a"), "left").select("week", "views", (F.abs(F.coalesce("est", F.lit(0)) - F.col("both")) <= F.greatest(F.lit(1.0), 3 * 0.008 * F.col("either"))).alias("near"))


def _near(events):
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    a = events.where("event_type = 'purchase'").select(F.col("event_id").alias("a"), us("ts").alias("low"), (us("ts") + 60_000_000).alias("high"))
    b = events.where("event_type = 'view'").select(F.col("event_id").alias("b"), us("ts").alias("at"))
    return range_join(b, a, F.col("at"), F.col("low"), F.col("high"), 60_000_000).select("a", "b")


def _asof(events, inclusive, span=None):
    views = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("last_view"))
    out = asof_join(events.where("event_type = 'purchase'"), views, ["user_id"], "ts", "ts", ["last_view"], inclusive, span)
    return out.select("event_id", "ts", "last_view")
