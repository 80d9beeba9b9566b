"""Sources and sinks: what is written comes back the same. Files go below the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.plans.query import Query
from brindle.plans.workspace import workspace
from brindle.session import table
from brindle.sources import files, ledger, python_source


def _back(kind: str, name: str, columns: str, **options: str) -> Query:
    def run(spark: SparkSession, sf_dir: str):
        df, path = table(spark, sf_dir, name).select(*columns.split(", ")), workspace(spark)
        files.write(df, path, kind, **options)
        return files.read(spark, path, kind, df.schema)

    return Query(run, f"SELECT {columns} FROM {name}")


def _text(spark, sf_dir):
    path = workspace(spark)
    files.write(table(spark, sf_dir, "part").select(F.concat_ws("|", "p_partkey", "p_name").alias("value")), path, "text")
    return files.read(spark, path, "text")


def _partitioned(spark, sf_dir):
    path = workspace(spark)
    files.write(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), path, partition_by=["l_returnflag"])
    return files.read(spark, path).where("l_returnflag = 'R'").select("l_orderkey", "l_quantity", "l_returnflag")


def _binary(spark, sf_dir):
    path = workspace(spark)
    files.write(table(spark, sf_dir, "nation").repartitionByRange(3, "n_nationkey"), path)
    return files.binary_files(spark, path, "*.parquet").agg(F.count("*").alias("files"), F.min(F.substring("content", 1, 4).cast("string")).alias("magic"))


def _python(spark, sf_dir):
    python_source.register(spark)
    squares = spark.read.format("squares").option("rows", "25").load()
    return squares.join(table(spark, sf_dir, "nation"), F.col("n") == F.col("n_nationkey")).select("n_name", "square")


def _ledger(spark, sf_dir):
    """Two commits, the second with columns and segments that the filters leave aside."""
    ledger.register(spark)
    events, path = table(spark, sf_dir, "events"), workspace(spark)
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        ledger.save(events.where(part).repartitionByRange(4, "event_id").sortWithinPartitions("event_id"), path)
    rows = ledger.load(spark, path, events.schema, ["event_id", "user_id", "event_type", "value"])
    return rows.where("event_id >= 700 and event_type in ('click', 'view') and user_id < 100 and value > 20")


def _ledger_replaced(spark, sf_dir):
    ledger.register(spark)
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"), workspace(spark)
    ledger.save(orders.where("o_orderkey % 7 = 0"), path)
    ledger.save(orders.where("o_orderkey % 3 = 0"), path, "overwrite")
    ledger.save(orders.where("o_orderkey % 3 = 1"), path)
    return ledger.load(spark, path, orders.schema).where("o_orderpriority like '1%'")


def _ledger_stream(spark, sf_dir):
    """From one table into another as a stream that stops and goes on."""
    ledger.register(spark)
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    source, sink, checkpoint = workspace(spark), workspace(spark), workspace(spark)
    for part in ("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"):
        ledger.save(events.where(part), source)
        ledger.save_stream(ledger.load_stream(spark, source, events.schema).where("value > 10"), sink, checkpoint, "copy")
    return ledger.load(spark, sink, events.schema)


def _compacted(spark, sf_dir):
    path = workspace(spark)
    files.compacted(table(spark, sf_dir, "orders"), path, ["o_orderdate"])
    return files.read(spark, path).where("o_orderdate >= timestamp_ntz '2001-01-01'").select("o_orderkey", "o_orderdate")


QUERIES: dict[str, Query] = {
    "s1_parquet": _back("parquet", "orders", "o_orderkey, o_orderdate, o_totalprice, o_orderpriority"),
    "s2_orc": _back("orc", "events", "event_id, ts, user_id, props"),
    "s2_json": _back("json", "events", "event_id, ts, value, props"),
    "s2_csv": _back("csv", "customer", "c_custkey, c_name, c_acctbal, c_mktsegment"),
    "s2_text": Query(_text, "SELECT p_partkey || '|' || p_name AS value FROM part"),
    "s3_xml": _back("xml", "supplier", "s_suppkey, s_name, s_acctbal"),
    "s4_binary": Query(_binary, "SELECT 3::BIGINT AS files, 'PAR1' AS magic"),
    "s5_partitioned": Query(_partitioned, "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem WHERE l_returnflag = 'R'"),
    "s6_python_source": Query(_python, "SELECT n_name, n_nationkey::BIGINT * n_nationkey AS square FROM nation WHERE n_nationkey < 25"),
    "s6_ledger": Query(_ledger, "SELECT event_id, user_id, event_type, value FROM events WHERE event_id >= 700 AND event_type IN ('click', 'view') AND user_id < 100 AND value > 20"),
    "s6_ledger_replaced": Query(_ledger_replaced, "SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 3 < 2 AND o_orderpriority LIKE '1%'"),
    "s6_ledger_stream": Query(_ledger_stream, "SELECT event_id, ts, event_type, value FROM events WHERE value > 10"),
    "s7_compacted": Query(_compacted, "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'"),
}
