"""A keyed table that a stream upserts, each batch once: batches that are replayed change nothing.

The table lies in buckets of its keys' hashes. A batch rewrites the buckets it has keys of and no others, into a folder of its own
number, and ends with a manifest: for each bucket the batch whose folder holds it.

    <path>/data/batch=<n>/bucket=<b>/...    buckets as of batch n
    <path>/log/<n>/...                      the manifest of batch n: bucket, batch

The manifest is one file, which Spark's commit puts in place whole; the newest is the table. A batch with a manifest is done, so its replay returns at once; one that died
before left a folder that no manifest names and that the replay writes anew. Work is in proportion to the buckets touched; on the driver are the numbers of the
buckets. Several rows of a key in a batch: the greatest by `order` counts (then the greatest row). A null key is a key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class Upserts:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, order: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.order, self.buckets = spark, path.rstrip("/"), schema, key, order, buckets

    def _log(self) -> dict[int, str]:
        """Manifests by batch: those whose file is in place."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        base = jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        fs = base.getFileSystem(conf)
        if not fs.exists(base):
            return {}
        found = [s.getPath() for s in fs.listStatus(base) if s.isDirectory()]
        return {int(p.getName()): p.toString() for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}

    def last(self) -> int:
        return max(self._log(), default=-1)

    def _where(self) -> dict[int, int]:
        log = self._log()
        if not log:
            return {}
        return {r.bucket: r.batch for r in self.spark.read.schema("bucket int, batch long").parquet(log[max(log)]).collect()}

    def _rows(self, where: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/batch={n}/bucket={b}" for b, n in where.items()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.schema.names)

    def table(self) -> DataFrame:
        return self._rows(self._where())

    def upsert(self, rows: DataFrame, batch: int) -> bool:
        """Take a batch in; False if that was done before."""
        if batch <= self.last():
            return False
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = rows.select(*self.schema.names)
        touched = sorted(r.b for r in rows.select(bucket.alias("b")).distinct().collect())  # at most as many as there are buckets
        where = self._where()
        old = self._rows({b: where[b] for b in touched if b in where})
        every = rows.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
        row = F.struct(*self.schema.names)
        # new before old, then by order: an aggregate with partial maxima, so a key of many rows is no group
        merged = every.groupBy(F.col(self.key).alias("_key")).agg(F.max_by(row, F.struct("_new", self.order, row)).alias("r")).select("r.*")
        folder = f"{self.path}/data/batch={batch}"
        merged.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        where |= dict.fromkeys(touched, batch)
        self.spark.createDataFrame(sorted(where.items()), "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/{batch}")
        return True


def run_upserts(stream: DataFrame, into: Upserts, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Run to the end of what is there; `change` makes a batch's rows the table's."""
    stream.writeStream.foreachBatch(lambda df, n: into.upsert(change(df), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
