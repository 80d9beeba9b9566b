"""A bounded sample of labelled documents to fit a classifier on, and calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id", n: int = 3):
    """crc32 of the id as text, modulo n; null ids are in fold 0's place as crc32 of ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, train, most: int, most_chars: int) -> list[tuple[str, int]]:
    """Up to `most` documents of either label that `train` (a condition on doc_id) admits, least MD5 of the id first.

    Labels come once for each doc_id (the greatest, if rows differ; nulls don't count). Texts come to
    the driver, at most 2 * most of them and most_chars characters in all: a text of more than a sixteenth of that, and what
    is beyond the sum in the order of the ids' MD5, is left out of the fit (never out of the scoring); so that a few very long texts
    leave others in, 2 * most ids of either label are looked at. Only ids and lengths are ordered; texts are read for those chosen.
    """
    key = F.md5(F.col("doc_id").cast("string").cast("binary"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).where(train).groupBy("doc_id").agg(F.max(label).alias("y"))
    few = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(key).limit(2 * most)
        few = part if few is None else few.unionAll(part)
    # at most 4 * most ids: small whatever the input
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    sizes = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("of"), F.length("text").alias("size"))).alias("m"))
    rows = sizes.where(F.col("m.size") <= most_chars // 16).select("doc_id", "y", "m.of", "m.size", key.alias("key")).collect()
    chosen, held, total = [], {0: 0, 1: 0}, 0
    for r in sorted(rows, key=lambda r: r.key):
        if held[r.y] < most and total + r.size <= most_chars:
            held[r.y], total = held[r.y] + 1, total + r.size
            chosen.append((r.doc_id, r.of, int(r.y), r.key))
    if not chosen:
        return []
    # by Arrow: a list of rows would be an RDD of Python's, for which every executor would start workers of another kind beside those it has
    spark = docs.sparkSession
    table = pa.table([pa.array(c) for c in zip(*chosen)], names=["_id", "_of", "y", "key"])
    ids = spark.createDataFrame(table, f"_id {docs.schema['doc_id'].dataType.simpleString()}, _of long, y int, key string")
    got = texts.join(F.broadcast(ids), (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_of"))).dropDuplicates(["doc_id"]).select("key", "text", "y").collect()
    return [(r.text, int(r.y)) for r in sorted(got, key=lambda r: r.key)]


def add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """to[at] += rows, places that come again added up: by sorting, which takes far less than add.at on rows."""
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        to[at[starts]] += np.add.reduceat(rows[order], starts, axis=0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def temperature(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale a >= 0 and shift b of the least log loss of sigmoid(a * logit + b), by Newton's steps."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    m, s = float(logits.mean()), float(logits.std()) or 1.0
    x = np.stack([(logits - m) / s, np.ones(len(y))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + 0.5 * w * np.array([1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.5, 1e-9])
        w -= np.clip(np.linalg.solve(h + 1e-9 * np.eye(2), g), -3, 3)
    a = max(0.0, w[0]) / s
    return a, float(w[1] - a * m)
