"""Ranked lexical search by hashed max-sketches: the k best documents for each item, exactly.

A document's impact for a term is w * ((1000000000 * tf) div (1000 * tf + 8 * m)), m = 10 + ((90 * n * N) div L), w the term's
floor(1000 * ln((2N + 2) / (2df + 1))); its score for an item is the sum over the item's distinct terms. Items are searched in
batches of bounded size, each in two passes over the documents:

1. Terms. Every whole text is parted into terms and counted; of a document stay n, and tf of the terms that any item of the batch has (other
   terms can be in no lookup). N, L and df are sums of counts that each task made for itself.
2. Sketches. A document's impacts fold into WIDTH coordinates, the maximum of the impacts whose terms' hashes fall there, so what
   an item's terms find in theirs is never less than the document's impact, and the sum of lookups bounds its score. The lookups of all items
   in all sketches of an Arrow batch are one matrix product. For each item the batch's documents are rescored exactly by descending bound, until
   the bound is below the k-th score that the task has found. The k best of each task meet in a last top-k for each item.

No posting is ever a row, so a term that every document has costs no more than a rare one. What is broadcast are a batch's terms and weights,
at most some BATCH_BYTES of item text and BATCH_ITEMS items (one longer item is a batch of its own).

Terms: maximal runs of ASCII letters and digits and of anything beyond ASCII; A-Z lowered. Defined cases: null or empty texts have no terms and
do not count in N; an item without terms, or whose terms no document has, has no rows; equal scores go by ascending doc_id, null first; repeated
rows of documents are documents of their own; items that agree in item_id and text count once, others of equal item_id are ranked each for itself;
other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import bounded_batches, column, pieces, stored, take_turn, tidy

WIDTH = 2048
BATCH_BYTES, BATCH_ITEMS = 4 << 20, 1000
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece, as UTF-8."""
    for piece in pieces(text):
        yield piece.encode().translate(_FOLD).split()


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(w: np.ndarray, tf: np.ndarray, n: list[int], lens: list[int], n_docs: int, total: int) -> np.ndarray:
    """Of terms with weights w and counts tf, those of each document one after another: documents have n terms, lens of them here."""
    m = np.repeat(np.array([10 + 90 * x * n_docs // total for x in n], np.int64), lens)
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Batch:
    """Items to search together: each one's distinct terms as ascending numbers, and the terms' places in the sketch."""

    def __init__(self, items: list[tuple], width: int):
        self.ids = [i for i, _ in items]
        self.number: dict[bytes, int] = {}
        self.terms = [np.array(sorted({self.number.setdefault(t, len(self.number)) for part in terms(text) for t in part}), np.int64) for _, text in items]
        self.place = np.array([xxhash.xxh64_intdigest(t) % width for t in self.number], np.int64)
        self.width = width

    def lookups(self) -> np.ndarray:
        """For each coordinate and item how many of the item's terms look there."""
        out = np.zeros((self.width, len(self.terms)))
        for k, t in enumerate(self.terms):
            np.add.at(out[:, k], self.place[t], 1)
        return out


class Best:
    """The k best documents of each item so far: greater scores, then smaller ids, null first."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps, self.least = k, [[] for _ in range(items)], np.ones(items)

    def add(self, item: int, score: int, doc_id: int | None) -> None:
        heap, entry = self.heaps[item], (score, math.inf if doc_id is None else -doc_id)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.k:
            self.least[item] = max(1, heap[0][0])

    def rows(self) -> list[tuple]:
        return [(item, None if key == math.inf else -key, score) for item, heap in enumerate(self.heaps) for score, key in heap]


def rescore(best: Best, batch: Batch, lookups: np.ndarray, ids: list, n_terms: list[np.ndarray], impact: np.ndarray) -> int:
    """Take in documents (their term numbers, and the impacts one after another); returns how many exact scores that took."""
    lens = list(map(len, n_terms))
    flat = np.concatenate(n_terms)
    ends = np.cumsum([0, *lens])
    sketch = np.zeros((len(ids), batch.width))
    np.maximum.at(sketch, (np.repeat(np.arange(len(ids)), lens), batch.place[flat]), impact)
    bound = sketch @ lookups
    bound += bound * 1e-12  # sums of doubles beyond 2**53 may lose a unit, a bound must not
    taken = 0
    for item in np.flatnonzero(bound.max(0) >= best.least):
        mine, wanted = bound[:, item], batch.terms[item]
        these = np.flatnonzero(mine >= best.least[item])
        for r in these[np.argsort(-mine[these], kind="stable")]:
            if mine[r] < best.least[item]:
                break
            a, b = ends[r], ends[r + 1]
            at = np.searchsorted(flat[a:b], wanted)
            at[at == b - a] = 0
            score = int(impact[a:b][at[flat[a:b][at] == wanted]].sum())
            taken += 1
            if score > 0:
                best.add(int(item), score, ids[r])
    return taken


def search(docs: DataFrame, items: DataFrame, k: int = 10, width: int = WIDTH, batch_bytes: int = BATCH_BYTES, batch_items: int = BATCH_ITEMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents (doc_id, text) for each of items (item_id, text), scores above 0."""
    bounded_batches(docs.sparkSession)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text <> ''").distinct()
    rows = stored(rows, "items")
    size = F.octet_length("text")
    count, total = rows.where(size <= batch_bytes).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    many = max(1, -(-count // batch_items), -(-total // batch_bytes))
    batches = [rows.where((size <= batch_bytes) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == b)) for b in range(many)]
    batches += [rows.where(size > batch_bytes).where((F.col("item_id").eqNullSafe(F.lit(r.item_id))) & (F.xxhash64("text") == r.of)) for r in rows.where(size > batch_bytes).select("item_id", F.xxhash64("text").alias("of")).toLocalIterator()]
    found = None
    for held in batches:
        one = _search(docs, [tuple(r) for r in held.orderBy("item_id", "text").collect()], k, width)
        found = one if found is None else found.unionAll(one)
    return found


def _search(docs: DataFrame, items: list[tuple], k: int, width: int) -> DataFrame:
    spark = docs.sparkSession
    batch = Batch(items, width)
    sent = spark.sparkContext.broadcast(batch)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("search")
        number = sent.value.number
        for rows in batches:
            out = []
            for doc_id, text in zip(column(rows, "doc_id"), column(rows, "text"), strict=True):
                n, got = 0, []
                for part in terms(text):
                    n += len(part)
                    got += [x for x in map(number.get, part) if x is not None]
                if n:
                    u, tf = np.unique(np.array(got, np.int64), return_counts=True)
                    out.append((doc_id, n, u.astype("<u4").tobytes(), tf.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "n", "terms", "tf"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    counted = stored(read.mapInArrow(tidy(count), "doc_id long, n long, terms binary, tf binary"), "counted")
    n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(sent.value.number), np.int64)
        for rows in batches:
            df += np.bincount(np.frombuffer(b"".join(column(rows, "terms")), "<u4"), minlength=len(df))
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(df[met])], names=["term", "df"])

    df = np.zeros(len(batch.number), np.int64)
    # a row for each of the batch's terms
    for r in counted.select("terms").mapInArrow(tidy(frequencies), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weight = spark.sparkContext.broadcast(weights(df, n_docs))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("search")
        here, w = sent.value, weight.value
        best, lookups = Best(len(here.ids), k), here.lookups()
        for rows in batches:
            numbers = [np.frombuffer(t, "<u4").astype(np.int64) for t in column(rows, "terms")]
            if not numbers:
                continue
            tf = np.frombuffer(b"".join(column(rows, "tf")), "<u4").astype(np.int64)
            made = impacts(w[np.concatenate(numbers)], tf, column(rows, "n"), list(map(len, numbers)), n_docs, total)
            rescore(best, here, lookups, column(rows, "doc_id"), numbers, made)
        out = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([here.ids[r[0]] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64())], names=["item", "item_id", "doc_id", "score"])

    # documents without any of the terms score nothing
    near = counted.where("length(terms) > 0").mapInArrow(tidy(look), "item long, item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first()))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The same rows by DuckDB.
SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
n AS MATERIALIZED (SELECT k, doc_id, len(t) AS n, count(*) OVER () AS nn, (sum(len(t)) OVER ())::BIGINT AS ll FROM d WHERE len(t) > 0),
i AS MATERIALIZED (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))),
p AS MATERIALIZED (SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(t) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
w AS MATERIALIZED (SELECT t, floor(1000 * ln((2 * (SELECT any_value(nn) FROM n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p GROUP BY t),
s AS (
  SELECT q, item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN w USING (t) JOIN p USING (t) JOIN n USING (k) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
