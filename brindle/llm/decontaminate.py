"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact verification.

A document leaks an item if one of its windows of as many words as the item is similar to it: weighted Jaccard of the
two multisets of five-word shingles (sum of the smaller counts over sum of the greater ones) of 0.8 or more. An item of fewer than
five words is one shingle, the whole of it, so a document leaks it where it holds these words in a row.

1. Windows. Each window of a document may be moved right until it starts with a shingle of the item (or ends with the
   document) without losing a shingle they share, so only such windows are looked at; of these only those in which
   enough positions hold shingles of items of that length to reach 0.8. A window keeps the shingle that made it, its anchor.
2. Fingerprints. A window's 64-bit SimHash, each shingle weighted by its count.
3. Blocks. Fingerprints within RADIUS bits agree in at least one of RADIUS + 1 blocks of bits, so an equality join on
   (length, anchor, block, bits) meets all of them that an item with the anchor has; a pair counts at its first block that agrees, and
   the distance itself decides. At similarity 0.8 the distance is about 10 bits and more than
   RADIUS = 20 about once in ten thousand; verbatim windows have distance 0. Of an item with fewer than FEW distinct shingles the
   distance says less (one phrase repeated may lie far from a near copy), so windows go from its anchors straight to 4.
4. Verification of each candidate by the exact weighted similarity.

DataFrame operations only. Documents are cut into shingles where they lie; only positions that hold a shingle of the benchmark leave
the scan: its shingles come there by a broadcast up to BROADCAST_ROWS of them, and beyond as a sieve of up to 2**20 words of bits, which lets few others through before shingles are dealt out. What comes to the driver is
which lengths below five words items have, four numbers at most.

Defined cases: words are lower-cased runs of anything but ASCII white space; a document of fewer words than an item is one window;
documents and items without words (null and empty ones too) leak nothing; rows of equal doc_id are
taken together (the greatest similarity counts); null doc_id is a document of its own for each text; a null item_id is
an item; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import SPACE, settle, stored, unused

SHINGLE, LEAST, BITS, RADIUS, FEW = 5, 0.8, 64, 20, 16
BROADCAST_ROWS = 500_000  # two numbers each: some 30 MB


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")


def shingles(w: Column, k: int = SHINGLE) -> Column:
    """Hashes of the k-word shingles of an array of words, in order; empty with fewer words."""
    n = F.size(w) - (k - 1)
    at = lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k)))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<long>"))


def whole(w: Column) -> Column:
    """Hash of a short array of words as one shingle, as shingles() of as many words has it."""
    out = None
    for k in range(1, SHINGLE):
        one = F.xxhash64(*(F.get(w, j) for j in range(k)))
        out = F.when(F.size(w) == k, one) if out is None else out.when(F.size(w) == k, one)
    return out


def cut(text: Column, sizes: tuple[int, ...] = (SHINGLE,)) -> Column:
    """(n, s): number of words, and for each k of sizes the shingles of k words. The words are bound once: an optimizer that moves the expression cannot repeat them for each shingle."""
    of = lambda w: F.array(*(F.struct(F.lit(k).alias("k"), shingles(w, k).alias("s")) for k in sizes))
    return F.get(F.transform(F.array(words(text)), lambda w: F.struct(F.size(w).alias("n"), of(w).alias("s"))), 0)


def fingerprint(shingle: Column, count: Column) -> list[Column]:
    """Aggregates whose signs are the bits of the SimHash of (shingle, count) rows."""
    one = lambda k: F.when(F.shiftright(shingle, k).bitwiseAND(F.lit(1)) == 1, count).otherwise(-count)
    return [F.sum(one(k)).alias(f"_b{k}") for k in range(BITS)]


def packed() -> Column:
    """The fingerprint's bits in one number."""
    return reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.col(f"_b{k}") > 0, F.lit(1 << k if k < 63 else -(1 << 63))).otherwise(F.lit(0)) for k in range(BITS)))


def _cuts(radius: int) -> list[tuple[int, int]]:
    return [(round(k * BITS / (radius + 1)), round((k + 1) * BITS / (radius + 1))) for k in range(radius + 1)]


def blocks(f: Column, radius: int = RADIUS) -> Column:
    """(number, bits) of radius + 1 blocks that make up the fingerprint."""
    part = lambda a, b: F.shiftrightunsigned(f, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
    return F.array(*(F.struct(F.lit(k).alias("block"), part(a, b).alias("bits")) for k, (a, b) in enumerate(_cuts(radius))))


def first_equal(x: Column, radius: int = RADIUS) -> Column:
    """The first block in which two fingerprints agree, by their exclusive or; null if none."""
    out = None
    for k, (a, b) in enumerate(_cuts(radius)):
        same = F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) == 0
        out = F.when(same, F.lit(k)) if out is None else out.when(same, F.lit(k))
    return out


def matched(x: DataFrame, y: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """An equality join on columns of the same names, kept once; ids that are null meet each other."""
    for n in names:
        y = y.withColumnRenamed(n, f"_right_{n}")
    on = [F.col(n).eqNullSafe(F.col(f"_right_{n}")) if n.endswith("_id") else F.col(n) == F.col(f"_right_{n}") for n in names]
    return x.join(y, on, how).drop(*(f"_right_{n}" for n in names))


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, similarity for each document of docs (doc_id, text) and item of benchmark (item_id, text) it leaks."""
    return leaks_by_text(docs, benchmark, least, radius).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """The rows of docs that leak no item. What leaks is broadcast if it is at most BROADCAST_ROWS rows, else joined."""
    name, of = unused(docs, "_bad"), unused(docs, "_bad_of")
    bad = settle(leaks_by_text(docs, benchmark, least, radius).select(F.col("doc_id").alias(name), F.col("of").alias(of)).distinct())
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.xxhash64(F.col("text")) == F.col(of))
    return docs.join(F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad, on, "left_anti")


SIEVE_BITS = 26  # a row for each 64 of them at most: some 1 M rows of two numbers, whatever the benchmark


def _word(h: Column) -> Column:
    return F.shiftrightunsigned(h.bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)), 6)


def _sieved(placed: DataFrame, bag: DataFrame) -> DataFrame:
    """The rows of placed whose shingle's low SIEVE_BITS bits are those of a shingle of the benchmark."""
    bit = F.col("shingle").bitwiseAND(F.lit(63)).cast("int")
    sieve = bag.select(_word(F.col("shingle")).alias("_word"), bit.alias("bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("_bits"))
    return placed.join(F.broadcast(sieve), _word(F.col("shingle")) == F.col("_word")).where(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def leaks_by_text(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """As leaks(), for each text of a doc_id: `of` is the text's hash."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("w")).select("item_id", F.size("w").alias("len"), F.when(F.size("w") >= SHINGLE, shingles(F.col("w"))).when(F.size("w") > 0, F.array(whole(F.col("w")))).alias("s"))
    # an item is its id and its shingles: rows of equal id but other texts are items of their own
    # (generators are outer ones with a filter above, so that none asks for the arrays' sizes below)
    items = items.withColumn("key", F.xxhash64("s"))
    bag = items.select("item_id", "key", "len", F.explode_outer("s").alias("shingle")).where("shingle is not null").groupBy("item_id", "key", "len", "shingle").agg(F.count("*").alias("n_item"))
    bag = stored(bag.select("item_id", "key", "len", F.least("len", F.lit(SHINGLE)).alias("k"), "shingle", "n_item"), "bench")
    prints = bag.groupBy("item_id", "key", "len").agg(F.count("*").alias("distinct"), *fingerprint(F.col("shingle"), F.col("n_item"))).select("item_id", "key", "len", "distinct", packed().alias("f_item"))
    prints = stored(prints, "bench-prints")
    sizes = (SHINGLE, *sorted(r.len for r in prints.where(F.col("len") < SHINGLE).select("len").distinct().collect()))

    # 1. positions that hold a shingle of an item, for each item length
    whole_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), cut(F.col("text"), sizes).alias("c"))
    known = bag.select("shingle", "len").distinct()
    few = bag.count() <= broadcast_rows
    if len(sizes) == 1:
        placed = whole_docs.select("doc_id", "of", F.col("c.n").alias("n"), F.posexplode_outer(F.get("c.s", 0)["s"]).alias("pos", "shingle"))
    else:
        placed = whole_docs.select("doc_id", "of", F.col("c.n").alias("n"), F.explode_outer("c.s").alias("s")).select("doc_id", "of", "n", F.posexplode_outer("s.s").alias("pos", "shingle"))
    placed = placed.where("shingle is not null")
    # beyond the broadcast bound what no item has does not leave its document: else every shingle of every document would be dealt out
    anchors = placed.join(F.broadcast(known), "shingle") if few else _sieved(placed, bag).join(known, "shingle")
    # a document's positions are no more than its words, so a group is bounded by a row that was read
    per = anchors.groupBy("doc_id", "of", "n", "len").agg(F.array_sort(F.collect_set(F.struct("pos", "shingle"))).alias("at"))
    more = F.least("len", F.lit(SHINGLE)) - 1  # positions that a window's last shingle takes beyond its first word
    end, inner = F.greatest(F.col("n") - F.col("len"), F.lit(0)), F.least("n", "len") - more
    need = F.ceil((inner + F.col("len") - more) * (least / (1 + least)) - 1e-9).cast("int")
    # the need-th position from here on lies in the window; of those behind the last start all do, and so do others before
    last = lambda p, i: F.when(p["pos"] <= end, F.get("at", i + need - 1)["pos"] < p["pos"] + inner).otherwise(F.get("at", F.size("at") - need)["pos"] >= end)
    starts = F.array_distinct(F.transform(F.filter(F.col("at"), last), lambda p: F.struct(F.least(p["pos"], end).alias("start"), p["shingle"].alias("anchor"))))
    windows = stored(per.select("doc_id", "of", "len", F.explode_outer(starts).alias("x")).where("x is not null").select("doc_id", "of", "len", "x.start", "x.anchor"), "windows")

    # 2. the windows' shingles from the few documents that have windows, and their fingerprints
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("of"))
    source = matched(text, windows.select("doc_id", "of").distinct(), "doc_id", "of", how="left_semi").dropDuplicates(["doc_id", "of"])
    source = source.select("doc_id", "of", F.explode_outer(cut(F.col("text"), sizes)["s"]).alias("s")).select("doc_id", "of", F.col("s.k").alias("k"), F.col("s.s").alias("s"))
    held = windows.select("doc_id", "of", "len", "start").distinct().withColumn("k", F.least("len", F.lit(SHINGLE)))
    held = matched(held, source, "doc_id", "of", "k")
    held = held.select("doc_id", "of", "len", "start", F.explode_outer(F.slice("s", F.col("start") + 1, F.col("len") - more)).alias("shingle"))
    held = stored(held.groupBy("doc_id", "of", "len", "start", "shingle").agg(F.count("*").alias("n_doc")), "window-bags")
    f = held.groupBy("doc_id", "of", "len", "start").agg(F.sum("n_doc").alias("size"), *fingerprint(F.col("shingle"), F.col("n_doc"))).select("doc_id", "of", "len", "start", "size", packed().alias("f_doc"))
    f = matched(windows, f, "doc_id", "of", "len", "start")

    # 3. blocks, then the distance
    entries = bag.withColumnRenamed("shingle", "anchor").select("item_id", "key", "len", "anchor")
    entries = matched(entries, prints, "item_id", "key", "len")
    a = f.select("*", F.explode(blocks(F.col("f_doc"), radius)).alias("b")).select("doc_id", "of", "len", "start", "size", "anchor", "f_doc", "b.*")
    b = entries.where(F.col("distinct") >= FEW).select("*", F.explode(blocks(F.col("f_item"), radius)).alias("b")).select("item_id", "key", "len", "anchor", "f_item", "b.*")
    far = F.col("f_doc").bitwiseXOR(F.col("f_item"))
    near = a.join(b, ["len", "anchor", "block", "bits"]).where((F.col("block") == first_equal(far, radius)) & (F.bit_count(far) <= radius))
    direct = f.join(entries.where(F.col("distinct") < FEW), ["len", "anchor"])
    near = near.select("doc_id", "of", "len", "start", "size", "item_id", "key").unionAll(direct.select("doc_id", "of", "len", "start", "size", "item_id", "key")).distinct()

    # 4. what both hold
    both = matched(near, held, "doc_id", "of", "len", "start")
    both = matched(both, bag.drop("len", "k"), "item_id", "key", "shingle").withColumn("common", F.least("n_doc", "n_item"))
    total = F.col("size") + F.col("len") - more
    found = both.groupBy("doc_id", "of", "start", "item_id", "key", "size", "len").agg(F.sum("common").alias("common"))
    found = found.withColumn("similarity", F.col("common") / (total - F.col("common"))).where(F.col("common") * (1 + least) >= least * total - 1e-9)
    return found.groupBy("doc_id", "of", "item_id").agg(F.max("similarity").alias("similarity"))


#: The same rows by DuckDB: every window that starts with a shared shingle or ends the document, without fingerprints.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT item_id, row_number() OVER () AS key, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
m AS (SELECT DISTINCT least(len(w), 5) AS m FROM i WHERE len(w) > 0),
ds AS MATERIALIZED (SELECT doc_id, k, m, len(w) AS n, unnest(range(len(w) - m + 1)) AS pos, array_to_string(w[pos + 1 : pos + m], ' ') AS s FROM d JOIN m ON len(w) >= m),
ie AS (SELECT item_id, key, len(w) AS len, least(len(w), 5) AS m, unnest(range(len(w) - m + 1)) AS pos, array_to_string(w[pos + 1 : pos + m], ' ') AS s FROM i WHERE len(w) > 0),
bag AS MATERIALIZED (SELECT item_id, key, len, m, s, count(*) AS c FROM ie GROUP BY ALL),
hits AS MATERIALIZED (SELECT k, n, m, pos, s, item_id, key, len, c FROM ds JOIN bag USING (s, m)),
wins AS (SELECT DISTINCT k, n, m, key, item_id, len, least(pos, greatest(n - len, 0)) AS start FROM hits),
common AS (
  SELECT v.k, v.key, v.item_id, v.start, v.n, v.len, v.m, h.s, least(count(*), any_value(h.c)) AS c
  FROM wins v JOIN hits h ON v.k = h.k AND v.key = h.key AND h.pos >= v.start AND h.pos <= v.start + v.len - v.m GROUP BY ALL),
sims AS (SELECT k, key, item_id, start, sum(c) / (least(n, len) + len - 2 * m + 2 - sum(c)) AS sim FROM common GROUP BY k, key, item_id, start, n, len, m)
SELECT doc_id, item_id, round(max(sim), 6) AS similarity FROM sims JOIN d USING (k) WHERE sim >= 0.8 - 1e-9 GROUP BY doc_id, item_id
"""
