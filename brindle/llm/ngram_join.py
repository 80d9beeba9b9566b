"""N-gram Jaccard join: documents whose sets of word shingles are similar, as connected components.

Exact: two documents are joined if and only if a chain of pairs of similarity num/den or more leads from one to the other.

1. Sets. A document's shingles become 64-bit hashes; equal sets are one node from then on, so copies cost
   nothing further however many there are.
2. Sieve. Similar sets A and B share num/den of either, so among the |A| - ceil(t |A|) + l least hashes of A at least l are B's
   too, and are among B's. A node whose sample has too few hashes that any other node's sample has is alone. Only samples are dealt out.
3. Global order. The full sets of the nodes that are left are ordered by document frequency, rarest first (frequencies
   are counted in parts: each block of nodes counts for itself before anything is dealt out). Nodes that share a token of
   their prefixes of |A| - ceil(t |A|) + 1 tokens are candidates; tokens that one node has join nothing.
4. Clusters of candidates are connected components of the token-to-least-node edges. Every link lies within a cluster.
5. Prefix trees (prefix_tree.py). A cluster is one tree, or, beyond CHUNK tokens, several: each chunk is joined
   in itself; then one node for each component found is joined with those of other chunks, until that finds no more; at last
   the nodes outside the cluster's largest component are sought in all its chunks. No task holds more than two chunks.

Texts are read twice, and shuffled only in part: the second pass takes the nodes that the sieve left. Defined cases: words
are runs of anything but ASCII white space, A to Z lowered; with fewer than n words the whole sequence is the one shingle; without words
the set is empty and linked with nothing; rows of equal doc_id or none are rows of their own; component_id is the
least doc_id of the component (null if it has none); a row for each input row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import KEPT_BYTES, bounded_batches, column, pieces, settle, stored, take_turn, tidy, unused
from brindle.llm.components import components
from brindle.llm.prefix_tree import degrees, links

#: Tokens of a tree at most (a longer set is a chunk of its own), of a block of nodes, and of a bucket of hashes on average.
CHUNK, BLOCK, BUCKET = 400_000, 500_000, 250_000
NODES = 60_000  # of a block at most: a node is its block's number and 16 bits, a block its partition's and 24
SLACK = 20  # l is a 20th of a set
BROADCAST_ROWS = 500_000  # two numbers each: some 30 MB
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sets of hashed n-word shingles; hashes of words met before are kept, to a bound."""

    def __init__(self, n: int, keep: int = 100_000):
        self.n, self.keep, self.known = n, keep, {}

    def words(self, text: str) -> np.ndarray:
        out = []
        for piece in pieces(text):
            words = piece.encode().lower().split()  # bytes lower A to Z and part at ASCII white space only
            ids = list(map(self.known.get, words))
            if None in ids:
                made = {w: xxhash.xxh64_intdigest(w) for w, k in zip(words, ids, strict=True) if k is None}
                ids = [made[w] if k is None else k for w, k in zip(words, ids, strict=True)]
                if len(self.known) + len(made) <= self.keep:
                    self.known |= {w: x for w, x in made.items() if len(w) <= KEPT_BYTES}
            out.append(np.array(ids, np.uint64))
        return np.concatenate(out) if len(out) > 1 else out[0]

    def set_of(self, text: str | None) -> np.ndarray:
        """Ascending distinct hashes."""
        w = self.words(text) if text else np.zeros(0, np.uint64)
        if not len(w):
            return w
        k = min(self.n, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for j in range(k):
            h = (h ^ w[j : len(w) - k + 1 + j]) * _MIX
            h ^= h >> np.uint64(29)
        return np.unique(_finish(h))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def spare(n: int, num: int, den: int) -> int:
    """How many of its n tokens a set need not share with a similar one: n - ceil(n * num / den)."""
    return n - -(-n * num // den)


def _from48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def _blocks(texts: DataFrame, n: int, most: int) -> DataFrame:
    """Sets of the rows of texts (text), packed: block, hi, lo, n, lens (arrays), tokens (one after another)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("shingles")
        make, part, count, held, size = Shingler(n), TaskContext.get().partitionId(), 0, [], 0

        def row():
            return _batch([((part << 24) + count, [h[0] for h in held], [h[1] for h in held], [h[2] for h in held], [h[2] for h in held], b"".join(h[3] for h in held))], _BLOCK_NAMES, _BLOCK_KINDS())

        for batch in batches:
            for text in column(batch, "text"):
                s = make.set_of(text)
                if not len(s):
                    continue
                held.append((*fingerprint(s), len(s), s.astype("<u8").tobytes()))
                size += len(s)
                if size >= most or len(held) == NODES:
                    yield row()
                    count, held, size = count + 1, [], 0
        if held:
            yield row()

    return texts.select("text").mapInArrow(tidy(run), "block long, hi array<long>, lo array<long>, n array<long>, lens array<long>, tokens binary")


_BLOCK_NAMES = ["block", "hi", "lo", "n", "lens", "tokens"]


def _BLOCK_KINDS():
    return [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary()]


def _cuts(tokens: np.ndarray, buckets: int, bits: int) -> Iterator[tuple[int, int, int]]:
    """bucket, begin, end over ascending tokens: ascending tokens fall into ascending buckets."""
    b = ((tokens >> np.uint64(bits - 31)).astype(np.int64) * buckets) >> 31  # fewer than 2**31 buckets
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(b)) + 1, [len(tokens)]))
    return ((int(b[x]), int(x), int(y)) for x, y in zip(cuts, cuts[1:]) if y > x)


def _six(t: np.ndarray) -> bytes:
    return t.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _shared_counts(rows: DataFrame, total: int) -> DataFrame:
    """block, place, have: for rows (block, place, sample) how many of the sample's tokens another row has, where any.

    A block (its rows lie together) sends each of its distinct tokens once, with the place of the row that has it. Of a token that
    several of its own rows have it sends no place but a mark, and counts for them itself: a token that every row has
    is one entry of each block. Rows of one set count as others here; that only lets them through.
    """
    buckets = max(8, total // BUCKET)
    several = 0xFFFF

    def one(block: int, places: list[int], samples: list[bytes]) -> pa.RecordBatch:
        t = _from48(b"".join(samples))
        of = np.repeat(np.asarray(places, np.int64), [len(x) // 6 for x in samples])
        u, at, back, c = np.unique(t, return_index=True, return_inverse=True, return_counts=True)
        mine = of[c[back] > 1].astype("<u2")
        place = np.where(c > 1, several, of[at]).astype("<u2")
        out = [(-1 - block % buckets, block, b"", mine.tobytes())]
        out += [(k, block, _six(u[x:y]), place[x:y].tobytes()) for k, x, y in _cuts(u, buckets, 48)]
        return _batch(out, ["bucket", "block", "tokens", "places"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, samples = None, [], []
        for batch in batches:
            for block, place, sample in zip(*(column(batch, c) for c in ("block", "place", "sample")), strict=True):
                if block != now and places:
                    yield one(now, places, samples)
                    places, samples = [], []
                now = block
                places.append(place)
                samples.append(sample)
        if places:
            yield one(now, places, samples)

    def count(key, table):
        blocks, places = table["block"].to_pylist(), [np.frombuffer(x, "<u2") for x in table["places"].to_pylist()]
        if key[0].as_py() >= 0:
            parts = [_from48(x) for x in table["tokens"].to_pylist()]
            mark = np.concatenate(places) == several
            _, back = np.unique(np.concatenate(parts), return_inverse=True)
            more = (np.bincount(back, 1 + mark)[back] > 1) & ~mark
            ends = np.cumsum([0, *map(len, places)])
            places = [p[more[x:y]] for p, x, y in zip(places, ends, ends[1:])]
        rows = [(block, p.tobytes()) for block, p in zip(blocks, places, strict=True) if len(p)]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary()))], names=["block", "places"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, parts in zip(column(batch, "block"), column(batch, "parts"), strict=True):
                u, c = np.unique(np.frombuffer(b"".join(parts), "<u2"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), block, np.int64)), pa.array(u.astype(np.int64)), pa.array(c.astype(np.int64))], names=["block", "place", "have"])

    dealt = rows.select("block", "place", "sample").mapInArrow(tidy(deal), "bucket long, block long, tokens binary, places binary")
    counted = dealt.groupBy("bucket").applyInArrow(count, "block long, places binary")
    # a bucket sends a block one row, and a block's rows are no more than its own tokens
    return counted.groupBy("block").agg(F.collect_list("places").alias("parts")).mapInArrow(tidy(sums), "block long, place long, have long")


def _frequencies(blocks: DataFrame, total: int) -> DataFrame:
    """block, parts (bucket, codes): for each block how many nodes anywhere have each of its distinct tokens, two bytes a token.

    A block sends each of its distinct tokens once, with its own count. Counts end at 65535: tokens beyond are alike in
    the order by (count, token), which stays the same for all sets.
    """
    buckets = max(8, total // BUCKET)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens in zip(column(batch, "block"), column(batch, "tokens"), strict=True):
                u, c = np.unique(np.frombuffer(tokens, "<u8"), return_counts=True)
                rows = []
                for k, x, y in _cuts(u, buckets, 64):
                    many = np.flatnonzero(c[x:y] > 1)
                    rows.append((k, block, u[x:y].tobytes(), many.astype("<u4").tobytes(), c[x:y][many].astype("<u4").tobytes()))
                yield _batch(rows, ["bucket", "block", "tokens", "at", "more"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])

    def count(key, table):
        parts, sums = [], []
        for tokens, at, more in zip(*(table[c].to_pylist() for c in ("tokens", "at", "more")), strict=True):
            parts.append(np.frombuffer(tokens, "<u8"))
            n = np.ones(len(parts[-1]), np.int64)
            n[np.frombuffer(at, "<u4")] = np.frombuffer(more, "<u4")
            sums.append(n)
        _, back = np.unique(np.concatenate(parts), return_inverse=True)
        codes = np.minimum(np.bincount(back, np.concatenate(sums)), 0xFFFF).astype("<u2")[back]
        ends = np.cumsum([0, *map(len, parts)])
        own = [codes[x:y].tobytes() for x, y in zip(ends, ends[1:])]
        return pa.table([table["block"].combine_chunks(), pa.array([key[0].as_py()] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["block", "bucket", "codes"])

    dealt = blocks.select("block", "tokens").mapInArrow(tidy(deal), "bucket long, block long, tokens binary, at binary, more binary")
    counted = dealt.groupBy("bucket").applyInArrow(count, "block long, bucket long, codes binary")
    return counted.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "codes"))).alias("parts"))


def joined(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, chunk: int = CHUNK, block: int = BLOCK, counted: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, and hi, lo (fingerprint of the set), for each row of docs (doc_id, text).

    counted: with n_links, too: how many other rows have a set of similarity num/den or more (copies are links; none without words).
    """
    tagged = _tagged(docs, n, num, den, chunk, block, counted)
    more = ["n_links"] if counted else []
    # sets that stand alone need no join; of the others a row for each component, or set that is repeated, comes to its documents
    of_set = tagged.where("hi is not null").select(F.coalesce("root", "hi").alias("_a"), F.when(F.col("root").isNull(), F.col("lo")).alias("_b"), "doc_id")
    least = settle(of_set.groupBy("_a", "_b").agg(F.min("doc_id").alias("_m"), F.count("*").alias("_rows")).where("_rows > 1").drop("_rows"))
    least = F.broadcast(least) if least.count() <= BROADCAST_ROWS else least
    own = tagged.withColumns({"a": F.coalesce("root", "hi"), "b": F.when(F.col("root").isNull(), F.col("lo"))})
    found = own.join(least, (F.col("a") == F.col("_a")) & F.col("b").eqNullSafe(F.col("_b")), "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_m", "doc_id").alias("component_id"), "hi", "lo", *more)


def first_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """The rows of docs but for all but one of each component: that of the least doc_id stays (null last; of several, one row).

    Rows without words are linked with nothing and stay. What goes is broadcast if it is at most BROADCAST_ROWS rows,
    else joined; texts are dealt out only in the latter case, and those of rows that are repeated as a whole.
    """
    tagged = _tagged(docs, n, num, den, chunk, block).where("hi is not null")
    # a component is its root, or the set itself where nothing else is linked with it
    own = tagged.withColumns({"a": F.coalesce("root", "hi"), "b": F.when(F.col("root").isNull(), F.col("lo")), "row": F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "of")})
    rows = own.groupBy("a", "b", "row").agg(F.count("*").alias("many"))
    least = rows.groupBy("a", "b").agg(F.min("row").alias("least"), F.count("*").alias("rows"), F.sum("many").alias("all")).where("all > 1")
    marked = rows.join(least.withColumnsRenamed({"a": "_a", "b": "_b"}), (F.col("a") == F.col("_a")) & F.col("b").eqNullSafe(F.col("_b")))
    marked = settle(marked.select("row.doc_id", "row.of", (F.col("row") == F.col("least")).alias("stays"), "many").where("not stays or many > 1"))

    gone, of = unused(docs, "_gone"), unused(docs, "_of")

    def without(rows: DataFrame, which: DataFrame, how: str) -> DataFrame:
        which = which.select(F.col("doc_id").alias(gone), F.col("of").alias(of)).distinct()
        few = which.count() <= BROADCAST_ROWS
        return rows.join(F.broadcast(which) if few else which, F.col("doc_id").cast("long").eqNullSafe(F.col(gone)) & (F.xxhash64(F.col("text").cast("string")) == F.col(of)), how)

    kept = without(docs, marked, "left_anti")
    repeated = marked.where("stays")
    if not repeated.isEmpty():
        again = without(docs, repeated, "left_semi").withColumn(of, F.xxhash64(F.col("text").cast("string")))
        kept = kept.unionByName(again.dropDuplicates(["doc_id", of]).drop(of))
    return kept


def _tagged(docs: DataFrame, n: int, num: int, den: int, chunk: int, block: int, counted: bool = False) -> DataFrame:
    """doc_id, of (hash of the text), n, hi, lo, root (and n_links) for each row of docs; root is null where a set is linked with no other."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("shingles")
        make = Shingler(n)
        number, place, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            out = []
            for doc_id, of, text in zip(*(column(batch, c) for c in ("doc_id", "of", "text")), strict=True):
                s = make.set_of(text)
                hi, lo = fingerprint(s) if len(s) else (None, None)
                sample = _six(s[: spare(len(s), num, den) + len(s) // SLACK + 1] >> np.uint64(16))
                if place == NODES or size > 6 * block:
                    number, place, size = number + 1, 0, 0
                out.append((doc_id, of, len(s), hi, lo, number, place, sample))
                place += 1
                size += len(sample)
            yield _batch(out, ["doc_id", "of", "n", "hi", "lo", "block", "place", "sample"], [pa.int64()] * 7 + [pa.binary()])

    # 1. a row for each document; nodes are distinct sets
    read = stored(rows.select("doc_id", F.xxhash64("text").alias("of"), "text").mapInArrow(tidy(sets), "doc_id long, of long, n long, hi long, lo long, block long, place long, sample binary"), "sets")

    # 2. the sieve; need is the least l of a similar set, which may be the smaller
    total = read.agg(F.coalesce(F.sum(F.length("sample")), F.lit(0))).first()[0] // 6
    need = F.floor(F.ceil(F.col("n") * num / den - 1e-9) / SLACK) + 1
    have = _shared_counts(read.where("n > 0"), total)
    left = read.where("n > 0").select("block", "place", "n", "hi", "lo").join(have, ["block", "place"]).where(F.col("have") >= need)
    left = settle(left.select("hi", "lo").distinct())
    few = left.count() <= BROADCAST_ROWS
    hint = F.broadcast if few else (lambda x: x)

    # 3. full sets of what is left, from one row each
    first = read.where("n > 0").join(hint(left), ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "of")).alias("row")).select("row.*").distinct()
    first = settle(first.withColumnRenamed("doc_id", "_d").withColumnRenamed("of", "_o"))
    again = rows.withColumn("of", F.xxhash64("text")).join(hint(first), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("of") == F.col("_o")), "left_semi").select("text")

    # (a set twice, from rows repeated as a whole, does no harm)
    blocks = stored(_blocks(again, n, block), "blocks")
    total = blocks.agg(F.coalesce(F.sum(F.length("tokens")), F.lit(0))).first()[0] // 8

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens of prefixes with the least node of the block that has each, and the other nodes of the block."""
        for batch in batches:
            for number, size, lens, tokens, parts in zip(*(column(batch, c) for c in ("block", "n", "lens", "tokens", "parts")), strict=True):
                t = np.frombuffer(tokens, "<u8")
                every = np.frombuffer(b"".join(p["codes"] for p in parts), "<u2")[np.unique(t, return_inverse=True)[1]]
                x, own, who = 0, [], []
                for k, m in enumerate(size):
                    d = every[x : x + m]
                    p = np.lexsort((t[x : x + m], d))[: spare(m, num, den) + 1]
                    p = p[d[p] > 1]
                    own.append(t[x : x + m][p])
                    who.append(np.full(len(p), (number << 16) + k))
                    x += m
                own, who = np.concatenate(own), np.concatenate(who)
                tok, at, back = np.unique(own, return_index=True, return_inverse=True)
                least = who[at]  # nodes ascend, so the first is the least
                inner = np.unique(np.stack([least[back], who]), axis=1)
                inner = inner[:, inner[0] != inner[1]]
                kind = np.concatenate((np.zeros(len(tok), np.int64), np.ones(inner.shape[1], np.int64)))
                a, b = np.concatenate((tok.view(np.int64), inner[0])), np.concatenate((least, inner[1]))
                for s in range(0, len(a), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(v[s : s + 20_000]) for v in (kind, a, b)], names=["kind", "a", "b"])

    # 4. clusters: in a block here, between blocks by the least node of each token
    found = stored(blocks.join(_frequencies(blocks, total), "block").mapInArrow(tidy(prefixes), "kind long, a long, b long"), "prefixes")
    across = found.where("kind = 0").select(F.col("a").alias("token"), F.col("b").alias("node"))
    least = across.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    across = across.join(least, "token").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    cluster = settle(components(found.where("kind = 1").select("a", "b").unionAll(across)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, hi, lo, size, tokens in zip(*(column(batch, c) for c in ("block", "hi", "lo", "n", "tokens")), strict=True):
                x, out = 0, []
                for k, m in enumerate(size):
                    out.append(((number << 16) + k, hi[k], lo[k], m, tokens[8 * x : 8 * (x + m)]))
                    x += m
                for s in range(0, len(out), 500):
                    yield _batch(out[s : s + 500], ["node", "hi", "lo", "n", "tokens"], [pa.int64()] * 4 + [pa.binary()])

    # a node's chunk is settled by numbers alone, so its set is dealt out once
    sizes = blocks.select("block", F.posexplode("n").alias("at", "n")).select((F.shiftleft("block", 16) + F.col("at")).alias("node"), "n")
    cluster = settle(_chunked(cluster.withColumnRenamed("root", "cluster").join(sizes, "node"), chunk).drop("n"))
    members = blocks.mapInArrow(tidy(spread), "node long, hi long, lo long, n long, tokens binary")
    members = members.join(F.broadcast(cluster) if cluster.count() <= BROADCAST_ROWS else cluster, "node")
    members = stored(members, "members")
    root = _linked(members, num, den, chunk)

    # 5. back to the documents
    node = members.select("node", "hi", "lo").join(root, "node").select("hi", "lo", "root").dropDuplicates(["hi", "lo"])
    tagged = read.select("doc_id", "of", "n", "hi", "lo").join(node.withColumnsRenamed({"hi": "_h", "lo": "_l"}), (F.col("hi") == F.col("_h")) & (F.col("lo") == F.col("_l")), "left")
    if not counted:
        return settle(tagged.select("doc_id", "of", "n", "hi", "lo", "root"))
    copies = settle(read.where("n > 0").groupBy("hi", "lo").agg(F.count("*").alias("copies")))
    once = members.groupBy("hi", "lo").agg(F.min("node").alias("node")).join(copies, ["hi", "lo"])  # a set may be there twice
    degree = _degrees(members.select("cluster", "chunk", "node", "tokens").join(once.select("node", "copies"), "node"), num, den)
    per = copies.join(once.select("hi", "lo", "node").join(degree, "node"), ["hi", "lo"], "left").select(F.col("hi").alias("_h"), F.col("lo").alias("_l"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    tagged = tagged.select("doc_id", "of", "n", "hi", "lo", "root").join(per, (F.col("hi") == F.col("_h")) & (F.col("lo") == F.col("_l")), "left")
    return settle(tagged.select("doc_id", "of", "n", "hi", "lo", "root", F.coalesce("n_links", F.lit(0)).alias("n_links")))


def _degrees(rows: DataFrame, num: int, den: int) -> DataFrame:
    """node, links of the nodes of rows (cluster, chunk, node, tokens, copies): each chunk in itself, and with each other chunk of its cluster."""

    def run(key, table):
        nodes, chunks = table["node"].to_pylist(), table["chunk"].to_pylist()
        seek = None if key[1] == key[2] else [k for k, c in enumerate(chunks) if c == key[1].as_py()]
        found = degrees([np.frombuffer(t, "<u8") for t in table["tokens"].to_pylist()], num, den, table["copies"].to_pylist(), seek)
        return pa.table([pa.array(nodes, pa.int64()), pa.array(found, pa.int64())], names=["node", "links"])

    chunks = rows.select("cluster", "chunk").distinct()
    pairs = chunks.withColumnRenamed("chunk", "a").join(chunks.withColumnRenamed("chunk", "b"), "cluster").where("a <= b")
    sides = pairs.select("cluster", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk"))
    dealt = rows.join(sides, ["cluster", "chunk"]).select("cluster", "a", "b", "chunk", "node", "tokens", "copies")
    return dealt.groupBy("cluster", "a", "b").applyInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def _pairs(rows: DataFrame, by: list[str], num: int, den: int) -> DataFrame:
    """Links a, b between nodes (node, tokens, label, sought) that share `by`: a group is two chunks at most."""

    def run(key, table):
        nodes = table["node"].to_pylist()
        found = []
        if len(nodes) > 1:
            sets = [np.frombuffer(t, "<u8") for t in table["tokens"].to_pylist()]
            sought = [k for k, s in enumerate(table["sought"].to_pylist()) if s]
            found = links(sets, num, den, table["label"].to_pylist(), sought if len(sought) < len(nodes) else None)
        return pa.table([pa.array([nodes[a] for a, _ in found], pa.int64()), pa.array([nodes[b] for _, b in found], pa.int64())], names=["a", "b"])

    return rows.select(*by, "node", "tokens", "label", "sought").groupBy(*by).applyInArrow(run, "a long, b long")


def _chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """Adds `chunk` and `large` to rows (cluster, node, n): a cluster beyond `chunk` tokens has as many chunks as it needs, dealt by hash."""
    sums = rows.groupBy("cluster").agg(F.sum("n").alias("size"))
    large = sums.where(F.col("size") > chunk)
    many = F.ceil(F.coalesce(F.col("size"), F.lit(1)) / chunk).cast("long")
    return rows.join(large, "cluster", "left").withColumn("chunk", F.when(F.col("size").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), many))).withColumn("large", F.col("size").isNotNull()).drop("size")


def _linked(members: DataFrame, num: int, den: int, chunk: int) -> DataFrame:
    """node, root of the nodes of members (cluster, chunk, large, node, n, tokens)."""
    found = settle(_pairs(members.withColumn("label", F.col("node")).withColumn("sought", F.lit(True)), ["cluster", "chunk"], num, den))
    root = settle(components(found))
    where = settle(members.where("large").select("cluster", "chunk", "node", "n"))
    if where.isEmpty():
        return root

    def labelled(x: DataFrame) -> DataFrame:
        return x.join(root.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").withColumn("label", F.coalesce("root", "node")).drop("_n", "root")

    def add(more: DataFrame) -> bool:
        nonlocal found, root
        more = settle(more)
        if more.isEmpty():
            return False
        found = settle(found.unionAll(more))
        root = settle(components(found))
        return True

    # one node for each component, joined across the chunks of its cluster while that joins any
    tokens = stored(members.where("large").select("node", "tokens"), "large")
    while True:
        reps = labelled(where).groupBy("cluster", "label").agg(F.min("node").alias("node"), F.min_by("n", "node").alias("n")).select("cluster", "node", "n")
        reps = _chunked(reps, chunk).join(tokens, "node").withColumn("label", F.col("node")).withColumn("sought", F.lit(True))
        if not add(_pairs(reps, ["cluster", "chunk"], num, den)):
            break
    # the nodes outside the largest component of their cluster, sought in every chunk of it
    now = settle(labelled(where))
    per = now.groupBy("cluster", "label").agg(F.sum("n").alias("size"))
    top = per.groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    rest = now.join(top, "cluster").where("label <> top").select("cluster", "node", "n", "label")
    rest = _chunked(rest, chunk).withColumnRenamed("chunk", "seeker").drop("large")
    in_chunks = now.join(top.select("cluster"), "cluster")
    groups = rest.select("cluster", "seeker").distinct()
    chunks = in_chunks.select("cluster", "chunk").distinct()
    seeking = rest.join(chunks, "cluster").select("cluster", "chunk", "seeker", "node", "label", F.lit(True).alias("sought"))
    held = in_chunks.join(groups, "cluster").select("cluster", "chunk", "seeker", "node", "label", F.lit(False).alias("sought"))
    # a node on both sides is there once, as sought
    rows = seeking.unionAll(held).groupBy("cluster", "chunk", "seeker", "node", "label").agg(F.max("sought").alias("sought")).join(tokens, "node")
    add(_pairs(rows, ["cluster", "chunk", "seeker"], num, den))
    return root


#: The same rows by DuckDB, for tables small enough to compare all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT k, array_to_string(w[p : p + 3], ' ') AS s
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
pairs AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.k < b.k GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT k AS a, k AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id, coalesce(any_value(c.c), 0)::BIGINT AS n_links
FROM d LEFT JOIN n ON n.k = d.k LEFT JOIN (SELECT a, count(*) AS c FROM e GROUP BY a) c ON c.a = d.k JOIN r ON r.a = d.k JOIN d o ON o.k = r.b GROUP BY d.k, d.doc_id
"""
