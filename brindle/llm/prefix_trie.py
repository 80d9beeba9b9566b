"""Prefix trie of conversations, rolled up by centroid decomposition.

Every conversation c is rebuilt: the first h turns of conversation c - c % 100 (all if it has fewer, none if it is absent), then its own turns after its
first h, h = crc32(decimal c) % 6. A node is a distinct sequence of first turns (role, text); conversations that begin with it are its members.

1. Keys. A turn is 16 bytes of SHA-256; a sequence's key is the polynomial of its turns at BASE modulo 2**127 - 1, so the key of a
   sequence follows from those of its parts. Turns are sorted over all tasks by ranges of (conversation, turn), each task sums up its own part of a
   conversation, and what lies in tasks before is added: a conversation of any length needs no task of its own.
2. Nodes are one aggregate of the rebuilt rows by key, with partial sums: members, the least of them, the parent's key.
3. Rollup. The parent edges are a tree. A component's centroid is the deepest node with at least half of its weight below it. What lies
   below the centroid, and itself, is summed up (the component's total below it) and added to each node on the path from the centroid to the component's top;
   then the centroid is taken out and what is left, one component above and one for each child, goes on likewise. While components have more
   than `limit` nodes this is done by joins, all components at once: weight counts members, which need no tree to be summed; whether a node lies below a centroid, and under which
   child, says the row of its least member at that depth; the path is the rows of the centroid's least member. Each level halves the weight, so levels are few however deep
   the tree is, and the path's rows are in no other component. Components of up to `limit` nodes are sorted together and decomposed one after another within tasks.
4. Digests. Members that end at a node are sorted over all tasks by (node, id); each task makes pieces of the joined text, and a node's pieces go
   through SHA-256 in order. No list of members is ever one row.

Defined cases: null role or text is empty, null turns come first; equal turns of a conversation go by role and text (by the first 32 characters of each, then
by their hash), repeated rows are turns of their own; rows without conv_id are left out; an empty table gives no rows; a table has
one root, of which conversations without turns are members; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import bounded_batches, column, settle, stored, tidy

P = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15
LIMIT, COMPONENTS = 512, 20_000
SEGMENT = 4096
PIECE = 1 << 20
ROOT = bytes(16)
HEADS = 5  # h is at most that


def _key(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _int(x: bytes) -> int:
    return int.from_bytes(x, "big")


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, r (from 1), size (code points), key and before (keys of the conversation's first r and r - 1 turns) of each turn."""
    bounded_batches(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(role, 1, 32).alias("_role"),
        F.substring(text, 1, 32).alias("_head"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("id"),
        F.length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("_row"),  # parts rows that are alike
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "_role", "_head", "id", "_row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "id", "size")
    names, kinds = ["conv_id", "part", "r", "size", "key", "before", "last"], [*[pa.int64()] * 4, pa.binary(), pa.binary(), pa.bool_()]
    schema = "conv_id long, part long, r long, size long, key binary, before binary, last boolean"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, r, key = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            out = []
            for c, t, size in zip(*(column(batch, x) for x in ("conv_id", "id", "size")), strict=True):
                if c != now:
                    now, r, key = c, 0, 0
                before, key, r = key, (key * BASE + _int(t)) % P, r + 1
                out.append((c, part, r, size, _key(key), _key(before), False))
            yield _table(out, names, kinds)
        if r:
            yield _table([(now, part, r, 0, _key(key), ROOT, True)], names, kinds)

    scanned = stored(rows.mapInArrow(tidy(scan), schema), "turns")
    # what the tasks before have of a task's first conversation: from a row for each task
    carry: dict[int, tuple[int, int, int]] = {}
    held = None
    for p, c, r, key in sorted((x.part, x.conv_id, x.r, _int(x.key)) for x in scanned.where("last").select("part", "conv_id", "r", "key").collect()):
        if held:
            carry[p] = held
        held = (c, held[1] + r, (held[2] * pow(BASE, r, P) + key) % P) if held and held[0] == c else (c, r, key)
    sent = conversations.sparkSession.sparkContext.broadcast(carry)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c, p, r, size, key, before in zip(*(column(batch, x) for x in names[:-1]), strict=True):
                had = sent.value.get(p)
                if had and had[0] == c:
                    key = _key((had[2] * pow(BASE, r, P) + _int(key)) % P)
                    before = _key((had[2] * pow(BASE, r - 1, P) + _int(before)) % P)
                    r += had[1]
                out.append((c, r, size, key, before))
            yield _table(out, ["conv_id", "r", "size", "key", "before"], [*[pa.int64()] * 3, pa.binary(), pa.binary()])

    return stored(scanned.where("not last").drop("last").mapInArrow(tidy(add), "conv_id long, r long, size long, key binary, before binary"), "turns")


def segment(at: Column) -> Column:
    return F.floor(at / SEGMENT).cast("long")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, key, prev (the key one turn before), size (of the last turn), len (turns of the whole) for each depth, 0 included, of each rebuilt conversation."""
    rows = turns(conversations)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6)).cast("long")
    donor = F.col("conv_id") - F.col("conv_id") % 100
    own = rows.withColumn("h", h).groupBy("conv_id", "h").agg(F.max("r").alias("n"), F.max(F.when(F.col("r") == F.col("h"), F.col("key"))).alias("own"))
    own = settle(own.withColumn("donor", donor))
    donors = own.where("conv_id = donor").select(F.col("conv_id").alias("donor"), F.col("n").alias("m"))
    heads = settle(rows.where((F.col("conv_id") == donor) & (F.col("r") <= HEADS)).select(F.col("conv_id").alias("donor"), F.col("r").alias("k"), "key", F.col("before").alias("prev"), "size"))
    each = own.join(donors, "donor", "left").withColumn("g", F.least("h", F.coalesce("m", F.lit(0))))
    each = each.withColumn("len", F.col("g") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    at_g = heads.select(F.col("donor").alias("_d"), F.col("k").alias("_k"), F.col("key").alias("given"))
    each = settle(each.join(at_g, (F.col("donor") == F.col("_d")) & (F.col("g") == F.col("_k")), "left").select("conv_id", "donor", "h", "n", "g", "len", "own", "given"))

    roots = each.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("prev"), F.lit(0).cast("long").alias("size"), "len")
    given = each.where("g > 0").select("conv_id", "donor", "g", "len").join(heads, "donor").where("k <= g").select("conv_id", F.col("k").alias("depth"), "key", "prev", "size", "len")
    # a conversation's row comes once for each segment of its turns, so that a long one is many keys
    segments = each.where("n > h").select("*", F.explode(F.sequence(F.lit(0), segment(F.col("n")))).alias("seg")).select(F.col("conv_id").alias("_c"), F.col("seg").cast("long").alias("seg"), "h", "g", "len", "own", "given")
    rest = rows.join(segments, (F.col("conv_id") == F.col("_c")) & (segment(F.col("r")) == F.col("seg"))).where("r > h")

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c, r, size, key, before, h, g, n, own, given in zip(*(column(batch, x) for x in ("conv_id", "r", "size", "key", "before", "h", "g", "len", "own", "given")), strict=True):
                if own != given:  # the turns after the first h behind another beginning
                    change = (_int(given or ROOT) - _int(own or ROOT)) % P
                    key = _key((_int(key) + change * pow(BASE, r - h, P)) % P)
                    before = _key((_int(before) + change * pow(BASE, r - h - 1, P)) % P)
                out.append((c, g + r - h, key, before, size, n))
            yield _table(out, ["conv_id", "depth", "key", "prev", "size", "len"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()])

    schema = "conv_id long, depth long, key binary, prev binary, size long, len long"
    rest = rest.select("conv_id", "r", "size", "key", "before", "h", "g", "len", "own", "given").mapInArrow(tidy(shift), schema)
    return stored(roots.unionAll(given).unionAll(rest), "rebuilt")


def centroids(parent: list[int], weights: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums of weights over the subtrees of a tree, by centroid decomposition. Nodes stand after their parents; the top's parent is -1."""
    n, m = len(parent), len(weights[0])
    out = [[0] * m for _ in range(n)]
    size, label = [0] * n, [0] * n
    work = [list(range(n))]
    while work:
        nodes = work.pop()
        top = nodes[0]
        if len(nodes) == 1:
            out[top] = [a + b for a, b in zip(out[top], weights[top])]
            continue
        for v in nodes:
            size[v] = 1
        for v in reversed(nodes[1:]):
            size[parent[v]] += size[v]
        half = len(nodes)
        centroid = next(v for v in reversed(nodes) if 2 * size[v] >= half)
        parts: dict[int, list[int]] = {}
        total = list(weights[centroid])
        label[top] = top
        for v in nodes:
            if v == centroid:
                continue
            if v != top:
                label[v] = v if parent[v] == centroid else label[parent[v]]
            parts.setdefault(label[v], []).append(v)
            if label[v] != top or top == centroid:
                total = [a + b for a, b in zip(total, weights[v])]
        v = centroid
        while True:
            out[v] = [a + b for a, b in zip(out[v], total)]
            if v == top:
                break
            v = parent[v]
        work.extend(parts.values())
    return out


_NODE = ["depth", "key", "prev", "conv_id", "parent", "n_convs", "n_children", "weight", "leaves", "tokens", "more_leaves", "more_tokens", "comp"]
_DONE = "conv_id long, depth long, key binary, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _split(live: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level: the centroids of live's components with their sums, and what is left in its new components."""
    total = live.groupBy("comp").agg(F.max("weight").alias("total")).withColumnRenamed("comp", "_c")  # a top's weight is the greatest
    half = live.join(F.broadcast(total), F.col("comp") == F.col("_c")).where(2 * F.col("weight") >= F.col("total"))
    best = half.groupBy("comp").agg(F.max_by(F.struct("depth", "key", "conv_id", "weight"), "depth").alias("z"))
    z = settle(best.select(F.col("comp").alias("zcomp"), F.col("z.depth").alias("zdepth"), F.col("z.key").alias("zkey"), F.col("z.conv_id").alias("zconv"), F.col("z.weight").alias("zweight")))
    here = live.join(F.broadcast(z), F.col("comp") == F.col("zcomp"))  # z has a row for each large component: COMPONENTS at most, or so
    look = here.where("depth > zdepth").select("comp", "zkey", "zdepth", "conv_id", segment(F.col("depth")).alias("seg")).distinct()
    row = rows.select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), F.col("key").alias("child"), F.col("prev").alias("_p"))
    below = look.join(row, (F.col("conv_id") == F.col("_c")) & (F.col("zdepth") + 1 == F.col("_d"))).where(F.col("_p") == F.col("zkey"))
    below = below.select(F.col("comp").alias("bcomp"), F.col("conv_id").alias("bconv"), F.col("seg").alias("bseg"), "child")
    above = rows.select("conv_id", "depth", F.col("key").alias("akey")).join(F.broadcast(z.select("zcomp", "zconv", "zdepth")), (F.col("conv_id") == F.col("zconv")) & (F.col("depth") < F.col("zdepth"))).select(F.col("zcomp").alias("acomp"), "akey")
    marked = here.join(below, (F.col("comp") == F.col("bcomp")) & (F.col("conv_id") == F.col("bconv")) & (segment(F.col("depth")) == F.col("bseg")) & (F.col("depth") > F.col("zdepth")), "left")
    marked = marked.join(above, (F.col("key") == F.col("akey")) & (F.col("comp") == F.col("acomp")), "left")
    marked = stored(marked.select(*_NODE, "zdepth", "zkey", "zconv", "zweight", "child", F.col("akey").isNotNull().alias("above"), (F.col("key") == F.col("zkey")).alias("center")), "level")
    sums = settle(
        marked.groupBy("comp").agg(
            F.sum(F.when(F.expr("center or child is not null"), F.col("leaves"))).alias("sum_leaves"),
            F.sum(F.when(F.expr("center or child is not null"), F.col("tokens"))).alias("sum_tokens"),
            F.max(F.when(F.expr("above and depth = zdepth - 1"), F.col("conv_id"))).alias("zparent"),
        ).withColumnRenamed("comp", "_c")
    )
    marked = marked.join(F.broadcast(sums), F.col("comp") == F.col("_c"))
    done = marked.where("center").select("conv_id", "depth", "key", F.coalesce("parent", "zparent").alias("parent"), "n_convs", "n_children", (F.col("more_leaves") + F.col("sum_leaves")).alias("n_leaves"), (F.col("more_tokens") + F.col("sum_tokens")).alias("saved_tokens"))
    if_above = lambda c: F.when(F.col("above"), F.col(c)).otherwise(0)
    left = marked.where("not center").withColumns(
        {
            "parent": F.when(F.col("child") == F.col("key"), F.col("zconv")).otherwise(F.col("parent")),
            "weight": F.col("weight") - if_above("zweight"),
            "more_leaves": F.col("more_leaves") + if_above("sum_leaves"),
            "more_tokens": F.col("more_tokens") + if_above("sum_tokens"),
            "comp": F.coalesce("child", "comp"),
        }
    )
    return done, left.select(*_NODE)


def _finished(small: DataFrame) -> DataFrame:
    """The sums of components that are small: each is read and decomposed by itself, components follow each other in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _DONE.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
        held: list[tuple] = []
        out: list[tuple] = []

        def finish() -> None:
            place = {r[1]: k for k, r in enumerate(held)}
            parent = [-1, *[place[r[2]] for r in held[1:]]]
            sums = centroids(parent, [(r[7], r[8]) for r in held])
            for k, (r, s) in enumerate(zip(held, sums, strict=True)):
                out.append((r[3], r[0], r[1], held[parent[k]][3] if k else r[4], r[5], r[6], r[9] + s[0], r[10] + s[1]))

        now = None
        for batch in batches:
            for *r, comp in zip(*(column(batch, c) for c in ("depth", "key", "prev", "conv_id", "parent", "n_convs", "n_children", "leaves", "tokens", "more_leaves", "more_tokens", "comp")), strict=True):
                if comp != now and held:
                    finish()
                    held.clear()
                now = comp
                held.append(tuple(r))
            if len(out) > 5000:
                yield _table(out, names, kinds)
                out.clear()
        if held:
            finish()
        yield _table(out, names, kinds)

    return small.repartition("comp").sortWithinPartitions("comp", "depth").mapInArrow(tidy(run), _DONE)


def _digests(rows: DataFrame) -> DataFrame:
    """key, ends_sha256 of the nodes at which conversations end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["key", "first", "ids"], [pa.binary(), pa.int64(), pa.string()]
        now, held, size = None, [], 0
        for batch in batches:
            out = []
            for key, c in zip(column(batch, "key"), column(batch, "conv_id"), strict=True):
                if held and (key != now or size > PIECE):
                    out.append((now, held[0], ",".join(map(str, held))))
                    held, size = [], 0
                now = key
                held.append(c)
                size += 20
            yield _table(out, names, kinds)
        if held:
            yield _table([(now, held[0], ",".join(map(str, held)))], names, kinds)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(column(batch, "key"), column(batch, "ids"), strict=True):
                if key != now:
                    if state:
                        out.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _table(out, ["key", "sha"], [pa.binary(), pa.string()])
        if state:
            yield _table([(now, state.hexdigest())], ["key", "sha"], [pa.binary(), pa.string()])

    ends = rows.where("depth = len").select("key", "conv_id")
    cuts = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(tidy(cut), "key binary, first long, ids string")
    return cuts.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(tidy(digest), "key binary, sha string")


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A row for each node: conv_id (the least member), depth, parent_conv_id (the parent's conv_id), n_convs, n_children, n_leaves (childless nodes in its subtree, itself
    included), saved_tokens (over its subtree, members but one times code points of the last text), ends_sha256 (of the ids of members that end there)."""
    rows = rebuilt(conversations)
    nodes = rows.groupBy("depth", "key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("prev").alias("prev"), F.max("size").alias("size"), F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    nodes = stored(nodes, "nodes")
    kids = nodes.where("depth > 0").groupBy(F.col("prev").alias("_k")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, F.col("key") == F.col("_k"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    zero = F.lit(0).cast("long")
    live = nodes.withColumns(
        {"parent": F.lit(None).cast("long"), "leaves": (F.col("n_children") == 0).cast("long"), "tokens": (F.col("n_convs") - 1) * F.col("size"), "more_leaves": zero, "more_tokens": zero, "comp": F.lit(ROOT)}
    ).select(*_NODE)
    live = stored(live, "nodes")
    n = live.count()
    limit = max(limit, n // COMPONENTS)
    large = n > limit
    small, finished = ([], []) if large else ([live], [])
    while large:
        done, left = _split(live, rows)
        left = stored(left, "left")
        finished.append(done)
        many = settle(left.groupBy("comp").agg(F.count("*").alias("nodes")).where(F.col("nodes") > limit).select(F.col("comp").alias("_c")))
        small.append(left.join(F.broadcast(many), F.col("comp") == F.col("_c"), "left_anti"))
        live = left.join(F.broadcast(many), F.col("comp") == F.col("_c")).select(*_NODE)
        large = not many.isEmpty()
    every = small[0]
    for more in small[1:]:
        every = every.unionAll(more)
    out = _finished(every)
    for more in finished:
        out = out.unionAll(more)
    out = out.join(_digests(rows).withColumnRenamed("key", "_k"), F.col("key") == F.col("_k"), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))


#: The same rows by DuckDB, which has no crc32: it is worked out bit by bit.
SQL = r"""
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
h AS MATERIALIZED (
  SELECT c, c - c % 100 AS donor, n, xor(list_reduce(list_prepend(4294967295, list_transform(split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
g AS MATERIALIZED (SELECT h.*, least(h.h, coalesce(d.n, 0)) AS g FROM h LEFT JOIN (SELECT c AS dc, n FROM h) d ON dc = donor),
b AS MATERIALIZED (
  SELECT g.c, r AS depth, role, text FROM g JOIN t ON t.c = donor AND r <= g
  UNION ALL SELECT g.c, g + r - h, role, text FROM g JOIN t ON t.c = g.c AND r > h),
p AS MATERIALIZED (
  SELECT c, depth, sha256(string_agg(len(role) || ':' || len(text) || ':' || role || text, '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth)) AS k, len(text) AS size FROM b
  UNION ALL SELECT c, 0, '', 0 FROM g),
l AS (SELECT c, max(depth) AS l FROM p GROUP BY c),
v AS MATERIALIZED (SELECT depth, k, min(c) AS c, count(*) AS n, any_value(size) AS size FROM p GROUP BY depth, k),
e AS MATERIALIZED (SELECT v.*, q.k AS pk, w.c AS pc FROM v LEFT JOIN p q ON q.c = v.c AND q.depth = v.depth - 1 LEFT JOIN v w ON w.k = q.k),
kids AS MATERIALIZED (SELECT pk, count(*) AS kids FROM e WHERE pk IS NOT NULL GROUP BY pk),
s AS (
  SELECT a.k, sum((kids IS NULL)::BIGINT) AS leaves, sum((e.n - 1) * e.size) AS saved
  FROM e LEFT JOIN kids ON kids.pk = e.k JOIN p a ON a.c = e.c AND a.depth <= e.depth GROUP BY a.k)
SELECT e.c AS conv_id, e.depth::BIGINT AS depth, pc AS parent_conv_id, e.n AS n_convs, coalesce(kids, 0) AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce((SELECT string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FROM p JOIN l USING (c) WHERE l = p.depth AND p.k = e.k), '')) AS ends_sha256
FROM e LEFT JOIN kids ON kids.pk = e.k JOIN s ON s.k = e.k
"""
