import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brindle.llm import prefix_trie as pt
from brindle.llm.queries import op11_prefix_trie, oracle_sql
from tests.compare import compared

COLUMNS = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """rows (conv_id, turn, role, text), turns of a conversation distinct or alike."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    members = {}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        d = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(d, [])[:h] + mine[h:])
        for k in range(len(whole[c]) + 1):
            members.setdefault(whole[c][:k], []).append(c)
    out = []
    kids = {}
    for v in members:
        if v:
            kids.setdefault(v[:-1], []).append(v)
    sums = {}
    for v in sorted(members, key=len, reverse=True):
        leaves, saved = (0 if v in kids else 1), (len(members[v]) - 1) * (len(v[-1][1]) if v else 0)
        for k in kids.get(v, ()):
            leaves, saved = leaves + sums[k][0], saved + sums[k][1]
        sums[v] = leaves, saved
    for v, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(v))
        out.append((min(m), len(v), min(members[v[:-1]]) if v else None, len(m), len(kids.get(v, ())), *sums[v], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def built(spark, rows, **how):
    return sorted(tuple(r) for r in pt.trie(spark.createDataFrame(rows, COLUMNS), **how).collect())


def made(seed, convs, longest=9, texts=2, step=1):
    rng = np.random.default_rng(seed)
    return [(int(c) * step, t, "user" if t % 2 == 0 else "assistant", "x" * int(rng.integers(0, texts + 1))) for c in range(convs) for t in range(int(rng.integers(1, longest)))]


@pytest.mark.parametrize("limit", [1, 7, 512])
def test_equals_brute_force(spark, limit):
    rows = made(1, 260)
    assert built(spark, rows, limit=limit) == by_hand(rows)


@pytest.mark.parametrize("limit", [3, 40])
def test_deep_and_hot(spark, limit):
    """One long conversation, its copies and beginnings, and a beginning that a third of all share."""
    rows = [(0, t, "user", f"t{t % 7}") for t in range(150)]
    rows += [(c * 100, t, "user", f"t{t % 7}") for c in range(1, 12) for t in range(5 + 13 * (c % 4))]
    rows += [(5, t, "user", f"t{t % 7}") for t in range(150)]
    assert built(spark, rows, limit=limit) == by_hand(rows)


def test_a_conversation_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(pt, "SEGMENT", 16)
    rows = [(200, t, "user", f"t{t % 5}") for t in range(400)] + [(c, t, "user", f"t{t % 5}") for c in (201, 202, 300) for t in range(30)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert pt.turns(frame).where("conv_id = 200").selectExpr("max(r)", "count(distinct key)").first()[:] == (400, 400)
        assert sorted(tuple(r) for r in pt.trie(frame, limit=30).collect()) == by_hand(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_defined_cases(spark):
    rows = [
        (7, None, None, None), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, 2, None, "b"), (8, 3, "user", None), (None, 1, "user", "x"),
        (107, 1, "us", "erx"), (107, 2, "user", "x"), (-5, 1, "user", "é😀"), (-105, 1, "user", "q"), (0, 0, "user", "é😀"), (0, 1, "b", "c"), (1, 0, "user", ""), (2**62, 0, "", ""),
    ]
    assert built(spark, rows) == by_hand(rows)
    assert built(spark, rows, limit=2) == by_hand(rows)


def test_roles_and_texts_are_parted(spark):
    rows = [(0, 0, "ab", "c"), (100, 0, "a", "bc"), (200, 0, "", "abc"), (300, 0, "1:", "x"), (400, 0, "1", ":x")]
    assert built(spark, rows) == by_hand(rows)


def test_empty_table_and_extra_columns(spark):
    assert built(spark, []) == []
    frame = spark.createDataFrame([(1, 0, "user", "a", 3, b"k")], COLUMNS + ", depth long, key binary")
    assert len(pt.trie(frame).collect()) >= 1


def test_digest_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 100)
    rows = [(c, 0, "user", "same") for c in range(300)]
    assert built(spark, rows) == by_hand(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9)), max_size=30))
def test_centroid_sums(nodes):
    parent = [-1] + [p % (k + 1) for k, (p, _) in enumerate(nodes)]
    weights = [(1, 5)] + [(w, w * w) for _, w in nodes]
    want = [list(w) for w in weights]
    for v in range(len(parent) - 1, 0, -1):
        want[parent[v]] = [a + b for a, b in zip(want[parent[v]], want[v])]
    assert pt.centroids(parent, weights) == want


def test_deep_component_is_quick():
    n = 20_000
    assert pt.centroids([-1, *range(n - 1)], [(1,)] * n)[0] == [n]


def test_sql(spark, sf_dir, con):
    compared(spark, op11_prefix_trie, oracle_sql()["op11_prefix_trie"], sf_dir, con)
