import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brindle.llm import ngram_join as nj
from brindle.llm.components import components
from brindle.llm.prefix_tree import degrees, links


def roots(n, pairs):
    up = list(range(n))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def brute_sets(texts, n=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    return out


def brute(rows, n=4, num=85, den=100):
    sets = brute_sets([t for _, t in rows], n)
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    r = roots(len(rows), pairs)
    least = {}
    for (d, _), k in zip(rows, r):
        if d is not None:
            least[k] = min(least.get(k, d), d)
    return sorted(((d, len(s), least.get(k) if s else d) for (d, _), s, k in zip(rows, sets, r)), key=str)


def family(rng, size, words, edits):
    base = [f"v{rng.integers(0, 500)}" for _ in range(words)]
    for _ in range(size):
        w = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            w[int(rng.integers(0, len(w)))] = f"v{rng.integers(0, 500)}"
        yield " ".join(w)


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    texts = [t for k in range(12) for t in family(rng, int(rng.integers(1, 12)), int(rng.integers(5, 300)), 4)]
    texts += list(family(rng, 60, 220, 3))
    shared = " ".join(f"s{k}" for k in range(60))
    texts += [shared + " " + " ".join(f"v{rng.integers(0, 500)}" for _ in range(int(rng.integers(1, 90)))) for _ in range(60)]
    texts += ["", None, " \n", "a", "A", "a b c", "a b c d", "É x", "é x", "same same same same same"] + ["copy of all words here again"] * 30
    return [(k if k % 37 else None, t) for k, t in enumerate(texts)] + [(5, texts[5]), (5, "other words under the same number")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=14, unique_by=frozenset), st.sampled_from([(1, 2), (85, 100), (8, 10)]), st.booleans())
def test_tree_joins_what_is_linked(sets, t, some):
    num, den = t
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    real = [(a, b) for a in range(len(sets)) for b in range(a) if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    got = links(arrays, num, den)
    assert {tuple(sorted(p)) for p in got} <= {tuple(sorted(p)) for p in real}
    assert roots(len(sets), got) == roots(len(sets), real)
    if some:
        seek = list(range(0, len(sets), 2))
        part = links(arrays, num, den, labels=list(range(len(sets))), seek=seek)
        assert roots(len(sets), part) == roots(len(sets), [p for p in real if p[0] in seek or p[1] in seek])


@pytest.mark.parametrize("n, num, den, chunk, block", [(4, 85, 100, nj.CHUNK, nj.BLOCK), (4, 85, 100, 900, 2000), (5, 80, 100, 400, 500)])
def test_brute_force(spark, n, num, den, chunk, block):
    rows = corpus(n + chunk)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n int, hi string")
    got = nj.joined(docs, n, num, den, chunk, block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, n, num, den)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = nj.joined(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_sql():
    import duckdb
    import pandas as pd

    rows = corpus(3)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    sql = con.execute(nj.SQL).fetchall()
    assert sorted((r[:3] for r in sql), key=str) == brute(rows)
    sets = brute_sets([t for _, t in rows])
    assert sorted(((r[0], r[1], r[3]) for r in sql), key=str) == sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets, brute_degrees(sets, 85, 100))), key=str)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nj.joined(docs).count() == 0
    assert nj.joined(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()[0].component_id == 1


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(1100, pairs)
    assert got == {k: want[k] for p in pairs for k in p if p[0] != p[1] or any(k in q and q[0] != q[1] for q in pairs)}


def test_spare():
    assert [nj.spare(k, 85, 100) for k in (1, 6, 7, 20, 100)] == [0, 0, 1, 3, 15]


def brute_degrees(sets, num, den):
    return [sum(bool(x and y) and a != b and den * len(x & y) >= num * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=1, max_size=14, unique_by=frozenset), st.sampled_from([(1, 2), (85, 100), (1, 5)]))
def test_degrees_count_every_link(sets, t):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    assert degrees(arrays, *t, [1] * len(sets)) == brute_degrees(sets, *t)
    seek = list(range(0, len(sets), 2))
    linked = [[a != b and (a % 2 != b % 2) and t[1] * len(x & y) >= t[0] * len(x | y) for b, y in enumerate(sets)] for a, x in enumerate(sets)]
    assert degrees(arrays, *t, list(range(3, len(sets) + 3)), seek) == [sum(b + 3 for b, z in enumerate(row) if z) for row in linked]


@pytest.mark.parametrize("chunk, block", [(nj.CHUNK, nj.BLOCK), (900, 2000)])
def test_links_by_brute_force(spark, chunk, block):
    rows = corpus(7) + [(9000, None), (9001, "one two three four five six")] + [(9002, "copied row of six words here")] * 3
    got = nj.joined(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk, block=block, counted=True).collect()
    sets = brute_sets([t for _, t in rows])
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in got), key=str) == sorted(((d, len(s), c) for (d, _), s, c in zip(rows, sets, brute_degrees(sets, 85, 100))), key=str)


def fan(n, common, own, pool=10**6, seed=1):
    """Sets that share a path and differ behind it."""
    rng = np.random.default_rng(seed)
    return [np.unique(np.concatenate((np.arange(common), 100 + rng.choice(pool, own, replace=False)))).astype(np.uint64) for _ in range(n)]


@pytest.mark.parametrize("step", [0, 3000, 10**12])
@pytest.mark.parametrize("common,own,pool", [(6, 1, 10**6), (17, 3, 40), (12, 2, 9), (30, 6, 12), (0, 5, 8), (3, 4, 60)])
def test_wide_nodes(monkeypatch, step, common, own, pool):
    """Nodes of many children, by the index, and where walks are given up at once or never."""
    monkeypatch.setattr("brindle.llm.prefix_tree.STEP", step)
    arrays = fan(90, common, own, pool) + fan(40, common, own + 1, pool, 2)
    sets = [set(a.tolist()) for a in arrays]
    for t in ((85, 100), (80, 100), (1, 2)):
        assert degrees(arrays, *t, [1] * len(sets)) == brute_degrees(sets, *t)
        pairs = [(a, b) for a in range(len(sets)) for b in range(a) if t[1] * len(sets[a] & sets[b]) >= t[0] * len(sets[a] | sets[b])]
        assert roots(len(sets), links(arrays, *t)) == roots(len(sets), pairs)
        assert degrees(arrays, *t, [1] * len(sets), list(range(30))) == [sum(1 for a, b in pairs if k in (a, b) and (a < 30) != (b < 30)) for k in range(len(sets))]


@pytest.mark.parametrize("n,common,own", [(20_000, 6, 1), (15_000, 17, 3), (15_000, 19, 1)])
def test_many_sets_of_one_path(n, common, own):
    """In time that grows with the sets, not with their pairs, where they are not linked; where all are, the component stops the search."""
    base = np.arange(common, dtype=np.uint64)
    sets = [np.concatenate((base, np.arange(1000 + k * own, 1000 + (k + 1) * own, dtype=np.uint64))) for k in range(n)]
    began = time.perf_counter()
    assert len(links(sets, 85, 100)) == (n - 1 if (common, own) == (19, 1) else 0)
    if own != 1 or common == 6:
        assert degrees(sets, 85, 100, [1] * n) == [0] * n
    assert time.perf_counter() - began < 10
