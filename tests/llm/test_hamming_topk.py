import numpy as np
import pytest

from brindle.llm import hamming_topk as ht


def brute(rows, k=10, every=100):
    seen = {(i, tuple(bool(v is not None and v > 0) for v in (list(e) + [0] * 64)[:64])) for i, e in rows if i is not None and e is not None}
    out = []
    for q, c in seen:
        if q % every == 0:
            near = sorted({(sum(a != b for a, b in zip(c, d)), i) for i, d in seen if i != q})[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, e, 1) for i, e in rows], "vec_id long, embedding array<float>, code int")
    return sorted(map(tuple, ht.top_k(df, **kw).collect()))


@pytest.mark.parametrize("kw", [{}, {"block": 100, "queries": 2}, {"k": 3}])
def test_brute_force(spark, kw):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(10, 64))
    rows = [(k, [float(x) for x in base[k % 10] + rng.normal(size=64) * (k % 5) * 0.4]) for k in range(700)]
    rows += [(1000 + k, rows[3][1]) for k in range(300)] + [(300, rows[300][1])]
    rows += [(2000, None), (None, rows[0][1]), (2100, [1.0, float("nan"), None, -1.0]), (2200, [])]
    assert run(spark, rows, **kw) == brute(rows, kw.get("k", 10))


def test_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [1.0])]) == [(0, 1, 1, 0)]


def test_search_stops_before_all():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    index = ht.Index(codes, np.ones(len(codes), np.int64))
    query = codes[5] ^ np.uint64(0b1011)
    places, distances, radius = index.nearest(query, 1)
    assert distances.min() == 3 and radius <= 1 and index.verified < len(codes) // 20
    for one in rng.integers(0, 1 << 63, 20).astype(np.uint64):
        places, distances, _ = index.nearest(one, 10)
        want = np.sort(np.bitwise_count(codes ^ one))[:10]
        assert (np.sort(distances)[:10] == want).all()


@pytest.mark.parametrize("n", [1, 40, 500, 2000, 30_000])
def test_every_search_is_covered_and_most_are_not_scans(n):
    """The search ends only where nothing nearer can be missing; in tables of near copies it looks at a small part of the codes."""
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, max(1, n // 20)).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(63, 3, replace=False)) for _ in range(n)], np.uint64)
    codes = np.unique(base[np.arange(n) % len(base)] ^ flips)
    index = ht.Index(codes, rng.integers(1, 4, len(codes)))
    for q in codes[:: max(1, len(codes) // 30)]:
        places, distances, radius = index.nearest(q, 11)
        far = np.bitwise_count(codes ^ q).astype(np.int64)
        order = np.argsort(far, kind="stable")
        last = far[order[min(len(codes) - 1, int(np.searchsorted(index.counts[order].cumsum(), 11)))]]
        assert sorted(places.tolist()) == np.flatnonzero(far <= last).tolist() and (np.bitwise_count(codes[places] ^ q) == distances).all()
    assert not index.met.any()
    if n >= 2000:
        assert index.verified / index.asked < 0.5 * len(codes)


def test_whole_table(spark, sf_dir):
    import duckdb

    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    assert sorted(map(tuple, ht.top_k(df).collect())) == sorted(con.execute(ht.SQL).fetchall())
