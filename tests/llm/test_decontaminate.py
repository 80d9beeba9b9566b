from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from brindle.llm import decontaminate as dc


def brute(docs, items):
    """All windows of all documents."""
    out = {}
    bag = lambda w, m: Counter(tuple(w[k : k + m]) for k in range(len(w) - m + 1))
    for doc_id, text in docs:
        w = (text or "").lower().split()
        for item_id, t in items:
            v = (t or "").lower().split()
            m = min(5, len(v))
            if not m or len(w) < m:
                continue
            b = bag(v, m)
            for s in range(max(1, len(w) - len(v) + 1)):
                a = bag(w[s : s + len(v)], m)
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= 0.8 - 1e-9:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), round(sim, 6))
    return out


def made(seed=0):
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(60)]
    say = lambda n: list(rng.choice(vocab, n))
    items = [(k, " ".join(say(int(rng.integers(5, 50))))) for k in range(30)] + [(30, "too few words here"), (31, None), (32, ""), (33, "la " * 20), (34, "Zebra"), (35, "two\nwords"), (36, "la lo " * 9), (None, " ".join(say(25)))]
    docs = []
    for k in range(120):
        w = say(int(rng.integers(1, 120)))
        item = items[k % 30][1].split()
        for _ in range(int(rng.integers(0, 3))):
            if len(item) > 12:
                at = int(rng.integers(0, len(item)))
                item[at : at + int(rng.integers(0, 2))] = say(int(rng.integers(0, 2)))
        at = int(rng.integers(0, len(w) + 1))
        docs.append((k, " ".join(w[:at] + item + w[at:])))
    docs += [(200, None), (201, ""), (202, "\n"), (203, items[3][1].upper()), (204, " ".join(items[4][1].split()[:-1])), (None, items[5][1]), (205, "la " * 300), (205, "la " * 300), (205, items[6][1]), (206, "a zebra and two Words, TOO few words here."), (207, "zebra"), (208, "too few  words HERE"), (209, "la lo " * 7 + "la la lo lo la lo")]
    return docs, items


def test_brute_force_and_sql(spark):
    docs, items = made()
    want = brute(docs, items)
    rows = [(*d, "x", 1) for d in docs]
    d = spark.createDataFrame(rows, "doc_id long, text string, item_id string, len int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in dc.leaks(d, b).collect()}
    assert len(want) > 30 and any(v < 1 for v in want.values())
    assert got == want
    sieved = dc.leaks_by_text(d, b, broadcast_rows=0)
    assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in sieved.orderBy("similarity").collect()} == want
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    assert {r[:2]: r[2] for r in con.execute(dc.SQL).fetchall()} == want


@pytest.mark.parametrize("which", ["docs", "items"])
def test_empty(spark, which):
    d = spark.createDataFrame([(1, "a b c d e f")] * (which != "docs"), "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")] * (which != "items"), "item_id long, text string")
    assert dc.leaks(d, b).count() == 0


def test_blocks_cover_the_radius(spark):
    rng = np.random.default_rng(3)
    from pyspark.sql import functions as F

    pairs = []
    for _ in range(200):
        a = int(rng.integers(-(1 << 63), 1 << 63))
        bits = rng.choice(64, dc.RADIUS, replace=False)
        b = (a ^ sum(1 << int(k) for k in bits)) & (1 << 64) - 1
        pairs.append((a, b - (1 << 64) if b >> 63 else b))
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = df.select(F.size(F.array_intersect(dc.blocks(F.col("a")), dc.blocks(F.col("b")))).alias("n"))
    assert shared.agg(F.min("n")).first()[0] >= 1


def test_plan_is_native(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = dc.leaks(d, d.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_one_length_of_short_items(spark):
    """Items below five words alone, in documents as short as they are."""
    d = spark.createDataFrame([(1, "x y z"), (2, "y z"), (3, "y"), (4, "z y z"), (5, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "y z")], "item_id long, text string")
    assert sorted(tuple(r) for r in dc.leaks(d, b).collect()) == [(1, 1, 1.0), (2, 1, 1.0), (4, 1, 1.0)]


def test_recall_and_candidates(spark, capsys):
    """Near copies of items at similarities 0.8 to 1: what the radius keeps of them, and how many pairs the blocks let through."""
    rng = np.random.default_rng(11)
    vocab = [f"w{k}" for k in range(4000)]
    items = [(k, list(rng.choice(vocab, int(rng.integers(20, 60))))) for k in range(200)]
    docs = []
    for k in range(1500):
        item = list(items[k % 200][1])
        for _ in range(int(rng.integers(0, 2 + len(item) // 40))):
            item[int(rng.integers(0, len(item)))] = "new"
        docs.append((k, " ".join([*rng.choice(vocab, 20), *item, *rng.choice(vocab, 20)])))
    items = [(k, " ".join(w)) for k, w in items]
    want = {}
    for k, text in docs:
        want |= brute([(k, text)], [items[k % 200]])
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.leaks(d, b).collect()}
    low = [p for p, v in want.items() if v < 0.87]
    recall = len(got & set(want)) / len(want), len(got & set(low)) / len(low)
    with capsys.disabled():
        print(f"recall {recall[0]:.4f} of {len(want)}, below 0.87 {recall[1]:.4f} of {len(low)}")
    assert got <= set(want) and min(recall) >= 0.99 and len(low) > 50
