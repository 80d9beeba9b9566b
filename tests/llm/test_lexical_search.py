import math
import re

import numpy as np
import pytest

from brindle.llm import lexical_search as ls
from brindle.llm.queries import op13_max_sketch_search, oracle_sql
from tests.compare import compared

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, k=10):
    bags = [(d, words(t)) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, length = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        scores = []
        for d, b in bags:
            m, score = 10 + 90 * len(b) * n // length, 0
            for t in set(words(text)):
                tf = b.count(t)
                df = sum(t in x for _, x in bags)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m)) if tf else 0
            scores.append((-score, d is not None, d or 0, d))
        out += [(item_id, r + 1, d, -s) for r, (s, _, _, d) in enumerate(x for x in sorted(scores)[:k] if x[0] < 0)]
    return sorted(out, key=repr)


def searched(spark, docs, items, **how):
    rows = ls.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **how).collect()
    assert len({(r.item_id, r["rank"]) for r in rows}) <= len(rows)
    return sorted((tuple(r) for r in rows), key=repr)


def made(seed, n, vocabulary=60, longest=80):
    rng = np.random.default_rng(seed)
    names = [f"w{k}" if k % 3 else f"Wé{k}" for k in range(vocabulary)]
    return [(int(k), " ".join(rng.choice(names, rng.integers(0, longest), p=None))) for k in range(n)]


@pytest.mark.parametrize("width", [1, 7, 2048])
def test_equals_brute_force(spark, width):
    """Whatever collides in a sketch, results are exact."""
    docs, items = made(1, 150), made(2, 12, 90, 9)
    assert searched(spark, docs, items, width=width) == by_hand(docs, items)


def test_batches_of_items(spark):
    docs, items = made(3, 60), made(4, 25, 80, 12)
    items.append((99, "w1 " * 200))
    assert searched(spark, docs, items, batch_bytes=150, batch_items=5) == by_hand(docs, items)


def test_defined_cases(spark):
    docs = [(5, "one two"), (3, "one two"), (None, "one two"), (3, "one two"), (7, None), (8, ""), (9, "... !!"), (10, "TWO_two-two"), (11, "ÉTÉ été")]
    items = [(1, "one"), (1, "one"), (1, "two ONE one"), (2, None), (3, ""), (4, "absent"), (None, "été"), (6, "?!")]
    got = searched(spark, docs, items)
    assert got == by_hand(docs, [x for x in items if x[1]])
    assert [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1 and r[3] == got[0][3]][:1] in ([None], [10], [3])


def test_ties_by_doc_id(spark):
    docs = [(k, "alpha beta") for k in range(40, 0, -1)] + [(100, "gamma")]
    got = searched(spark, docs, [(1, "alpha")])
    assert sorted((r[1], r[2]) for r in got) == [(k, k) for k in range(1, 11)]


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [], []) == []


def test_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 2, "x")], "doc_id long, text string, score long, item_id string")
    items = spark.createDataFrame([(1, "a", 4)], "item_id long, text string, doc_id long")
    assert len(ls.search(docs, items).collect()) == 1


def test_a_very_long_text(spark):
    docs = [(1, "needle " + "hay " * 700_000), (2, "needle hay")] + [(k, "straw") for k in range(3, 30)]
    got = searched(spark, docs, [(1, "needle")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [2, 1]


def test_few_documents_are_rescored():
    """The bounds rule out most: no more than a tenth of pairs is scored exactly where a sketch has room."""
    rng = np.random.default_rng(5)
    batch = ls.Batch([(k, " ".join(f"t{x}" for x in rng.integers(0, 400, 6))) for k in range(20)], 2048)
    best, taken, pairs = ls.Best(20, 10), 0, 0
    for _ in range(10):
        numbers = [np.unique(rng.integers(0, len(batch.number), 30)) for _ in range(500)]
        lens = list(map(len, numbers))
        made = ls.impacts(rng.integers(1000, 9000, sum(lens)), np.ones(sum(lens), np.int64), [40] * 500, lens, 5000, 200_000)
        taken += ls.rescore(best, batch, batch.lookups(), list(range(500)), numbers, made)
        pairs += 500 * 20
    assert taken < pairs / 10


def test_sql(spark, sf_dir, con):
    compared(spark, op13_max_sketch_search, oracle_sql()["op13_max_sketch_search"], sf_dir, con)
