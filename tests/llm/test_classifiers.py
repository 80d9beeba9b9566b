import zlib

import numpy as np
import pytest

from brindle.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache(), spark.read.parquet(f"{SF}/labels.parquet").cache()


@pytest.mark.parametrize("run, label, n, out, least", [(toxicity.toxicity, "toxic", 5, 0, 0.9), (quality.quality, "quality", 3, 1, 0.95)])
def test_held_out(tables, run, label, n, out, least):
    docs, labels = tables
    got = {r.doc_id: r for r in run(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % n == out) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    right = [got[r.doc_id].predicted == r[label] for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean(right) >= least


def test_held_out_labels_are_not_read(spark, tables):
    docs, labels = tables
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(labelled.fold(n=5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda m: m.scores(["so stupid", "The and attion"])
    assert score(toxicity.fit_on(docs, labels)) == score(toxicity.fit_on(docs, turned))


ROWS = [(1, None), (2, ""), (3, "one"), (None, "two words"), (3, "one"), (4, "x" * 50_000), (5, "la " * 30_000)]


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_odd_rows(spark, run):
    docs = spark.createDataFrame([(*r, 1.0) for r in ROWS], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(3, 0, 1), (5, 1, 0), (4, None, None), (None, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = run(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    none = labels.limit(0)
    assert {r.score for r in run(docs, none).collect()} == {0.0}
    assert run(docs.limit(0), labels).count() == 0


def test_misspellings_share_vectors():
    rng = np.random.default_rng(0)
    clean = ["river stone maple window garden cloud paper silver".split()[k] for k in range(8)]
    rows = []
    for k in range(400):
        words = list(rng.choice(clean, 30))
        if k % 2:
            words.insert(int(rng.integers(0, 30)), str(rng.choice(["horrible", "disgraceful"])))
        rows.append((" ".join(words), k % 2))
    m = toxicity.fit(rows)
    a, b, c = m.word_scores([b"horrible", b"horrrible", b"garden"])
    assert a > c and b > c
    assert m.scores(["garden river " * 2000 + "disgracefull"])[0] > 0.5 > m.scores(["garden river " * 2000])[0]


def test_caches_change_nothing():
    rows = [("abc def ghi " * 5, 0), ("XXX!! YYY!! ZZZ!! " * 5, 1)] * 20
    q = quality.fit(rows)
    texts = ["abc XXX!! new words here here", "more new things abc", "abc"]
    want = q.scores(texts)
    q.known, q.rows = {}, q.rows[:0]
    few = np.array([q.logits(q.pooled(t, keep=2)) for t in texts])
    assert np.allclose(want, labelled.sigmoid(q.scale * few + q.shift), atol=1e-5)
    t = toxicity.fit(rows)
    want = t.word_scores([b"abc", b"new"])
    t.known = {}
    assert (t.word_scores([b"abc", b"new"], keep=0) == want).all()


def test_long_runs_are_read_whole():
    from brindle.llm.toxicity import grams, words_of

    assert words_of("a b,c\u00a0d\u3000e\n" + "x" * 64) == [b"a", b"b,c", b"d", b"e", b"x" * 64]
    for run in ("字" * 300, "ab," * 100, "x" * 65, "x_" * 200, "," * 500, "".join(chr(0x4E00 + k) for k in range(1000))):
        got = [w.decode() for w in words_of(run)]
        assert all(len(w) <= 64 for w in got)
        assert all(any(run[k : k + 5] in w for w in got) for k in range(len(run) - 4)) or "," in run or "_" in run
        assert set("".join(got)) == set(run) and sum(map(len, got)) >= len(run)
    assert len(set(grams(["".join(map(str, range(100, 200))).encode()])[0].tolist())) > 300


def test_grams_of_words_at_once():
    """A word's n-grams are the same alone and among others; words share those of equal runs of characters; punctuation and case fall away."""
    words = [b"idiot", b"Idiots!", b"a", b"", b"...", "\u5b57\u5b57".encode(), b"\xff\xfe", b"idiot"]
    ids, of = toxicity.grams(words)
    alone = [sorted(toxicity.grams([w])[0].tolist()) for w in words]
    assert [sorted(ids[of == k].tolist()) for k in range(len(words))] == alone
    assert [len(x) for x in alone[:3]] == [5 + 4 + 3 + 1, 6 + 5 + 4 + 1, 1 + 1] and alone[0] == alone[7]
    assert len(set(alone[0]) & set(alone[1])) >= 9 and len(set(ids.tolist())) > 20
    assert [len(x) for x in toxicity.grams([])] == [0, 0]


def test_toxic_text_behind_a_long_run_counts():
    from brindle.llm import toxicity

    rng = np.random.default_rng(3)
    clean = lambda: " ".join(f"w{rng.integers(0, 60)}" for _ in range(20))
    model = toxicity.fit([(clean(), 0) for _ in range(80)] + [(clean() + " vilest scum " + clean(), 1) for _ in range(80)])
    for sep in ("\u00a0", "\u3000", ","):
        plain = sep.join(clean().split() * 2)
        a, b = model.scores([plain, plain + sep + sep.join(["vilest", "scum"])])
        assert a < 0.5 < b, (sep, a, b)


def quality_by_hand(m, text):
    """Every token's vectors averaged and put through the network, one by one."""
    words, rows = text.encode().split(), []
    for before, word in zip([None, *words], words):
        rows += [m.image[m._form(f)].astype(float) for f in quality.forms(word)]
        if before == word:
            rows.append(m.image[m.names[quality.AGAIN]].astype(float))
    x = sum(rows) / len(rows) if rows else np.zeros(m.image.shape[1])
    b1, w2, b2 = m.layers
    return labelled.sigmoid(m.scale * (sum(max(0.0, a) * b for a, b in zip(x + b1, w2)) + b2) + m.shift)


def toxicity_by_hand(m, text):
    """The means of all windows' words' n-grams, and of these the mean of the four greatest."""
    one = {w: np.mean([m.buckets[g] for g in toxicity.grams([w])[0]]) for w in set(toxicity.words_of(text))}
    values = [one[w] for w in toxicity.words_of(text)]
    n = toxicity.WINDOW
    if len(values) <= n:
        means = [sum(values) / max(1, len(values))]
    else:
        means = [sum(values[max(0, k) : max(0, k + n)]) / n for k in range(1 - n, len(values))]
    best = np.mean(sorted(means)[-toxicity.WORST :])
    return labelled.sigmoid(m.scale * (best + m.bias) + m.shift)


def test_toxicity_counts_words_in_any_length_and_no_lone_lookalike():
    """A word that clean documents hold once each decides nothing; several toxic words do, in a short text and in a long one."""
    rng = np.random.default_rng(5)
    some = lambda n: [f"w{rng.integers(0, 80)}" for _ in range(n)]

    def text(*extra):
        words = some(40)
        for e in extra:
            words.insert(int(rng.integers(0, len(words) + 1)), e)
        return " ".join(words)

    rows = [(text(*rng.choice(["vilest", "scum", "crook"], 4)), 1) if k % 2 else (text("scumbled") if k % 10 == 0 else text(), 0) for k in range(600)]
    m = toxicity.fit(rows)
    long = " ".join(some(20_000))
    assert max(m.scores([text("scumbled"), long, "w1 w2", text()])) < 0.5
    assert min(m.scores([text("vilest", "crook", "scum"), f"{long} vilest scum crook {long}", "scum", "vilest crook scum"])) > 0.5


@pytest.mark.parametrize("values, want", [([3.0], 3.0), ([1.0, 2.0, 3.0], 2.0), ([5.0, 1.0, 4.0, 2.0, 3.0, 3.0], 3.75), ([2.0] * 9, 2.0)])
def test_worst_windows(values, want):
    assert toxicity._worst(np.array(values)) == want


@pytest.mark.parametrize("of, by_hand", [(quality, quality_by_hand), (toxicity, toxicity_by_hand)])
def test_scores_against_brute_force(spark, sf_dir, of, by_hand):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = of.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = {r.doc_id: r._score for r in of.scored(docs, model).collect()}
    want = {r.doc_id: by_hand(model, r.text) for r in docs.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-4


def test_sample_leaves_giants_out_and_stays_full(spark):
    docs = spark.createDataFrame([(k, "x" * (70 if k % 10 == 0 else 5)) for k in range(100)] + [(1, "x"), (None, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)] + [(200, 1)], "doc_id long, toxic int")
    got = labelled.sample(docs, labels, "toxic", labelled.F.lit(True), 20, 1000)
    assert len(got) == 40 and {y for _, y in got} == {0, 1} and max(len(t) for t, _ in got) <= 5
    assert labelled.sample(docs, labels, "toxic", labelled.F.lit(True), 20, 1000) == got
    assert labelled.sample(docs.limit(0), labels, "toxic", labelled.F.lit(True), 20, 1000) == []


@pytest.mark.parametrize("kind", ["long", "int", "string", "decimal(20,0)"])
def test_sample_starts_no_other_workers(spark, monkeypatch, kind):
    """A list of rows made a table is an RDD of Python's: daemon and workers of its own on every executor, beside those of the scoring."""
    from pyspark import SparkContext

    docs = spark.range(40).selectExpr(f"cast(id as {kind}) as doc_id", "concat('text ', id) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")

    def refused(*_, **__):
        raise AssertionError("an RDD of Python's")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    got = labelled.sample(docs, labels, "toxic", labelled.F.lit(True), 5, 1000)
    assert len(got) == 10 and all(int(t.split()[1]) % 2 == y for t, y in got)
