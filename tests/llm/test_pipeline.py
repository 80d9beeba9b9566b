from collections import Counter

import duckdb
import pandas as pd
import pytest

import corpus_pipeline as cp
from brindle.llm import source_mix, toxicity
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_token_records import by_hand

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def one_of_each(rows):
    sized = groups([(k, r[1]) for k, r in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))], 5, 80, 100)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return sorted((order[k] for k, _, c in sized if k == c), key=str)


def mixed(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(*r, k) for k, r in enumerate(rows)], columns=[*COLUMNS, "at"]).astype({"doc_id": "Int64"}))
    taken = con.execute(source_mix.SQL).fetchall()
    copies = {r[0]: (r[4] // r[1] if r[1] else 0) for r in taken}
    return sorted((r for r in rows for _ in range(copies[r[0]])), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that the tables lack."""
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, text, "en", "a", 1), (3, text, "en", "a", 1), (4, text + " more", "en", "b", 2), (None, text, "en", "b", 3), (None, "alone here", None, None, 4), (5, " ".join(f"x{k}" for k in range(50)), "en", None, 5)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    every = rows_of(docs)
    model = toxicity.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    got = rows_of(cp.drop_toxic(spark, docs, sf_dir))
    assert got == [r for r in every if model.scores([r[1]])[0] < 0.5]
    assert rows_of(cp.drop_near_copies(spark, docs, sf_dir)) == one_of_each(every)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaks([r[:2] for r in every], items)}
    assert bad and rows_of(cp.drop_leaks(spark, docs, sf_dir)) == [r for r in every if r[0] not in bad]
    assert rows_of(cp.mix_sources(spark, docs, sf_dir)) == mixed(every)


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, cp.run(spark, sf_dir).collect()), key=lambda r: r[1])
    for _, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == COLUMNS
    assert got == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, sf_dir, odd):
    rows, docs = odd
    kept = rows_of(cp.drop_near_copies(spark, docs, sf_dir))
    assert Counter(kept) == Counter([rows[0], rows[1], rows[2], rows[6], rows[7]])
    assert rows_of(cp.drop_leaks(spark, docs, sf_dir)) == sorted(rows, key=str)
    assert len(rows_of(cp.drop_toxic(spark, docs, sf_dir))) == len(rows)
    assert {r[1] for r in rows_of(cp.mix_sources(spark, docs, sf_dir))} <= {r[1] for r in rows if r[1]}
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_clashing_columns(spark, sf_dir):
    """Columns of any name pass through every stage."""
    names = ["_score", "_text", "_bad", "_bad_of", "_gone", "_gone_of", "_of", "_copy", "_plan_source", "size", "target", "u", "root"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", *(f"doc_id as {c}" for c in names))
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns and all(r[0] == r["u"] == r["_bad"] for r in got.select("doc_id", *names).collect())
    assert cp.write_tokens(spark, docs, sf_dir).count() == docs.count()


def test_registered():
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is cp.run and "pipeline" not in __spark_entry__.oracle_sql()
