import ast
import pathlib

import __spark_entry__ as entry

ROOT = pathlib.Path(entry.__file__).parent


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["n_name", "revenue"] and out.count() >= 1


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(f) for f in entry.queries().values())


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "brindle").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any(n.startswith("brindle.llm") for n in names), path


def test_no_query_joins_all_pairs_by_accident(spark, sf_dir):
    """Nested loops and cartesian products only where the query is about them."""
    meant = {"j4_theta", "j5_cartesian", "f5_vectors", "p5_recursive", "j9_not_in", "j9_not_in_null"}
    from brindle.plans import registry

    for name in ("regional_revenue", "j1_broadcast", "j2_sort_merge", "j6_full_outer", "j7_left_right_outer", "j8_semi", "j8_anti", "j10_scalar_subquery", "j10_exists", "j12_interval", "j13_range", "j14_asof", "j15_salted"):
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert name in meant or not ("NestedLoop" in plan or "CartesianProduct" in plan), name
