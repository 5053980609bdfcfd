"""Driver contract: entry/queries/oracle_sql are consistent."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract_shapes(spark):
    e = _entry()
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 60
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in sql.values())
    df = e.entry(spark)
    cols = df.columns
    rows = df.collect()
    assert len(rows) == 8 and cols[:2] == ["label", "count"]
    assert e.entry(spark).columns == cols
