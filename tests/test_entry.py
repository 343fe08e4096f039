"""Driver contract: entry() runs on sf0.001; every oracle has a query."""

import importlib.util
import os

from tests.conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry()
    df = mod.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_oracles_have_queries():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80
