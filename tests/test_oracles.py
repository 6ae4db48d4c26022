"""Every batch query equals its independent DuckDB oracle at sf0.01."""

import pytest

from conftest import SF_CHECK
from editstream.plans.catalog import BATCH_QUERIES
from editstream.plans.check import compare, diff_rows
from editstream.plans.oracles import ORACLES


def test_every_batch_query_has_an_oracle():
    assert set(BATCH_QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = BATCH_QUERIES[name](spark, SF_CHECK).toPandas()
    want = duck.execute(ORACLES[name]).df()
    res = compare(got, want)
    assert res["ok"], f"{name}: {res}\n{diff_rows(got, want) if res['cols_match'] else ''}"


def test_entry_contract(spark):
    import importlib.util
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("entry", os.path.join(root, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["wiki", "wiki_name", "edit_count", "avg_delta"]
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert "progress_report" in qs and "progress_report" in oracles
