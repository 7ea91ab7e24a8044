import __spark_entry__ as E
from quarry.plans import registry as _registry


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score", "rank"]
    assert df.count() > 0


def test_registry_and_oracles():
    qs, osql = E.queries(), E.oracle_sql()
    assert set(osql) <= set(qs)
    assert len(qs) >= 50
    # every query of the search engine has an exact SQL twin
    assert set(_registry.QUERIES) <= set(osql)
