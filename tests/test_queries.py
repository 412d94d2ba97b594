import pytest
from oracle import connect, oracle_rows, rows_of

from curaspark.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_oracle(spark, sf, con, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    assert rows_of(df, columns) == oracle_rows(con, SQL[name], columns)


def test_entry_point_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:4] == ["LINEAGE_NAME", "GENUS_NAME", "SPECIES_NAME", "SEQ_LENGTH"]
    assert df.count() == 200


def test_entry_point_works_without_the_corpus_operators(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith(("curaspark.llm", "corpus_pipeline")) else real(name, *a))
    assert set(entry.queries()) == set(registry.queries())
    assert set(entry.oracle_sql()) == set(SQL)
