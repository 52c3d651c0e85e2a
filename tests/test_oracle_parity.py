"""Every registered query against its DuckDB statement, on the smallest tables."""

import pytest

from kpiloom.testing.compare import compare, type_problems
from kpiloom.workloads import load_all

from fixture_paths import SF_SMALL

REGISTRY = load_all()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    fn, sql = REGISTRY[name]
    df = fn(spark, SF_SMALL)
    rows = df.collect()
    if sql is None:
        assert rows is not None
        return
    rel = duck.sql(sql)
    problems = compare(df.columns, rows, rel.columns, rel.fetchall())
    problems += type_problems(df.dtypes, rel.columns, rel.types)
    assert not problems, problems


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["cj_id", "order_kpi", "event_kpi", "line_kpi", "total_incentive"]
    assert df.count() > 0
    from kpiloom.workloads import load_all
    assert set(load_all()) <= set(E.oracle_sql()) <= set(E.queries())          # every query of the reports has an oracle statement
    assert len(E.queries()) >= 95
