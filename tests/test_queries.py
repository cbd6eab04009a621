"""Every query of the core against its SQL on the smallest tables."""

import pytest

from cairn.plans import catalog, core_queries, flows

PAIRS = [(n, q, m.SQL[n]) for m in (catalog, core_queries, flows) for n, q in m.QUERIES.items() if n in m.SQL]


@pytest.mark.parametrize("name,query,sql", PAIRS, ids=[p[0] for p in PAIRS])
def test_matches_sql(check_sql, name, query, sql):
    check_sql(query, sql)


def test_rows_only_queries_run(spark):
    for m in (catalog, core_queries, flows):
        for n, q in m.QUERIES.items():
            if n not in m.SQL:
                assert q(spark, "/root/testdata/sf0.001").count() > 0, n


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["record_id", "chunk_type", "part"]
    assert set(e.oracle_sql()) <= set(e.queries())
