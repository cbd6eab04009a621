"""The queries of the subpackage against their SQL, and that the others run, on the smallest tables."""

import pytest

from cairn.llm import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(q.SQL))
def test_matches_sql(check_sql, name):
    check_sql(q.QUERIES[name], q.SQL[name])


def test_rows_only_queries(spark):
    for name in q.QUERIES:
        if name not in q.SQL:
            df = q.QUERIES[name](spark, SF)
            assert df.columns and df.count() >= 0, name


def test_found_columns(spark):
    want = {"p2_found": ["rec_id_a", "rec_id_b"], "p3_found": ["tab", "item_id", "field"], "p4_found": ["rec_id", "field"], "p5_found": ["rec_id"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"]}
    for name, cols in want.items():
        assert q.QUERIES[name](spark, SF).columns == cols
