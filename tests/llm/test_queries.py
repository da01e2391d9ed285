import pytest

from corpusmill.llm.queries import oracle_sql, queries
from tests.oracle import same_rows


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, name):
    same_rows(spark, small, queries()[name], oracle_sql()[name])


FOUND = {
    "p1_found": ["table_name", "rec_id", "sec_idx"],
    "p2_found": ["word", "mark"],
    "p3_found": ["page_a", "sec_a", "page_b", "sec_b"],
    "p4_found": ["page_id", "sec_idx"],
    "p5_found": ["page_a", "sec_a", "page_b", "sec_b"],
    "p6_found": ["first_page_id", "page_id"],
    "p7_found": ["page_id", "sec_idx", "end_pos"],
    "p10_found": ["doc_id", "reading_band"],
}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_runs(spark, small, name):
    df = queries()[name](spark, small)
    assert df.columns == FOUND.get(name, df.columns)
    assert df.count() > 0
