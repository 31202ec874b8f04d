"""Every registered query against its SQL, on all rows of the smallest tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_both_engines_agree_on_whole_pages(spark):
    """The parser knows nothing of the patterns, so it checks them independently."""
    native = queries()["paragraph_text"](spark, "/root/testdata/sf0.01").collect()
    parser = queries()["paragraph_text_parser"](spark, "/root/testdata/sf0.01").collect()
    assert dict(native) == dict(parser)


def test_parser_key_runs_on_columns_and_agrees_with_the_parser(spark):
    from pagemill.functions.html_parser import text_of_paragraphs
    from pagemill.registry import fixtures as fx

    sf_dir = "/root/testdata/sf0.01"
    found = queries()["paragraph_text_parser"](spark, sf_dir)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    pages = {r.page_id: text_of_paragraphs(r.html) for r in fx.page_table(spark, sf_dir).collect()}
    assert {r.page_id: r.page_text for r in found.collect()} == pages
