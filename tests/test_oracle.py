"""Every query with an SQL form gives the SQL's rows, names and types."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from tiltwatch.plans.catalog import LOOSE_FILES, all_queries
from tiltwatch.plans.oracle import all_sql

FOLDER = "/root/testdata/sf0.01"
# The training-data queries have tests of their own.
QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_sql_covers_all_but_model_queries():
    assert set(QUERIES) - set(SQL) == {
        "sentence_vectors",
        "classified_documents",
        "classifier_quality",
        "classifier_label_quality",
    }
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, connection, name):
    compare(QUERIES[name](spark, FOLDER), connection, SQL[name])


def test_compaction_query_merges_files(spark):
    assert len(QUERIES["compacted_match_share"](spark, FOLDER).inputFiles()) < LOOSE_FILES / 8


def test_entry(spark):
    assert entry.entry(spark).count() == 6
