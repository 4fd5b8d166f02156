"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests import oracle
from tidemill.registered import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, db, sf, name):
    df = queries()[name](spark, sf)
    sql = oracle_sql()[name]
    problems = oracle.differences(oracle.spark_rows(df), oracle.sql_rows(db, sql))
    assert problems + oracle.type_differences(df, db, sql) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_sample_scorer_stays_in_spark(spark, sf):
    plan = queries()["post_sentiment_from_external_scorer"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "vowel_share" not in plan


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
