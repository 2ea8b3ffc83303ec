"""Every query with SQL gives the same rows as DuckDB on the smallest data."""

import pytest

import __spark_entry__
from linkweave.plans import catalogue

from .conftest import DATA

SQL = catalogue.oracle_sql()
#: The smallest tables have no row for these.
MAY_BE_EMPTY = {"missed_matches", "missed_matches_full", "truth_restricted"}
ROWS_ONLY = {"metaphone_match", "build_features", "neg_sample", "gbt_oof", "feature_importance"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, agree):
    assert agree(catalogue.queries()[name], SQL[name]) > 0 or name in MAY_BE_EMPTY


def test_every_query_is_covered():
    assert set(catalogue.queries()) == set(SQL) | ROWS_ONLY


@pytest.mark.parametrize("name", ["metaphone_match", "build_features", "neg_sample"])
def test_rows_only(name, spark):
    assert catalogue.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["source1_entity_id", "candidate_entity_ids"]
    assert df.count() == df.select("source1_entity_id").distinct().count() > 0
    assert set(catalogue.queries()) <= set(__spark_entry__.queries())
