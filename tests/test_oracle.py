"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from skyframe.plans.registry import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    missing = sorted(set(NAMES) - set(E.oracle_sql()))
    assert missing == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:9] == ["district", "year_mon_day", "week", "max_t", "min_t", "weather", "wind", "aqi", "aqi_type"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = E.queries()[name](spark, sf_dir)
    problems, n = compare(df, con, E.oracle_sql()[name])
    assert problems == [], f"{name}: {problems}"
