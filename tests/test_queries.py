"""Every registered query: against SQL where there is SQL, else its rows."""

from dataclasses import replace

import pytest

import __spark_entry__ as entry
from hourloom.queries import models
from tests.compare import differences, open_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


@pytest.fixture(autouse=True)
def few_rounds(monkeypatch):
    """The rows of model queries do not depend on the rounds; ``python tests/compare.py`` runs them at their defaults."""
    monkeypatch.setattr(models, "_FORECAST", replace(models._FORECAST, rounds=2))
    monkeypatch.setattr(models, "_SEVERITY", replace(models._SEVERITY, trees=10))
    monkeypatch.setattr(models, "_SOFTMAX", replace(models._SOFTMAX, trees=2))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, tables, name):
    assert differences(entry.queries()[name](spark, SF_DIR), tables, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_the_feature_table(spark):
    df = entry.entry(spark)
    assert {"solar_lag_48h", "demand_roll7d_std", "wind_t24h_ahead", "mismatch_label"} <= set(df.columns)
    assert df.count() > 0
