"""Every registered query with an oracle equals its DuckDB SQL (sf0.001);
queries without an oracle run and return rows."""

import pytest
from oracle import SMALL, compare

import __spark_entry__ as E

ORACLES = E.oracle_sql()
ALL = sorted(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck_small, name):
    ok, msg = compare(E.queries()[name](spark, SMALL), duck_small, ORACLES[name])
    assert ok, msg


@pytest.mark.parametrize("name", [n for n in ALL if n not in ORACLES])
def test_runs_without_oracle(spark, name):
    assert E.queries()[name](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["drug_code", "region", "report_month", "total_events", "serious_events",
                          "life_threatening_events", "pct_serious"]


def test_registry_names():
    """The names ``pipeline`` and ``opN_...`` belong to the training-data queries."""
    import re

    from rxlake.plans.catalog import QUERIES

    for name in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
        assert name != "pipeline" and not re.match(r"op\d+_", name), name
