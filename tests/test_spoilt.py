"""The spoilt feeds make every cleaning step and check act."""

import __spark_entry__ as E
from oracle import SMALL


def rows(spark, name):
    return E.queries()[name](spark, SMALL).collect()


def test_every_check_fails_on_some_rows(spark):
    feeds = rows(spark, "q_spoilt_feed_report")
    assert all(r.failing_rows > 0 and not r.passed for r in feeds), [r for r in feeds if not r.failing_rows]
    assert {r.check for r in feeds} == {"not_null", "unique", "non_negative", "positive", "subset", "accepted_values", "range", "implies", "month_start"}
    mart = rows(spark, "q_spoilt_mart_report")
    assert all(r.failing_rows > 0 for r in mart if (r.table_name, r.check) != ("dim_drugs", "not_null")), mart


def test_cleaning_drops_missing_and_repeated_rows(spark):
    audit = rows(spark, "a7_spoilt_load_audit")
    assert len(audit) == 4 and all(r.dropped_missing > 0 and r.dropped_duplicate > 0 for r in audit)


def test_null_filter_gate_and_stems_act(spark):
    from rxlake.plans.q_dirty import UncleanedStaged

    s = UncleanedStaged(spark, SMALL)
    assert s.stg_events.count() < s.curated_events.count() and s.stg_supply_demand.count() < s.curated_supply_demand.count()
    gate = rows(spark, "ts3_short_series")
    assert {r.eligible for r in gate} == {True, False} and all((r.reason is None) == r.eligible for r in gate)
    told = rows(spark, "p14_told_risks")
    by_text = sum(r.severity_signal == "life-threatening" and "NON-" in (r.narrative or "") for r in told)
    assert by_text == sum("NON-" in (r.narrative or "") for r in told) > 100 and any(r.narrative is None for r in told)
