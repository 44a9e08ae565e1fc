"""Registered queries over feeds with faults (``sources/dirt.py``): here the
required-field and null filters drop rows, dedup keeps one of several, every
quality check fails on some rows, series are too short and narratives tell of
risks."""

from __future__ import annotations

from functools import cached_property

from rxlake.functions.triage import triage_signal_sql
from rxlake.operators import marts, quality, series
from rxlake.operators.clean import clean_sql, load_audit
from rxlake.plans import staged
from rxlake.plans.q_board import FEED_CHECKS, MART_CHECKS, audit_rows
from rxlake.plans.q_core import J3_SQL
from rxlake.plans.q_series import GATE_SQL, _series_ctes, _with
from rxlake.plans.registry import register
from rxlake.schemas import FEEDS
from rxlake.sources import adapters, dirt
from rxlake.sources.tables import Tables
from rxlake.streaming.triage_stream import with_signal


class SpoiltStaged(staged.Staged):
    """The daily flow over the spoilt feeds."""

    @cached_property
    def events_feed(self):
        return dirt.spoilt(adapters.adverse_events(self.tables), "adverse_events")

    @cached_property
    def trials_feed(self):
        return dirt.spoilt(adapters.clinical_trials(self.tables), "clinical_trials")

    @cached_property
    def shipments_feed(self):
        return dirt.spoilt(adapters.drug_shipments(self.tables), "drug_shipments")

    @cached_property
    def sales_feed(self):
        return dirt.spoilt(adapters.drug_sales(self.tables), "drug_sales")


class UncleanedStaged(SpoiltStaged):
    """The same without the cleaning step: what the later checks must find."""

    events = property(lambda self: self.events_feed)
    trials = property(lambda self: self.trials_feed)
    shipments = property(lambda self: self.shipments_feed)
    sales = property(lambda self: self.sales_feed)


FEED_CTES = {
    "ae_feed": ("adverse_events", adapters.ADVERSE_EVENTS_SQL, "stg_events_raw"),
    "trials_feed": ("clinical_trials", adapters.CLINICAL_TRIALS_SQL, "stg_trials"),
    "ship_feed": ("drug_shipments", adapters.DRUG_SHIPMENTS_SQL, "stg_shipments"),
    "sales_feed": ("drug_sales", adapters.DRUG_SALES_SQL, "stg_sales"),
}


def with_spoilt_ctes(select: str, cleaned: bool = True) -> str:
    ctes = dict(staged.CTES)
    for cte, (feed, source, stage) in FEED_CTES.items():
        ctes[cte] = dirt.spoilt_sql(source, feed)
        ctes[stage] = clean_sql(cte, feed, FEEDS[feed].schema.fieldNames()) if cleaned else f"SELECT * FROM {cte}"
    return f"WITH {', '.join(f'{k} AS ({v})' for k, v in ctes.items())}\n{select}"


@register("q_spoilt_feed_report", with_spoilt_ctes(quality.checks_sql(FEED_CHECKS, {
    "clinical_trials": "trials_feed", "adverse_events": "ae_feed", "drug_shipments": "ship_feed",
    "drug_sales": "sales_feed", "region_dim": "region"})))
def q_spoilt_feed_report(spark, sf_dir):
    s = SpoiltStaged(spark, sf_dir)
    return quality.run_checks({**s.feeds(), "region_dim": s.tables.region}, FEED_CHECKS)


@register("q_spoilt_mart_report", with_spoilt_ctes(quality.checks_sql(MART_CHECKS, {
    "dim_drugs": f"({J3_SQL})", "fct_adverse_events": "curated_ae", "adverse_events": "curated_ae"}), cleaned=False))
def q_spoilt_mart_report(spark, sf_dir):
    """The mart checks where nothing was cleaned (the facts are taken before
    the staging view's null filter, so a missing id can reach them)."""
    s = UncleanedStaged(spark, sf_dir)
    curated = s.curated_events
    tables = {
        "dim_drugs": marts.dim_drugs(s.stg_cases, s.stg_supply_demand),
        "fct_adverse_events": marts.fct_adverse_events(curated),
        "adverse_events": curated,
    }
    return quality.run_checks(tables, MART_CHECKS)


@register("a7_spoilt_load_audit", with_spoilt_ctes(audit_rows()))
def a7_spoilt_load_audit(spark, sf_dir):
    return load_audit(SpoiltStaged(spark, sf_dir).feeds())


def _cleaned(name: str, relation: str, cte: str) -> None:
    def query(spark, sf_dir):
        return getattr(SpoiltStaged(spark, sf_dir), relation)

    query.__doc__ = f"P1 and A6 on the spoilt {relation}: missing fields dropped, one row per business key."
    register(name, with_spoilt_ctes(f"SELECT * FROM {cte}"))(query)


_cleaned("p1_spoilt_cases", "events", "stg_events_raw")
_cleaned("p1_spoilt_trials", "trials", "stg_trials")
_cleaned("p1_spoilt_shipments", "shipments", "stg_shipments")
_cleaned("p1_spoilt_sales", "sales", "stg_sales")


@register("p3_spoilt_stg_adverse_events", with_spoilt_ctes("SELECT * FROM stg_ae", cleaned=False))
def p3_spoilt_stg_adverse_events(spark, sf_dir):
    return UncleanedStaged(spark, sf_dir).stg_events


@register("p3_spoilt_stg_supply_demand", with_spoilt_ctes("SELECT * FROM stg_sd", cleaned=False))
def p3_spoilt_stg_supply_demand(spark, sf_dir):
    return UncleanedStaged(spark, sf_dir).stg_supply_demand


@register("p18_spoilt_drug_demand", with_spoilt_ctes(
    "SELECT *, CASE WHEN units_sold = 0 THEN NULL ELSE round(100.0 * CAST(supply_demand_variance AS DOUBLE) / units_sold, 2) END "
    "AS variance_pct_of_sales FROM stg_sd"))
def p18_spoilt_drug_demand(spark, sf_dir):
    return marts.fct_drug_demand(SpoiltStaged(spark, sf_dir).stg_supply_demand)


@register("ts3_short_series", _with(_series_ctes(dirt.LAUNCHED_UNITS_SQL), GATE_SQL))
def ts3_short_series(spark, sf_dir):
    """Brands on sale for a few months only are skipped, with the reason."""
    monthly = series.monthly_units(dirt.launched_units(Tables(spark, sf_dir)))
    arrays = series.series_arrays(series.interpolate(series.regularize_months(monthly)))
    return series.history_gate(arrays).select("drug_code", "region", "n_months", "eligible", "reason")


@register("p14_told_risks", f"SELECT case_id, narrative, {triage_signal_sql()} AS severity_signal FROM ({dirt.TOLD_REPORTS_SQL}) r")
def p14_told_risks(spark, sf_dir):
    """The narrative branch of the rule: risk stems inside texts."""
    return with_signal(dirt.told_reports(Tables(spark, sf_dir))).select("case_id", "narrative", "severity_signal")
