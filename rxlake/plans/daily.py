"""The daily job — raw feeds -> staging -> curated -> marts -> scoring.

One Spark application.  Each zone write is a cut point: the next stage
reads the written zone back (S3), so lineage never spans the whole job and
executor loss only recomputes the current stage.  Row audits (A7, A8) are
results of queries, not counters filled by tasks, so a stage that is run again
cannot count twice: rows in by one aggregate over the feed's required columns,
rows out by counting the committed zone (its footers hold the counts).

A run has an id (the scheduler's, say) and a ledger below the output folder:
every step writes its entry behind its zone, so the same run started again
goes on behind the last committed step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.operators import curate, marts, quality, series, severity
from rxlake.operators.clean import _dedup_plan, dedup, drop_lineage, require
from rxlake.plans.q_board import MART_CHECKS
from rxlake.schemas import FEEDS, FORECAST_HORIZON
from rxlake.session import path_exists
from rxlake.sinks.writers import materialize, replace_table, write_file, write_zone
from rxlake.sources.feeds import read_zone

AUDIT_SCHEMA = (
    "feed string, rows_in bigint, rows_out bigint, dropped_missing bigint, dropped_duplicate bigint, dropped bigint"
)


@dataclass
class DailyRun:
    paths: dict[str, str] = field(default_factory=dict)
    audit: DataFrame | None = None
    reused: list[str] = field(default_factory=list)  # steps that an earlier start of the run had committed


class RunLedger:
    """Committed steps of one run: a folder per step with its path and counts.
    Without a run id nothing is kept and every step is done."""

    def __init__(self, spark: SparkSession, out_dir: str, run_id: str | None, run: DailyRun) -> None:
        self.spark, self.run = spark, run
        self.root = f"{out_dir}/_runs/{run_id}" if run_id else None

    def step(self, name: str, build: Callable[[], tuple[str, dict[str, int]]]) -> dict[str, int]:
        """The counts of step ``name``: as committed, or built now.  ``build``
        writes the zone and returns its path and counts."""
        entry = f"{self.root}/{name}" if self.root else None
        if entry and path_exists(self.spark, f"{entry}/_SUCCESS"):
            row = self.spark.read.parquet(entry).first()
            self.run.paths[name], counts = row["path"], dict(row["counts"])
            self.run.reused.append(name)
            return counts
        path, counts = build()
        self.run.paths[name] = path
        if entry:
            rows = self.spark.createDataFrame([(path, counts)], "path string, counts map<string, bigint>")
            rows.coalesce(1).write.mode("overwrite").parquet(entry)
        return counts


def committed_rows(spark: SparkSession, path: str) -> int:
    """Rows of a written zone, from its files."""
    return read_zone(spark, path).count()


def stage_feed(raw: DataFrame, feed: str, path: str) -> dict[str, int]:
    """Clean one feed into its staging zone; returns its row counts."""
    spec = FEEDS[feed]
    kept = require(raw, spec.required)
    keys, order = _dedup_plan(kept, spec)
    out = drop_lineage(dedup(kept, keys, order))
    write_zone(out.withColumn("_ingested_at", F.current_timestamp()), path)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.required], F.lit(True))
    got = raw.agg(F.count(F.lit(1)).alias("n"), F.count_if(whole).alias("whole")).first()
    return {"in": got["n"], "required": got["whole"], "out": committed_rows(raw.sparkSession, path)}


def run_daily(
    spark: SparkSession,
    raw_feeds: dict[str, DataFrame],
    out_dir: str,
    labelled: DataFrame | None = None,
    narratives: DataFrame | None = None,
    series_rows: DataFrame | None = None,
    model_path: str | None = None,
    complete_through: str | None = None,
    score_cases: bool = False,
    horizon: int = FORECAST_HORIZON,
    min_months: int | None = None,
    database: str | None = None,
    continuous: bool = True,
    run_id: str | None = None,
) -> DailyRun:
    """Run all stages into ``out_dir``.

    A failing mart check stops the run before the scoring stages (the report
    is written first).  ``score_cases`` trains on and scores the curated cases
    themselves where no ``labelled`` / ``narratives`` are given.  With
    ``database`` the curated zones and the marts also become its tables.
    The forecast estimates weights and initial states (``continuous``) from the
    parameter grid's winner on.  A run started again with its ``run_id`` uses
    the staging, curated and mart zones that it has committed.
    """
    run = DailyRun()
    out_dir = out_dir.rstrip("/")
    ledger = RunLedger(spark, out_dir, run_id, run)
    counts = {}
    # 1. raw -> staging (P1, A6, P13, K1) with audit
    for feed, raw in raw_feeds.items():
        path = f"{out_dir}/staging/{feed}"
        counts[feed] = ledger.step(f"staging.{feed}", lambda raw=raw, feed=feed, path=path: (path, stage_feed(raw, feed, path)))

    def staged(feed):
        cols = [c for c in FEEDS[feed].schema.fieldNames()]
        return read_zone(spark, run.paths[f"staging.{feed}"], cols)

    # 2. staging -> curated
    builders = {
        "adverse_events": lambda: curate.curated_adverse_events(staged("adverse_events"), staged("clinical_trials")),
        "supply_demand": lambda: curate.curated_supply_demand(staged("drug_shipments"), staged("drug_sales")),
    }
    curated_counts = {}
    for name, build in builders.items():
        def curated(name=name, build=build):
            path = write_zone(build(), f"{out_dir}/curated/{name}")
            return path, {"out": committed_rows(spark, path)}  # A8

        curated_counts[f"curated.{name}"] = ledger.step(f"curated.{name}", curated)["out"]

    if database:  # warehouse load (K2)
        for name in builders:
            zone = read_zone(spark, run.paths[f"curated.{name}"])
            ledger.step(f"table.curated_{name}", lambda zone=zone, name=name: (
                replace_table(zone, f"{database}.curated_{name}", path=f"{out_dir}/tables/curated_{name}", cluster_by="region"), {}))

    # 3. curated -> staging views -> marts (K3) + model tests (Q)
    stg_ae = marts.stg_adverse_events(read_zone(spark, run.paths["curated.adverse_events"]))
    stg_sd = marts.stg_supply_demand(read_zone(spark, run.paths["curated.supply_demand"]))
    materialize(stg_ae, "stg_adverse_events")
    materialize(stg_sd, "stg_supply_demand")
    mart_frames = {
        "dim_drugs": marts.dim_drugs(stg_ae, stg_sd),
        "fct_adverse_events": marts.fct_adverse_events(stg_ae),
        "fct_adverse_events_monthly": marts.fct_adverse_events_monthly(stg_ae),
        "fct_drug_demand": marts.fct_drug_demand(stg_sd),
    }
    for name, df in mart_frames.items():
        def mart(name=name, df=df):
            path = f"{out_dir}/marts/{name}"
            if database:
                return materialize(df, f"{database}.{name}", "table", path), {}
            return write_zone(df, path, partition_by=None), {}

        ledger.step(f"marts.{name}", mart)
    written = {n: read_zone(spark, run.paths[f"marts.{n}"]) for n in mart_frames}
    checks = quality.run_checks(
        {"dim_drugs": written["dim_drugs"], "fct_adverse_events": written["fct_adverse_events"],
         "adverse_events": read_zone(spark, run.paths["curated.adverse_events"])},
        MART_CHECKS,
    )
    run.paths["marts.quality_report"] = write_zone(checks, f"{out_dir}/marts/quality_report", partition_by=None)

    quality.assert_passed(read_zone(spark, run.paths["marts.quality_report"]))  # the gate: no scoring on bad marts

    # 4. severity: train with a held-out report (M5, M6, A10) unless saved, score all (M7, K5, K6), agreement
    if score_cases:
        cases = read_zone(spark, run.paths["curated.adverse_events"])
        labelled = cases if labelled is None else labelled
        narratives = cases if narratives is None else narratives
    if narratives is not None and labelled is not None:
        registry = severity.ModelRegistry(model_path or f"{out_dir}/models")
        known = labelled.select("case_id", "narrative", severity.LABEL)
        path = registry.path(known)
        model = registry.load(path)
        if model is None:
            model, report = severity.train_with_report(known)
            registry.save(path, model)
            run.paths["scored.report"] = write_zone(report, f"{out_dir}/scored/report", partition_by=None)
        scored = severity.score_severity(model, narratives)
        run.paths["scored.narratives"] = write_file(scored, f"{out_dir}/scored/narratives")
        if severity.LABEL in scored.columns:
            agreement = severity.label_agreement(scored)
            run.paths["scored.agreement"] = write_zone(agreement, f"{out_dir}/scored/agreement", partition_by=None)

    # 5. demand forecast (TS1-TS7, K5)
    if series_rows is not None:
        monthly = series.monthly_units(series_rows, complete_through=complete_through)
        filled = series.interpolate(series.regularize_months(monthly))
        fc = series.demand_forecast(filled, horizon=horizon, min_months=min_months, continuous=continuous)
        fc = fc.withColumn("forecast_month", F.date_format("forecast_month", "yyyy-MM-dd"))
        run.paths["forecast"] = write_file(fc, f"{out_dir}/forecast/demand_forecast")
        skipped = series.history_gate(series.series_arrays(filled), min_months).filter("not eligible")
        run.paths["forecast.skipped"] = write_file(
            skipped.select(*series.KEYS, "n_months", "reason"), f"{out_dir}/forecast/skipped_series"
        )

    rows = [
        (feed, c["in"], c["out"], c["in"] - c["required"], c["required"] - c["out"], c["in"] - c["out"]) for feed, c in counts.items()
    ] + [(name, n, n, 0, 0, 0) for name, n in curated_counts.items()]
    run.audit = spark.createDataFrame(rows, AUDIT_SCHEMA)
    return run
