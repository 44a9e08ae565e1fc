"""Registered queries: CSV feed round trip (S1, S2, K5), zone round trip
(K1, S3) and the daily job (X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rxlake import schemas
from rxlake.operators import marts
from rxlake.plans.daily import run_daily
from rxlake.plans.q_board import audit_sql
from rxlake.plans.q_core import J3_SQL
from rxlake.plans.registry import register
from rxlake.plans.staged import DIM_DRUGS_READS, Staged, with_ctes
from rxlake.session import scratch_path
from rxlake.sinks.writers import materialize, replace_table, write_file, write_zone
from rxlake.sources import adapters
from rxlake.sources.feeds import CORRUPT_COL, quarantine_feed, read_feed, read_table, read_zone
from rxlake.sources.tables import Tables

TRIAL_COLS = schemas.CLINICAL_TRIALS.fieldNames()
TRIALS_SQL = f"SELECT {', '.join(TRIAL_COLS)} FROM ({adapters.CLINICAL_TRIALS_SQL}) f"


def _trials_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "raw-clinical-trials")
    feed = adapters.clinical_trials(Tables(spark, sf_dir)).select(*TRIAL_COLS)
    write_file(feed, path, "csv")
    return path


@register("s1_read_feed_csv", TRIALS_SQL)
def s1_read_feed_csv(spark, sf_dir):
    """Write the trials feed as headered CSV (K5), read it back under the
    declared schema with header checking and FAILFAST (S1)."""
    return read_feed(spark, _trials_csv(spark, sf_dir), "clinical_trials")


@register("s2_quarantine_feed", TRIALS_SQL)
def s2_quarantine_feed(spark, sf_dir):
    """Same drop read through the quarantine path: the good rows (nothing
    in this feed is malformed, so all rows pass)."""
    good, _bad = quarantine_feed(spark, _trials_csv(spark, sf_dir), "clinical_trials")
    return good


BAD_PHASE = "Phase I"


@register(
    "s2_quarantine_bad_rows",
    f"SELECT trial_id, drug_code, TRUE AS has_line, TRUE AS has_file FROM ({TRIALS_SQL}) f WHERE phase = '{BAD_PHASE}'",
)
def s2_quarantine_bad_rows(spark, sf_dir):
    """The trials drop with unreadable dates in one phase: the rows set aside,
    with their raw line and file."""
    path = scratch_path(spark, "raw-bad-trials")
    feed = adapters.clinical_trials(Tables(spark, sf_dir)).select(*TRIAL_COLS)
    spoilt = F.when(F.col("phase") == BAD_PHASE, F.lit("unknown")).otherwise(F.col("start_date").cast("string"))
    write_file(feed.withColumn("start_date", spoilt), path, "csv")
    _good, bad = quarantine_feed(spark, path, "clinical_trials")
    has_line = F.col(CORRUPT_COL).contains(",unknown,") & F.startswith(F.col(CORRUPT_COL), F.col("trial_id"))
    return bad.select("trial_id", "drug_code", has_line.alias("has_line"), F.endswith("source_key", F.lit(".csv")).alias("has_file"))


TEXT_COLS = ["case_id", "drug_code", "report_date", "narrative"]


@register(
    "s1_read_feed_text",
    """SELECT 'D' || doc_id AS case_id, source AS drug_code, DATE '2001-01-01' + CAST(doc_id % 365 AS INTEGER) AS report_date,
              'said "ok", then: ' || text || chr(10) || ' "end" ' AS narrative FROM documents""",
)
def s1_read_feed_text(spark, sf_dir):
    """An adverse-event drop whose narratives hold quotes, commas and line
    breaks, written as CSV (K5) and read back (S1)."""
    path = scratch_path(spark, "raw-adverse-events")
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    told = F.concat(F.lit('said "ok", then: '), F.col("text"), F.lit('\n "end" '))
    docs = Tables(spark, sf_dir).documents.select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("case_id"), F.col("source").alias("drug_code"),
        day.alias("report_date"), told.alias("narrative"),
    )
    feed = docs.select(*[
        F.col(f.name) if f.name in TEXT_COLS else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ADVERSE_EVENTS
    ])
    write_file(feed, path, "csv")
    return read_feed(spark, path, "adverse_events").select(*TEXT_COLS)


@register("k3_mart_table", with_ctes(J3_SQL))
def k3_mart_table(spark, sf_dir):
    """The drug dimension replaced as a catalog table (K2, K3), read by name."""
    s = Staged(spark, sf_dir, columns=DIM_DRUGS_READS)
    mart = marts.dim_drugs(s.stg_events, s.stg_supply_demand)
    materialize(mart, "rxlake_dim_drugs", "table", scratch_path(spark, "dim-drugs"))
    return read_table(spark, "rxlake_dim_drugs")


@register("k2_replaced_table", with_ctes("SELECT * FROM curated_sd"))
def k2_replaced_table(spark, sf_dir):
    """Supply and demand loaded over a table of other rows (K2): written aside,
    sorted by region, then swapped in."""
    df, path = Staged(spark, sf_dir).curated_supply_demand, scratch_path(spark, "supply-demand")
    replace_table(df.limit(0), "rxlake_supply_demand", path=path)
    replace_table(df, "rxlake_supply_demand", path=path, cluster_by="region")
    return read_table(spark, "rxlake_supply_demand")


@register("s3_zone_round_trip", with_ctes("SELECT * FROM curated_ae"))
def s3_zone_round_trip(spark, sf_dir):
    """Curated cases written as a region-partitioned zone (K1) and read back
    with partition discovery (S3), columns restored by name."""
    df = Staged(spark, sf_dir).curated_events
    path = write_zone(df, scratch_path(spark, "curated-adverse-events"))
    return read_zone(spark, path, df.columns)


DAILY_AUDIT_SQL = audit_sql().replace(
    "\nUNION ALL\nSELECT 'drug_sales'",
    "\nUNION ALL\nSELECT 'curated.adverse_events', n, n, 0, 0, 0 FROM (SELECT count(*) AS n FROM curated_ae)"
    "\nUNION ALL\nSELECT 'curated.supply_demand', n, n, 0, 0, 0 FROM (SELECT count(*) AS n FROM curated_sd)"
    "\nUNION ALL\nSELECT 'drug_sales'",
)


@register("x1_daily_audit", DAILY_AUDIT_SQL)
def x1_daily_audit(spark, sf_dir):
    """Run the whole daily job into a fresh shared folder; return its audit
    (rows in / out per feed and curated row counts, counted in the committed
    zones)."""
    s = Staged(spark, sf_dir)
    t = s.tables
    run = run_daily(
        spark,
        s.feeds(),
        scratch_path(spark, "daily"),
        labelled=adapters.labelled_narratives(t),
        narratives=adapters.narratives(t),
        series_rows=adapters.shipment_units(t),
    )
    return run.audit
