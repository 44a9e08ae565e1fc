"""The daily job's written zones equal the lazily computed relations."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle import SMALL
from rxlake.plans.daily import run_daily
from rxlake.plans.staged import Staged
from rxlake.schemas import ADVERSE_EVENTS
from rxlake.session import get_spark
from rxlake.sinks.writers import write_file
from rxlake.sources import adapters
from rxlake.sources.feeds import read_feed, read_zone


def same_rows(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_zones_match_queries(spark, tmp_dir):
    s = Staged(spark, SMALL)
    run = run_daily(spark, s.feeds(), tmp_dir, series_rows=adapters.shipment_units(s.tables))
    q = E.queries()
    marts = {
        "marts.fct_adverse_events_monthly": "a3_fct_adverse_events_monthly",
        "marts.fct_adverse_events": "p5_fct_adverse_events",
        "marts.fct_drug_demand": "p18_fct_drug_demand",
        "marts.dim_drugs": "j3_dim_drugs",
    }
    for zone, query in marts.items():
        assert same_rows(read_zone(spark, run.paths[zone]), q[query](spark, SMALL)), zone
    curated = read_zone(spark, run.paths["curated.adverse_events"])
    assert same_rows(curated, q["j1_curated_adverse_events"](spark, SMALL).select(*curated.columns))
    # staging zones carry the ingest stamp and are partitioned by region
    staged = read_zone(spark, run.paths["staging.adverse_events"])
    assert "_ingested_at" in staged.columns
    assert any(d.startswith("region=") for d in os.listdir(run.paths["staging.adverse_events"]))
    report = read_zone(spark, run.paths["marts.quality_report"])
    assert report.count() == 8
    fc = spark.read.option("header", True).csv(run.paths["forecast"])
    assert fc.columns == ["drug_code", "region", "forecast_month", "forecast_units", "backtest_mape", "backtest_rmse"]
    feeds_only = run.audit.filter("feed NOT LIKE 'curated.%'")
    assert same_rows(feeds_only, q["a7_load_audit"](spark, SMALL))
    assert run.audit.filter("feed LIKE 'curated.%'").count() == 2


def test_daily_from_csv_drops(spark, tmp_dir):
    """Feeds written as CSV drops and read back under declared schemas give
    the same audit counts as the in-memory feeds."""
    from rxlake import schemas
    from rxlake.sinks.writers import write_file
    from rxlake.sources.feeds import read_raw_feeds

    s = Staged(spark, SMALL)
    declared = {"clinical_trials": schemas.CLINICAL_TRIALS, "adverse_events": schemas.ADVERSE_EVENTS,
                "drug_shipments": schemas.DRUG_SHIPMENTS, "drug_sales": schemas.DRUG_SALES}
    for name, df in s.feeds().items():
        write_file(df.select(*declared[name].fieldNames()), os.path.join(tmp_dir, "raw", name))
    feeds = read_raw_feeds(spark, os.path.join(tmp_dir, "raw"))
    run = run_daily(spark, feeds, os.path.join(tmp_dir, "out"))
    got = {r.feed: (r.rows_in, r.rows_out) for r in run.audit.collect() if not r.feed.startswith("curated.")}
    want = {r.feed: (r.rows_in, r.rows_out) for r in E.queries()["a7_load_audit"](spark, SMALL).collect()}
    assert got == want


def test_failing_mart_check_stops_scoring(spark, tmp_dir):
    s = Staged(spark, SMALL)
    feeds = s.feeds()
    label = F.when(F.col("severity_label") == "mild", "terrible").otherwise(F.col("severity_label"))
    feeds["adverse_events"] = feeds["adverse_events"].withColumn("severity_label", label)
    with pytest.raises(AssertionError, match="severity_label"):
        run_daily(spark, feeds, tmp_dir, series_rows=adapters.shipment_units(s.tables))
    assert os.path.isdir(os.path.join(tmp_dir, "marts", "quality_report"))
    assert not os.path.isdir(os.path.join(tmp_dir, "forecast"))


def test_daily_scores_cases_and_reports(spark, tmp_dir):
    """Cases with narratives: report on the held-out fifth, every case scored
    with all its columns, agreement, skipped series listed."""
    s = Staged(spark, SMALL)
    feeds = s.feeds()
    told = F.concat(F.lit('patient said "'), F.col("severity_label"), F.lit('",\nthen rested'))
    feeds["adverse_events"] = feeds["adverse_events"].withColumn("narrative", F.when(F.col("patient_age") > 2, told))
    rows = adapters.shipment_units(s.tables)
    run = run_daily(spark, feeds, tmp_dir, series_rows=rows, score_cases=True, horizon=2, min_months=10_000)
    report = {r["label"]: r for r in spark.read.parquet(run.paths["scored.report"]).collect()}
    assert report["accuracy"]["f1_score"] == 1.0
    cases = read_zone(spark, run.paths["curated.adverse_events"])
    assert report["accuracy"]["support"] < cases.count() / 4
    scored = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(run.paths["scored.narratives"])
    )
    assert set(scored.columns) == {*cases.columns, "predicted_severity"}
    assert scored.count() == cases.count()
    assert scored.filter("narrative is null and predicted_severity is not null").count() == 0
    assert spark.read.parquet(run.paths["scored.agreement"]).first()["agreement"] == 1.0
    skipped = spark.read.option("header", True).csv(run.paths["forecast.skipped"])
    assert skipped.count() == rows.select("drug_code", "region").distinct().count()
    assert spark.read.option("header", True).csv(run.paths["forecast"]).count() == 0


def test_csv_keeps_quotes_line_breaks_and_blanks(spark, tmp_dir):
    told = ['said "ok", then fell', "two\nlines", "two\r\nlines", "", " padded ", 'back\\slash "', '"', None]
    rows = [(f"c{k}", t) for k, t in enumerate(told)]
    df = spark.createDataFrame(rows, "case_id string, narrative string")
    feed = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in ADVERSE_EVENTS])
    path = write_file(feed, os.path.join(tmp_dir, "ae"))
    back = read_feed(spark, path, "adverse_events").select("case_id", "narrative").collect()
    assert sorted(map(tuple, back)) == [(k, t or None) for k, t in rows]  # an empty cell is null


def test_get_spark_keeps_a_live_sessions_settings(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        assert get_spark().conf.get(key) == "12345"
        assert get_spark(extra={key: "54321"}).conf.get(key) == "54321"
    finally:
        spark.conf.set(key, before)


def test_a_run_started_again_goes_on_behind_its_last_zone(spark, tmp_dir):
    feeds = Staged(spark, SMALL).feeds()
    touched = []

    class Feeds(dict):
        def items(self):
            return [(n, self.read(n)) for n in feeds]

        def read(self, name):
            touched.append(name)
            return feeds[name] if not self.gone else feeds[name].filter("1 / 0 = 1")

    raw = Feeds()
    raw.gone = False
    bad = F.when(F.col("severity_label") == "mild", "terrible").otherwise(F.col("severity_label"))
    good, feeds["adverse_events"] = feeds["adverse_events"], feeds["adverse_events"].withColumn("severity_label", bad)
    with pytest.raises(AssertionError):  # killed behind the marts
        run_daily(spark, raw, tmp_dir, run_id="monday")
    stamps = {f: os.stat(os.path.join(tmp_dir, "staging", f, "_SUCCESS")).st_mtime_ns for f in feeds}
    raw.gone = True  # the raw feeds cannot even be read any more
    with pytest.raises(AssertionError):
        run_daily(spark, raw, tmp_dir, run_id="monday")
    assert stamps == {f: os.stat(os.path.join(tmp_dir, "staging", f, "_SUCCESS")).st_mtime_ns for f in feeds}
    # another run, and a run without an id, start from the feeds
    raw.gone = False
    feeds["adverse_events"] = good
    run = run_daily(spark, raw, tmp_dir, run_id="tuesday")
    assert run.reused == []
    again = run_daily(spark, raw, tmp_dir, run_id="tuesday")
    assert len(again.reused) == 10 and same_rows(run.audit, again.audit)
    got = {r.feed: (r.rows_in, r.rows_out) for r in again.audit.collect() if not r.feed.startswith("curated.")}
    assert got == {r.feed: (r.rows_in, r.rows_out) for r in E.queries()["a7_load_audit"](spark, SMALL).collect()}


def test_a_run_killed_after_staging_reuses_it(spark, tmp_dir, monkeypatch):
    from rxlake.plans import daily

    feeds = Staged(spark, SMALL).feeds()
    monkeypatch.setattr(daily.curate, "curated_supply_demand", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_daily(spark, feeds, tmp_dir, run_id="r")
    monkeypatch.undo()
    run = run_daily(spark, feeds, tmp_dir, run_id="r")
    assert run.reused == [*(f"staging.{f}" for f in feeds), "curated.adverse_events"]
    assert same_rows(read_zone(spark, run.paths["marts.dim_drugs"]), E.queries()["j3_dim_drugs"](spark, SMALL))


def test_audit_is_right_when_tasks_run_again(tmp_dir):
    """Tasks fail once while the zones are written (local master with retries):
    the audit equals the plain counts."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path[:0] = [{os.getcwd()!r}]
from pyspark.sql import functions as F
from rxlake.session import get_spark
from rxlake.plans.daily import stage_feed
from rxlake.schemas import FEEDS
spark = get_spark(master='local[4,3]', shuffle_partitions=4)
spark.sparkContext.setLogLevel('OFF')
names = [f.name for f in FEEDS['drug_sales'].schema.fields]
def fails_once(it):
    from pyspark import TaskContext
    t = TaskContext.get()
    for n, b in enumerate(it):
        yield b
    if t.attemptNumber() == 0 and t.partitionId() % 2 == 0:
        raise RuntimeError('lost')
rows = spark.range(1000, numPartitions=4).select(
    F.lit('2024-01-01').cast('date').alias('sales_month'), F.when(F.col('id') % 10 > 0, F.concat(F.lit('D'), (F.col('id') % 50).cast('string'))).alias('drug_code'),
    F.lit('n').alias('drug_name'), F.lit('EMEA').alias('region'), F.lit(1).cast('bigint').alias('units_sold'), F.lit(1.0).alias('revenue_usd'))
raw = rows.mapInArrow(fails_once, rows.schema)
print('COUNTS', stage_feed(raw, 'drug_sales', {tmp_dir!r} + '/z'))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    line = next(x for x in out.stdout.splitlines() if x.startswith("COUNTS"))
    assert eval(line[7:]) == {"in": 1000, "required": 900, "out": 45}, out.stderr[-2000:]


def test_a_failing_load_leaves_the_old_table(spark, tmp_dir):
    from rxlake.sinks.writers import replace_table

    path = os.path.join(tmp_dir, "t")
    rows = spark.createDataFrame([(k, f"r{k % 3}") for k in range(30)], "id long, region string")
    first = replace_table(rows, "rx_swap", path=path)
    assert spark.table("rx_swap").count() == 30
    with pytest.raises(Exception):
        replace_table(rows.withColumn("id", F.expr("id / (id - 7)").cast("long")), "rx_swap", path=path)
    assert spark.table("rx_swap").count() == 30
    held = spark.table("rx_swap")  # a reader that began before the swap
    second = replace_table(rows.filter("id < 5"), "rx_swap", path=path, cluster_by="region")
    assert spark.table("rx_swap").count() == 5 and held.count() == 30 and first != second
    third = replace_table(rows.filter("id < 3"), "rx_swap", path=path)
    assert sorted(os.path.join(path, d) for d in os.listdir(path) if d.startswith("load-")) == sorted([second, third])
    replace_table(rows.withColumn("more", F.lit(1)), "rx_swap", path=path)  # other columns
    assert spark.table("rx_swap").columns == ["id", "region", "more"]
    spark.sql("DROP TABLE rx_swap")
