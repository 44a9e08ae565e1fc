"""spark-submit entry for the daily job.

    spark-submit --conf spark.checkpoint.dir=<shared> -m rxlake \\
        --raw <dir with clinical_trials/ adverse_events/ drug_shipments/ drug_sales/ CSV drops> \\
        --out <zone root> [--complete-through 2026-06-01] [--horizon 6] [--min-months 27] \\
        [--database <catalog database>] [--run-id 2026-06-01] [--skip-severity]

Options map one-to-one onto :func:`rxlake.plans.daily.run_daily` parameters.
"""

from __future__ import annotations

import argparse

from rxlake.plans.daily import run_daily
from rxlake.schemas import FORECAST_HORIZON
from rxlake.session import get_spark
from rxlake.sources.feeds import read_raw_feeds


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="rxlake")
    ap.add_argument("--raw", required=True, help="folder holding one sub-folder of CSV files per feed")
    ap.add_argument("--out", required=True, help="root for staging/curated/marts zones")
    ap.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE"])
    ap.add_argument("--complete-through", default=None, help="first sales month to exclude from forecasting")
    ap.add_argument("--horizon", type=int, default=FORECAST_HORIZON, help="months to forecast")
    ap.add_argument("--min-months", type=int, default=None, help="months a series needs to be forecast")
    ap.add_argument("--database", default=None, help="database that receives curated and mart tables")
    ap.add_argument("--skip-severity", action="store_true", help="leave out training and scoring of narratives")
    ap.add_argument("--run-id", default=None, help="name of this run: started again, it goes on behind its last committed zone")
    args = ap.parse_args(argv)
    spark = get_spark(app="rxlake-daily")
    feeds = read_raw_feeds(spark, args.raw, args.mode)
    sales = feeds["drug_sales"].select("drug_code", "region", "sales_month", "units_sold")
    series_rows = sales.withColumnRenamed("sales_month", "month").withColumnRenamed("units_sold", "units")
    run = run_daily(
        spark, feeds, args.out, series_rows=series_rows, complete_through=args.complete_through,
        score_cases=not args.skip_severity, horizon=args.horizon, min_months=args.min_months, database=args.database,
        run_id=args.run_id,
    )
    run.audit.show(truncate=False)


if __name__ == "__main__":
    main()
