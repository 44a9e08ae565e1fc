"""Registered queries: demand series and forecasting (A5, TS1-TS8, A11-A13,
D8, D13), each with a DuckDB oracle.  The Holt-Winters oracle is a recursive
CTE that applies the same recurrences in the same operation order."""

from __future__ import annotations

from rxlake.operators import kpis, series
from rxlake.plans.registry import register
from rxlake.schemas import FORECAST_HORIZON, HOLDOUT_MONTHS, SEASON_LENGTH
from rxlake.sources import adapters
from rxlake.sources.tables import Tables

M = SEASON_LENGTH
H = HOLDOUT_MONTHS


def _series_ctes(units_sql: str) -> dict[str, str]:
    return {
        "units_rows": units_sql,
        "monthly": """SELECT drug_code, region, CAST(date_trunc('month', month) AS DATE) AS month,
       CAST(sum(units) AS DOUBLE) AS units FROM units_rows GROUP BY 1, 2, 3""",
        "bounds": "SELECT drug_code, region, min(month) AS m0, max(month) AS m1 FROM monthly GROUP BY 1, 2",
        "cal": """SELECT drug_code, region, month,
       CAST(row_number() OVER (PARTITION BY drug_code, region ORDER BY month) AS INTEGER) AS t
  FROM (SELECT drug_code, region,
               CAST(unnest(generate_series(CAST(m0 AS TIMESTAMP), CAST(m1 AS TIMESTAMP), INTERVAL 1 MONTH))
                    AS DATE) AS month
          FROM bounds)""",
        "regular": """SELECT c.drug_code, c.region, c.month, c.t, m.units
  FROM cal c LEFT JOIN monthly m ON c.drug_code = m.drug_code AND c.region = m.region AND c.month = m.month""",
        "filled": """SELECT drug_code, region, month, t,
       CASE WHEN units IS NOT NULL THEN units ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END AS units,
       units IS NULL AS interpolated
  FROM (SELECT *,
          last_value(units IGNORE NULLS) OVER (PARTITION BY drug_code, region ORDER BY t
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
          last_value(CASE WHEN units IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY drug_code, region
              ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
          first_value(units IGNORE NULLS) OVER (PARTITION BY drug_code, region ORDER BY t
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
          first_value(CASE WHEN units IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY drug_code, region
              ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
        FROM regular)""",
    }


def _grid_list_sql() -> str:
    items = ", ".join(
        f"{{'alpha': CAST({a} AS DOUBLE), 'beta': CAST({b} AS DOUBLE), 'gamma': CAST({g} AS DOUBLE)}}"
        for a, b, g in series.GRID
    )
    return f"[{items}]"


def _hw_ctes() -> dict[str, str]:
    need = series.min_history()
    return {
        "sizes": "SELECT drug_code, region, count(*) AS n, max(month) AS last_month, list(units ORDER BY t) AS y "
                 f"FROM filled GROUP BY 1, 2 HAVING count(*) >= {need}",
        "fits": f"""SELECT drug_code, region, 'bt' AS fit, n - {H} AS len, last_month, n, y FROM sizes
  UNION ALL SELECT drug_code, region, 'fin' AS fit, n AS len, last_month, n, y FROM sizes""",
        "init": f"""SELECT drug_code, region, fit, len, last_month, n,
       l0, b0, list_transform(y[1:{M}], lambda v, i: v - (l0 + i * b0)) AS s0
  FROM (SELECT *, list_sum(y[1:{M}]) / {M} - b0 * CAST({(M + 1) / 2} AS DOUBLE) AS l0
          FROM (SELECT *, (list_sum(y[{M + 1}:{2 * M}]) - list_sum(y[1:{M}])) / {M * M} AS b0 FROM fits))""",
        "seeds": f"""SELECT drug_code, region, fit, len, last_month, n, l0, b0, s0, p.alpha, p.beta, p.gamma
  FROM (SELECT *, unnest({_grid_list_sql()}) AS p FROM init)""",
        "hw": f"""SELECT i.drug_code, i.region, i.fit, i.len, i.last_month, i.n, i.alpha, i.beta, i.gamma,
       0 AS t, i.l0 AS l, i.b0 AS b, i.s0 AS s, CAST(0.0 AS DOUBLE) AS sse
  FROM seeds i
UNION ALL
SELECT h.drug_code, h.region, h.fit, h.len, h.last_month, h.n, h.alpha, h.beta, h.gamma, h.t + 1,
       h.alpha * (f.units - h.s[1]) + (1 - h.alpha) * (h.l + h.b),
       h.beta * ((h.alpha * (f.units - h.s[1]) + (1 - h.alpha) * (h.l + h.b)) - h.l) + (1 - h.beta) * h.b,
       list_concat(h.s[2:{M}], [h.gamma * (f.units - h.l - h.b) + (1 - h.gamma) * h.s[1]]),
       h.sse + (f.units - (h.l + h.b + h.s[1])) * (f.units - (h.l + h.b + h.s[1]))
  FROM hw h JOIN filled f ON f.drug_code = h.drug_code AND f.region = h.region AND f.t = h.t + 1
 WHERE h.t < h.len""",
        "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY drug_code, region, fit
                                    ORDER BY sse, alpha, beta, gamma) AS rn
                 FROM hw WHERE t = len) WHERE rn = 1""",
        "bt_points": f"""SELECT b.drug_code, b.region, f.units AS y_true,
       b.l + b.h * b.b + b.s[((b.h - 1) % {M}) + 1] AS y_pred
  FROM (SELECT *, unnest(range(1, {H + 1})) AS h FROM best WHERE fit = 'bt') b
  JOIN filled f ON f.drug_code = b.drug_code AND f.region = b.region AND f.t = b.len + b.h""",
        "metrics": """SELECT drug_code, region,
       avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape,
       sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse
  FROM bt_points GROUP BY 1, 2""",
        "forecast": f"""SELECT b.drug_code, b.region,
       CAST(b.last_month + to_months(CAST(b.h AS INTEGER)) AS DATE) AS forecast_month,
       CAST(greatest(round_even(b.l + b.h * b.b + b.s[((b.h - 1) % {M}) + 1], 0), 0.0) AS BIGINT) AS forecast_units,
       round(m.mape, 2) AS backtest_mape, round(m.rmse, 2) AS backtest_rmse
  FROM (SELECT *, unnest(range(1, {FORECAST_HORIZON + 1})) AS h FROM best WHERE fit = 'fin') b
  JOIN metrics m ON m.drug_code = b.drug_code AND m.region = b.region""",
    }


def _with(ctes: dict[str, str], select: str, recursive: bool = False) -> str:
    body = ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


FORECAST_CTES = {**_series_ctes(adapters.SHIPMENT_UNITS_SQL), **_hw_ctes()}
SPARSE_CTES = _series_ctes(adapters.SPARSE_UNITS_SQL)


def _forecast_filled(spark, sf_dir):
    t = Tables(spark, sf_dir)
    monthly = series.monthly_units(adapters.shipment_units(t))
    return series.interpolate(series.regularize_months(monthly))


def _sparse_regular(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return series.regularize_months(series.monthly_units(adapters.sparse_units(t)))


@register("a5_monthly_units", _with(FORECAST_CTES, "SELECT * FROM monthly", recursive=True))
def a5_monthly_units(spark, sf_dir):
    return series.monthly_units(adapters.shipment_units(Tables(spark, sf_dir)))


@register("ts1_regularize_months", _with(SPARSE_CTES, "SELECT * FROM regular"))
def ts1_regularize_months(spark, sf_dir):
    return _sparse_regular(spark, sf_dir)


@register("ts2_interpolate", _with(SPARSE_CTES, "SELECT * FROM filled"))
def ts2_interpolate(spark, sf_dir):
    return series.interpolate(_sparse_regular(spark, sf_dir))


GATE_SQL = f"""SELECT drug_code, region, CAST(count(*) AS INTEGER) AS n_months,
       count(*) >= {series.min_history()} AS eligible,
       CASE WHEN count(*) >= {series.min_history()} THEN NULL
            ELSE 'fewer than {series.min_history()} months of history (' || CAST(count(*) AS VARCHAR) || ')' END AS reason
  FROM filled GROUP BY 1, 2"""


@register("ts3_history_gate", _with(SPARSE_CTES, GATE_SQL))
def ts3_history_gate(spark, sf_dir):
    filled = series.interpolate(_sparse_regular(spark, sf_dir))
    return series.history_gate(series.series_arrays(filled)).select(
        "drug_code", "region", "n_months", "eligible", "reason"
    )


HOLDOUT_SQL = f"""SELECT drug_code, region, month, t, units, interpolated,
       CASE WHEN row_number() OVER (PARTITION BY drug_code, region ORDER BY month DESC) <= {H}
            THEN 'holdout' ELSE 'train' END AS split
  FROM filled"""


@register("ts4_holdout_split", _with(FORECAST_CTES, HOLDOUT_SQL, recursive=True))
def ts4_holdout_split(spark, sf_dir):
    return series.holdout_split(_forecast_filled(spark, sf_dir))


@register(
    "ts8_series_arrays",
    _with(FORECAST_CTES, "SELECT drug_code, region, list(units ORDER BY month) AS y, min(month) AS first_month, "
                         "max(month) AS last_month, CAST(count(*) AS INTEGER) AS n_months FROM filled GROUP BY 1, 2",
          recursive=True),
)
def ts8_series_arrays(spark, sf_dir):
    return series.series_arrays(_forecast_filled(spark, sf_dir))


def _fits(spark, sf_dir):
    arrays = series.history_gate(series.series_arrays(_forecast_filled(spark, sf_dir))).filter("eligible")
    return series.fit_holt_winters(arrays)


@register(
    "ts5_holt_winters_fit",
    _with(FORECAST_CTES, "SELECT drug_code, region, CAST(n AS INTEGER) AS n_months, alpha, beta, gamma, sse "
                         "FROM best WHERE fit = 'fin'", recursive=True),
)
def ts5_holt_winters_fit(spark, sf_dir):
    return series.fitted_parameters(_fits(spark, sf_dir))


@register("ts6_backtest", _with(FORECAST_CTES, "SELECT drug_code, region, round(mape, 2) AS backtest_mape, "
                                              "round(rmse, 2) AS backtest_rmse FROM metrics", recursive=True))
def ts6_backtest(spark, sf_dir):
    from pyspark.sql import functions as F

    m = series.backtest(_fits(spark, sf_dir))
    return m.select("drug_code", "region", F.round("mape", 2).alias("backtest_mape"),
                    F.round("rmse", 2).alias("backtest_rmse"))


CONTINUOUS_SQL = """SELECT b.drug_code, b.region, CAST(b.n AS INTEGER) AS n_months, round(b.sse, 4) AS grid_sse,
       TRUE AS never_above, round(m.mape, 2) AS grid_mape
  FROM best b JOIN metrics m ON m.drug_code = b.drug_code AND m.region = b.region WHERE b.fit = 'fin'"""


def _estimates(spark, sf_dir):
    return series.estimate_holt_winters(_fits(spark, sf_dir))


@register("ts5_continuous_never_above_grid", _with(FORECAST_CTES, CONTINUOUS_SQL, recursive=True))
def ts5_continuous_never_above_grid(spark, sf_dir):
    """TS5 with estimated weights and initial states: per series the grid's
    error and backtest (as SQL finds them), and that neither fit is worse."""
    from pyspark.sql import functions as F

    mape, _ = series.backtest_metrics(fit="bt_grid")
    return _estimates(spark, sf_dir).select(
        "drug_code", "region", "n_months", F.round("fin_grid.sse", 4).alias("grid_sse"),
        ((F.col("fin.sse") <= F.col("fin_grid.sse")) & (F.col("bt.sse") <= F.col("bt_grid.sse"))).alias("never_above"),
        F.round(mape, 2).alias("grid_mape"),
    )


@register("ts5_continuous_fit")
def ts5_continuous_fit(spark, sf_dir):
    """Estimated weights, errors and backtests per series beside the grid's
    (no SQL: the estimate iterates; tested against plain Python)."""
    return series.continuous_report(_estimates(spark, sf_dir))


def _forecast(spark, sf_dir):
    return series.demand_forecast(_forecast_filled(spark, sf_dir))


@register("ts7_demand_forecast", _with(FORECAST_CTES, "SELECT * FROM forecast", recursive=True))
def ts7_demand_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir)


def _summary_sql() -> str:
    per = "(SELECT drug_code, region, first(backtest_mape) AS backtest_mape, first(backtest_rmse) AS backtest_rmse " \
          "FROM forecast GROUP BY 1, 2)"
    stats = [
        ("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "round(avg({c}), 6)"),
        ("std", "round(stddev_samp({c}), 6)"), ("min", "min({c})"),
        ("25%", "round(quantile_cont({c}, 0.25), 6)"), ("50%", "round(quantile_cont({c}, 0.5), 6)"),
        ("75%", "round(quantile_cont({c}, 0.75), 6)"), ("max", "max({c})"),
    ]
    parts = [
        f"SELECT '{s}' AS stat, {e.format(c='backtest_mape')} AS backtest_mape, "
        f"{e.format(c='backtest_rmse')} AS backtest_rmse FROM {per} p"
        for s, e in stats
    ]
    return "\nUNION ALL\n".join(parts)


@register("a13_backtest_summary", _with(FORECAST_CTES, _summary_sql(), recursive=True))
def a13_backtest_summary(spark, sf_dir):
    return series.backtest_summary(_forecast(spark, sf_dir))


@register(
    "d8_kpi_avg_mape",
    _with(FORECAST_CTES, "SELECT round(avg(m), 2) AS avg_mape_pct, count(m) AS series FROM "
                         "(SELECT drug_code, region, first(backtest_mape) AS m FROM forecast GROUP BY 1, 2)",
          recursive=True),
)
def d8_kpi_avg_mape(spark, sf_dir):
    return kpis.kpi_avg_mape(_forecast(spark, sf_dir))


@register(
    "d13_forecast_units_by_drug",
    _with(FORECAST_CTES, "SELECT drug_code, CAST(sum(forecast_units) AS BIGINT) AS forecast_units "
                         "FROM forecast GROUP BY 1", recursive=True),
)
def d13_forecast_units_by_drug(spark, sf_dir):
    return kpis.forecast_units_by_drug(_forecast(spark, sf_dir))
