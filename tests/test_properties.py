"""Randomised checks against brute-force Python on small fixtures."""

import numpy as np
import pytest
import datetime as dt
import math
import random

from pyspark.sql import functions as F

from rxlake.operators import clean, series, severity

D = dt.date


def test_dedup_matches_bruteforce(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice("abcde"), D(2024, 1, rng.randint(1, 5)), rng.choice(["x", "y", None]), rng.randint(0, 3),
         rng.random())
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, d date, s string, n int, v double")
    order = [("d", False), ("n", True)]
    got = {r.k: tuple(r) for r in clean.dedup(df, ["k"], order).collect()}

    def sort_key(r):  # report order: d desc, n asc, then remaining columns asc, nulls first
        return (-r[1].toordinal(), r[3], r[2] is not None, r[2] or "", r[4])

    want = {}
    for r in sorted(rows, key=sort_key):
        want.setdefault(r[0], r)
    assert got == want


def _hw_python(y, a, b, g, m=12):
    b0 = (sum(y[m:2 * m]) - sum(y[:m])) / (m * m)
    l0 = sum(y[:m]) / m - b0 * (m + 1) / 2
    s = [y[i] - (l0 + (i + 1) * b0) for i in range(m)]
    lv, bv, sse = l0, b0, 0.0
    for v in y:
        head = s[0]
        err = v - (lv + bv + head)
        sse += err * err
        level = a * (v - head) + (1 - a) * (lv + bv)
        trend = b * (level - lv) + (1 - b) * bv
        season = g * (v - lv - bv) + (1 - g) * head
        s = s[1:] + [season]
        lv, bv = level, trend
    return sse, [lv + h * bv + s[(h - 1) % m] for h in (1, 2, 3)]


def test_holt_winters_fold_matches_python_recurrence(spark):
    rng = random.Random(11)
    cases = []
    for i in range(6):
        n = rng.randint(27, 60)
        y = [100 + 3 * t + 20 * math.sin(2 * math.pi * t / 12) + rng.gauss(0, 5) for t in range(n)]
        cases.append((i, y, rng.choice(series.ALPHAS), rng.choice(series.BETAS), rng.choice(series.GAMMAS)))
    df = spark.createDataFrame(cases, "id int, y array<double>, a double, b double, g double")
    st = series.hw_fold(F.col("y"), F.col("a"), F.col("b"), F.col("g")).alias("st")
    rows = df.select("id", st).select(
        "id", "st.sse", *[series.forecast_value(F.col("st"), F.lit(h)).alias(f"f{h}") for h in (1, 2, 3)]
    ).collect()
    for r in rows:
        _, y, a, b, g = cases[r.id]
        sse, fc = _hw_python(y, a, b, g)
        assert math.isclose(r.sse, sse, rel_tol=1e-12)
        for got, want in zip((r.f1, r.f2, r.f3), fc):
            assert math.isclose(got, want, rel_tol=1e-12, abs_tol=1e-9)


def test_grid_winner_is_the_least_sse(spark):
    rng = random.Random(3)
    y = [50 + t + 10 * math.cos(2 * math.pi * t / 12) + rng.gauss(0, 3) for t in range(40)]
    months = [D(2020 + t // 12, t % 12 + 1, 1) for t in range(40)]
    df = spark.createDataFrame([("A", "R", m, v) for m, v in zip(months, y)],
                               "drug_code string, region string, month date, units double")
    filled = series.interpolate(series.regularize_months(series.monthly_units(df)))
    fit = series.fitted_parameters(series.fit_holt_winters(series.series_arrays(filled))).collect()[0]
    best = min((_hw_python(y, a, b, g)[0], a, b, g) for a, b, g in series.GRID)
    assert (fit.alpha, fit.beta, fit.gamma) == best[1:]
    assert math.isclose(fit.sse, best[0], rel_tol=1e-12)


def test_stratified_split_exact_for_random_mixes(spark):
    rng = random.Random(5)
    labels = ["mild", "moderate", "severe", "life-threatening"]
    rows = [(i, rng.choices(labels, weights=[60, 25, 10, 5])[0]) for i in range(3000)]
    df = spark.createDataFrame(rows, "case_id long, severity_label string")
    split = severity.stratified_split(df, seed=9)
    got = {r.case_id: r.split for r in split.collect()}
    # brute force: per class, first ceil(0.2 n) by md5(seed|id), ties by id
    import hashlib

    by_class = {}
    for cid, lab in rows:
        by_class.setdefault(lab, []).append(cid)
    for lab, ids in by_class.items():
        ids.sort(key=lambda c: (hashlib.md5(f"9|{c}".encode()).hexdigest(), c))
        k = math.ceil(len(ids) * 0.2)
        assert all(got[c] == "test" for c in ids[:k]) and all(got[c] == "train" for c in ids[k:])


def _plain_fold(y, theta, m=12):
    a, b, c = theta[:3]
    level, trend, season, sse = theta[3], theta[4], list(theta[5:]), 0.0
    for v in y:
        e = v - (level + trend + season[0])
        sse += e * e
        level, trend, season = level + trend + a * e, trend + a * b * e, season[1:] + [season[0] + c * e]
    return level, trend, season, sse


def _series(rng, n):
    t = np.arange(n)
    return 100 + rng.normal(0, 2) * t + 20 * np.sin(t * np.pi / 6) + rng.normal(0, 8, n).cumsum() * 0.3 + rng.normal(0, 5, n)


def test_sensitivities_match_plain_python():
    rng = np.random.default_rng(2)
    lengths = np.array([40, 55, 31])
    y = np.zeros((3, 55))
    for k, n in enumerate(lengths):
        y[k, :n] = _series(rng, n)
    theta = np.column_stack([rng.uniform(0.1, 0.9, (3, 3)), np.full(3, 100.0), rng.normal(0, 1, 3), rng.normal(0, 10, (3, 12))])
    level, trend, season, sse, g, h = series.hw_sensitivities(theta, y, lengths, 12)
    for k, n in enumerate(lengths):
        want = _plain_fold(y[k, :n], theta[k])
        assert np.allclose([level[k], trend[k], sse[k]], [want[0], want[1], want[3]]) and np.allclose(season[k], want[2])
        for i in range(17):  # the squared error's gradient is 2 J'e
            up, down = theta[k].copy(), theta[k].copy()
            up[i], down[i] = up[i] + 1e-5, down[i] - 1e-5
            slope = (_plain_fold(y[k, :n], up)[3] - _plain_fold(y[k, :n], down)[3]) / 2e-5
            assert abs(slope - 2 * g[k, i]) < 1e-3 * max(1.0, abs(slope))
        assert np.allclose(h[k], h[k].T) and (np.linalg.eigvalsh(h[k]) > -1e-6).all()


def test_estimate_is_never_worse_and_is_stationary():
    """Against a plain coordinate search from the estimate: nothing near it is
    clearly better, and the weights stay in their range."""
    rng = np.random.default_rng(3)
    lengths = np.array([36, 48, 60, 75, 29])
    y = np.zeros((5, 75))
    for k, n in enumerate(lengths):
        y[k, :n] = _series(rng, n)
    start = np.array([[0.3, 0.05, 0.1]] * 5)
    found = series.hw_estimate(y, lengths, start, steps=60)
    for k, n in enumerate(lengths):
        first = series.hw_estimate(y[k : k + 1], lengths[k : k + 1], start[:1], steps=0)[0]
        assert found[k, 0] <= first[0] and ((found[k, 1:4] >= 0) & (found[k, 1:4] <= 1)).all()
        # one series alone gives what it gives among others
        assert np.allclose(series.hw_estimate(y[k : k + 1, :n], lengths[k : k + 1], start[:1], steps=60)[0], found[k], rtol=1e-6)
        for i in range(3):
            for step in (-0.02, 0.02):
                w = found[k, 1:4].copy()
                w[i] = min(1.0, max(0.0, w[i] + step))
                near = series.hw_estimate(y[k : k + 1], lengths[k : k + 1], w[None, :], steps=60)[0]
                assert near[0] >= 0.9 * found[k, 0]


def test_continuous_fit_on_rows(spark):
    rng = np.random.default_rng(4)
    months = [f"{2018 + k // 12}-{k % 12 + 1:02d}-01" for k in range(60)]
    rows = [(f"D{d}", "R", months[k], float(v)) for d, n in enumerate((60, 45, 30, 27)) for k, v in enumerate(_series(rng, n))]
    rows += [("flat", "R", m, 5.0) for m in months] + [("zero", "R", m, 0.0) for m in months]
    filled = spark.createDataFrame(rows, "drug_code string, region string, month string, units double").withColumn("month", F.col("month").cast("date"))
    arrays = series.series_arrays(filled)
    out = {r.drug_code: r for r in series.estimate_holt_winters(series.fit_holt_winters(arrays)).collect()}
    assert len(out) == 6
    for r in out.values():
        assert r.fin.sse <= r.fin_grid.sse and r.bt.sse <= r.bt_grid.sse
    assert out["flat"].fin.sse < 1e-12 and out["zero"].fin.sse == 0.0 and out["D0"].fin.sse < out["D0"].fin_grid.sse
    assert len(out["D1"].fin.s) == 12
    fc = series.demand_forecast(filled.withColumn("t", F.lit(1)), continuous=True).collect()
    assert len(fc) == 18 and {r.forecast_units for r in fc if r.drug_code == "flat"} == {5}
    report = series.continuous_report(series.estimate_holt_winters(series.fit_holt_winters(arrays))).collect()
    assert all(r.estimate_sse <= r.grid_sse for r in report) and len(report) == 6


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_match_numpy(spark, monkeypatch, accuracy):
    monkeypatch.setattr(series, "SKETCH", accuracy)  # 20: the brackets cut most values off
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 10, 11, 1000):
        a, b = rng.normal(size=n), rng.integers(0, 4, n).astype(float)
        rows = [(float(x), float(y) if k % 5 else None) for k, (x, y) in enumerate(zip(a, b))]
        df = spark.createDataFrame(rows, "a double, b double").repartition(3)
        asked = {"1": 0.25, "2": 0.5, "3": 0.75, "lo": 0.0, "hi": 1.0, "odd": 0.31}
        got = {(r.metric, r.stat): r.value for r in series.exact_quantiles(df, ["a", "b"], asked).collect()}
        for s, q in asked.items():
            assert abs(got["a", s] - np.quantile(a, q)) < 1e-12
            kept = [y for _, y in rows if y is not None]
            if kept:
                assert abs(got["b", s] - np.quantile(kept, q)) < 1e-12
            else:
                assert ("b", s) not in got
