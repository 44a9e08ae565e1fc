"""Truncated Newton solver against a plain dense one."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector

from rxlake.operators import newton


def dense_newton(x, y, w, classes, l2, steps=60):
    x1 = np.column_stack([x, np.ones(len(x))])
    theta = np.zeros((classes, x1.shape[1]))
    pen = np.full(theta.shape, l2)
    pen[:, -1] = 0.0
    hot = np.eye(classes)[y]
    for _ in range(steps):
        p = newton.softmax(x1 @ theta.T)
        g = ((p - hot) * w[:, None]).T @ x1 + pen * theta
        h = np.zeros((theta.size, theta.size))
        d = x1.shape[1]
        for a in range(classes):
            for b in range(classes):
                h[a * d : (a + 1) * d, b * d : (b + 1) * d] = (x1 * (w * p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ x1
        theta = theta - (np.linalg.pinv(h + np.diag(pen.ravel())) @ g.ravel()).reshape(theta.shape)
    theta[:, -1] -= theta[:, -1].mean()
    return theta


@pytest.mark.parametrize("rows,classes", [(120, 3), (40, 2)])
def test_matches_dense_newton(spark, rows, classes):
    rng = np.random.default_rng(rows)
    n = 15
    data, x = [], np.zeros((rows, n))
    for k in range(rows):
        at = np.sort(rng.choice(n, rng.integers(0, 6), replace=False))
        x[k, at] = rng.normal(size=len(at))
        data.append((SparseVector(n, at.tolist(), x[k, at].tolist()), float(rng.integers(0, classes)), float(rng.uniform(0.2, 3))))
    fit = newton.fit_multinomial(spark.createDataFrame(data, ["features", "label", "weight"]), classes, n, 0.5, tolerance=1e-9)
    want = dense_newton(x, np.array([int(d[1]) for d in data]), np.array([d[2] for d in data]), classes, 0.5)
    assert np.allclose(fit.coefficients, want[:, :-1], atol=1e-5) and np.allclose(fit.intercepts, want[:, -1], atol=1e-5)
    assert fit.gradient_norm <= 1e-9 * sum(d[2] for d in data) and fit.newton_steps < 15


def test_derivatives_by_difference():
    rng = np.random.default_rng(5)
    ends = np.array([0, 2, 2, 5])
    block = newton.Block(
        ends.tobytes(), np.array([0, 3, 1, 2, 3], np.int32).tobytes(), rng.normal(size=5).tobytes(), np.array([0, 2, 1], np.int32).tobytes(), rng.uniform(1, 2, 3).tobytes()
    )
    w, d = rng.normal(size=(3, 5)), rng.normal(size=(3, 5))
    loss, g = newton.loss_and_gradient(block, w)
    up, down = newton.loss_and_gradient(block, w + 1e-6 * d), newton.loss_and_gradient(block, w - 1e-6 * d)
    assert abs((up[0] - down[0]) / 2e-6 - (g * d).sum()) < 1e-6
    assert np.allclose((up[1] - down[1]) / 2e-6, newton.hessian_product(block, w, d), atol=1e-6)


def test_without_rows_or_with_one_class(spark):
    schema_rows = spark.createDataFrame([(SparseVector(3, [0], [1.0]), 0.0, 1.0)], ["features", "label", "weight"])
    none = newton.fit_multinomial(schema_rows.filter("label > 5"), 2, 3, 1.0)
    assert not none.coefficients.any() and none.newton_steps == 0
    one = newton.fit_multinomial(schema_rows, 2, 3, 1.0)
    assert np.isfinite(one.coefficients).all() and one.intercepts[0] > one.intercepts[1]


def _narratives(spark, flip=False):
    rows = [(k, f"{'calm mild day' if k % 2 else 'grave severe pain'} note {k % 5}", ("severe" if (k % 2 == 0) != flip else "mild")) for k in range(40)]
    return spark.createDataFrame([*rows, (90, None, "mild"), (91, "unlabelled", None)], "case_id long, narrative string, severity_label string")


def test_changed_rows_under_the_same_folder_train_again(spark, tmp_dir, monkeypatch):
    from rxlake.operators import severity

    registry = severity.ModelRegistry(tmp_dir)
    rows = _narratives(spark)
    fits = []
    plain = severity.train_severity
    monkeypatch.setattr(severity, "train_severity", lambda *a, **k: fits.append(1) or plain(*a, **k))
    first = registry.load_or_train(rows)
    again = registry.load_or_train(rows.orderBy("narrative").repartition(5))  # the same rows in another order
    assert len(fits) == 1
    other = registry.load_or_train(_narratives(spark, flip=True))
    assert len(fits) == 2
    asked = spark.createDataFrame([(1, "grave pain"), (2, "calm day"), (3, None)], "case_id long, narrative string")
    classes = [{r.case_id: r.predicted_severity for r in severity.score_severity(m, asked).collect()} for m in (first, again, other)]
    assert classes[0] == classes[1] == {1: "severe", 2: "mild", 3: None} and classes[2] == {1: "mild", 2: "severe", 3: None}
    registry.load_or_train(rows, min_df=3)  # other parameters
    registry.load_or_train(rows.union(rows.limit(1)))  # one row twice
    assert len(fits) == 4
    # a save that was cut short does not count
    import shutil

    path = registry.path(rows)
    shutil.rmtree(f"{path}/saved")
    registry.load_or_train(rows)
    assert len(fits) == 5 and registry.load(path) is not None


def test_alerts_meet_the_model_in_all_three_buckets(spark):
    import __spark_entry__ as E
    from oracle import MEDIUM

    got = {r.agreement: r.n for r in E.queries()["j5_reconcile_alerts_vs_model"](spark, MEDIUM).groupBy("agreement").count().withColumnRenamed("count", "n").collect()}
    assert set(got) == {"both", "alert_only", "class_only"}, got


@pytest.mark.parametrize("rows,n", [(30, 90), (80, 12)])
def test_fit_by_rows_matches_dense_newton(rows, n):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, n)) * (rng.random((rows, n)) < 0.3)
    x[3], x[5] = 0, x[4]
    y, w = rng.integers(0, 3, rows), rng.uniform(0.2, 3, rows)
    fit = newton.fit_by_rows(lambda m: x @ (x.T @ m), y, w, 3, 0.5, tolerance=1e-9)
    want = dense_newton(x, y, w, 3, 0.5)
    assert np.allclose(fit.by_row.T @ x, want[:, :-1], atol=1e-5) and np.allclose(fit.intercepts, want[:, -1], atol=1e-5)


def test_no_vocabulary_on_the_driver_and_scores_by_hand(spark, monkeypatch):
    """Every array a fit takes to the driver has the size of its rows, not of its terms."""
    import math

    from rxlake.operators import severity, termpacks

    monkeypatch.setattr(termpacks, "DIRECT_BYTES", 0)  # sums of any size meet by ranges of rows
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{t}" for t in rng.integers(0, 400, 60)) + (" grave" * 3 if k % 3 == 0 else " calm"), "severe" if k % 3 == 0 else "mild") for k in range(60)]
    rows += [(100 + k, rows[k][1], rows[k][2]) for k in range(5)]  # copies
    train = spark.createDataFrame(rows, "case_id long, narrative string, severity_label string")
    taken, plain = [], type(train).toArrow
    monkeypatch.setattr(type(train), "toArrow", lambda self: taken.append(plain(self)) or taken[-1])
    model = severity.train_severity(train)
    terms = severity.fit_features(train).vocabulary.count()
    largest = max(t.nbytes for t in taken)
    assert terms > 700 and largest < 8 * terms and largest <= 60 * 4 * 8 + 1024

    asked = spark.createDataFrame([(1, "w1 grave w2 w2"), (1, "w1 grave w2 w2"), (2, "calm w5"), (3, "zzz"), (4, ""), (5, None), (6, None)], "case_id long, narrative string")
    got = sorted((r.case_id, r.predicted_severity) for r in severity.score_severity(model, asked).collect())
    assert [g[0] for g in got] == [1, 1, 2, 3, 4, 5, 6] and got[5:] == [(5, None), (6, None)]
    weights = {}
    for r in model.weights.collect():
        per = np.frombuffer(r.weights).reshape(len(model.classes), -1).T
        weights |= dict(zip(np.frombuffer(r.terms, np.int64).tolist(), zip(np.frombuffer(r.idf), per, strict=True), strict=True))
    assert len(weights) == terms
    for text, want in [(asked.first().narrative, got[0][1]), ("calm w5", got[2][1]), ("zzz", got[3][1]), ("", got[4][1])]:
        words = text.split()
        hashed = {r.h: r.n for r in spark.createDataFrame([(t,) for t in [*words, *map(" ".join, zip(words, words[1:]))]], "t string").selectExpr("xxhash64(t) h").groupBy("h").count().withColumnRenamed("count", "n").collect()}
        known = {h: n for h, n in hashed.items() if h in weights}
        size = math.sqrt(sum((n * weights[h][0]) ** 2 for h, n in known.items())) or 1.0
        margin = np.array(model.intercepts) + sum((n * weights[h][1] / size for h, n in known.items()), np.zeros(len(model.classes)))
        assert want == model.classes[int(margin.argmax())]


def test_fit_without_rows_scores_by_the_first_class(spark):
    from rxlake.operators import severity

    none = _narratives(spark).filter("case_id < 0")
    model = severity.train_severity(none)
    got = severity.score_severity(model, _narratives(spark).filter("case_id > 88")).collect()
    assert {(r.case_id, r.predicted_severity) for r in got} == {(90, None), (91, "mild")}


def test_a_fit_leaves_no_products_on_the_driver(spark, monkeypatch):
    """Every product's operand is given up on the driver too, once it is used."""
    import os

    from rxlake.operators import severity

    made, sc = [], spark.sparkContext
    plain = type(sc).broadcast
    monkeypatch.setattr(type(sc), "broadcast", lambda self, value: made.append(plain(self, value)) or made[-1])
    severity.train_severity(_narratives(spark))
    assert len(made) > 4 and sum(os.path.exists(b._path) for b in made) <= 2  # rows' ids, weights by row  # noqa: SLF001


def test_split_rows_meet_their_labels_once(spark):
    """Passes over the split read written rows."""
    from conftest import SMALL
    from rxlake.operators import severity
    from rxlake.plans import q_severity

    split = q_severity._split(spark, SMALL)  # noqa: SLF001
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "FileScan" in plan.replace("Scan parquet", "FileScan")
    again = severity.stratified_split(q_severity._narratives(spark, SMALL), seed=q_severity.SEED)  # noqa: SLF001
    assert split.schema.simpleString() == again.schema.simpleString()
    assert sorted(map(str, split.collect())) == sorted(map(str, again.collect()))


def test_a_fit_by_rows_keeps_few_vectors(monkeypatch):
    """Of rows x classes, the driver holds a few vectors and no temporaries; the
    slices it works on do not show in the result."""
    import tracemalloc

    rng = np.random.default_rng(11)
    n, classes = 40_000, 4
    x, y, w = rng.normal(size=(n, 6)), rng.integers(0, classes, n), rng.uniform(0.2, 3, n)
    asked = []

    def gram(m):
        asked.append(m.shape)
        return x @ (x.T @ m)

    tracemalloc.start()
    fit = newton.fit_by_rows(gram, y, w, classes, 0.5, tolerance=1e-7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 11 * n * classes * 8 and fit.newton_steps > 1
    assert set(asked) == {(n, classes - 1)}  # the last class is minus the others' sum
    assert np.allclose(fit.by_row.sum(axis=1), 0)
    monkeypatch.setattr(newton, "SLICE_ROWS", n + 1)
    whole = newton.fit_by_rows(gram, y, w, classes, 0.5, tolerance=1e-7)
    assert np.allclose(fit.by_row, whole.by_row, atol=1e-6) and np.allclose(fit.intercepts, whole.intercepts, atol=1e-6)
    hot = np.eye(classes)[y]
    p = newton.softmax(x @ (fit.by_row.T @ x).T + fit.intercepts)
    assert np.abs(((p - hot) * w[:, None]).T @ x + 0.5 * fit.by_row.T @ x).max() < 1e-5 * w.sum()


def test_fit_by_rows_of_one_class():
    one = newton.fit_by_rows(lambda m: m, np.zeros(3, np.int64), np.ones(3), 1, 1.0)
    assert one.by_row.shape == (3, 1) and not one.by_row.any() and not one.intercepts.any()


def _many_texts(spark, n=150):
    rng = np.random.default_rng(17)
    classes = ["mild", "moderate", "severe", "life-threatening"]
    rows = [(k, " ".join(f"w{t}" for t in rng.integers(0, 200, 30)) + f" {classes[k % 4][:4]}" * int(rng.integers(0, 3)), classes[k % 4]) for k in range(n)]
    rows += [(n + k, rows[k][1], rows[k][2]) for k in range(8)] + [(900, "", "mild"), (901, "zzz", "severe"), (902, None, "mild"), (903, "w1 w2", None)]
    return spark.createDataFrame(rows, "case_id long, narrative string, severity_label string").repartition(3)


def _weights(model):
    out = {}
    for r in model.weights.collect():
        out |= dict(zip(np.frombuffer(r.terms, np.int64).tolist(), np.frombuffer(r.weights).reshape(len(model.classes), -1).T, strict=True))
    return out


def test_more_rows_than_the_driver_holds_are_all_fitted(spark, monkeypatch):
    """Beyond the driver's share nothing is left out: the same model from vectors
    that lie in ranges over the executors; the driver takes sums only."""
    from rxlake.operators import rangefit, severity

    train, asked = _many_texts(spark), _many_texts(spark, 60)
    seen, plain = [], severity.fit_features
    monkeypatch.setattr(severity, "fit_features", lambda *a, **k: seen.append(plain(*a, **k)) or seen[-1])
    whole = severity.train_severity(train)
    for name, value in (("RANGE_BITS", 4), ("RANGES_A_TASK", 2), ("SPOOL_BYTES", 512), ("KEPT_PRODUCTS", 3)):
        monkeypatch.setattr(rangefit, name, value)
    taken, arrow = [], type(train).toArrow
    monkeypatch.setattr(type(train), "toArrow", lambda self: taken.append(1) or arrow(self))
    told, collect = [], rangefit.RDD.collect
    monkeypatch.setattr(rangefit.RDD, "collect", lambda self: told.append(collect(self)) or told[-1])
    parts = severity.train_severity(train, driver_rows=20)
    assert not taken and len(told) > 20 and max(np.asarray(x).size for some in told for x in some) <= len(parts.classes) + 2
    assert [f.rows for f in seen] == [160, 160]
    first, second = _weights(whole), _weights(parts)
    assert first.keys() == second.keys() and len(first) > 200
    assert max(np.abs(first[t] - second[t]).max() for t in first) < 1e-4 * max(np.abs(w).max() for w in first.values())
    assert np.allclose(whole.intercepts, parts.intercepts, atol=1e-4)
    predicted = [sorted((r.case_id, r.predicted_severity or "") for r in severity.score_severity(m, asked).collect()) for m in (whole, parts)]
    assert predicted[0] == predicted[1]
    monkeypatch.undo()
    assert not [x for x in spark.sparkContext._jsc.getPersistentRDDs().values() if "Python" in str(x) or "valueOfPair" in str(x)]  # noqa: SLF001


def test_texts_without_terms_fit_by_ranges(spark):
    """No vocabulary at all: intercepts only, as on the driver."""
    from rxlake.operators import severity

    train = spark.createDataFrame([(k, f"x{k}", "severe" if k % 3 else "mild") for k in range(30)], "case_id long, narrative string, severity_label string")
    whole, parts = severity.train_severity(train), severity.train_severity(train, driver_rows=5)
    assert _weights(whole) == _weights(parts) == {} and np.allclose(whole.intercepts, parts.intercepts, atol=1e-6)
