"""Co-moments, models per key and set-based trees against plain NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthpanel.operators.baselines import mark_holdout
from monthpanel.operators.features import supervised_strict
from monthpanel.operators.fit_keys import fill_medians, fit_left_out_ridge, fit_linear, keyed_contest
from monthpanel.operators.learn import RIDGE_ALPHAS, ridge_by_leave_one_out, standardize
from monthpanel.operators.moments import comoments
from monthpanel.operators.trees import boosted, forest


def numbers(spark, groups=3, rows=40, p=4, seed=0):
    """Rows of some keys (one of them null) with features of very different sizes."""
    rng = np.random.default_rng(seed)
    data, start = [], np.datetime64("2015-01")
    for g in range(groups):
        x = rng.normal(size=(rows, p)) * 10.0 ** np.arange(p) + 1e6
        y = x @ rng.normal(size=p) + rng.normal(size=rows)
        data += [(None if g == 1 else f"k{g}", (start + i).astype("datetime64[D]").item(), float(y[i]), *map(float, x[i])) for i in range(rows)]
    return spark.createDataFrame(data, "k string, date date, y double, " + ", ".join(f"x{j} double" for j in range(p)))


def by_key(df, columns):
    pdf = df.orderBy("date").toPandas()
    return {k if isinstance(k, str) else None: g[columns].to_numpy(float) for k, g in pdf.groupby("k", dropna=False)}


def z_scores(x):
    std = x.std(axis=0)
    return (x - x.mean(axis=0)) / np.where(std == 0, 1, std)


@pytest.mark.parametrize("keys", [["k"], []])
def test_comoments(spark, keys):
    df = numbers(spark).repartition(7)
    columns = ["x0", "x1", "x3", "y"]
    rows = comoments(df.union(df.limit(1).withColumn("x0", F.lit(None))), columns, keys).collect()
    want = by_key(df, columns) if keys else {1: df.select(columns).toPandas().to_numpy()}
    assert len(rows) == len(want)
    for r in rows:
        v = want[r[0]]
        c = v - v.mean(axis=0)
        assert r["n"] == len(v) and np.allclose(r["mean"], v.mean(axis=0)) and np.allclose(np.array(r["product"]).reshape(4, 4), c.T @ c)


def test_comoments_of_many_columns_have_a_small_plan(spark):
    p = 500
    df = spark.range(300).select(*[(F.rand(j) + F.lit(float(j))).alias(f"c{j}") for j in range(p)])
    made = comoments(df, [f"c{j}" for j in range(p)])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    small = comoments(df.select("c0", "c1"), ["c0", "c1"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") <= small.count("\n") + 5
    row = made.first()
    product = np.array(row["product"]).reshape(p, p)
    assert row["n"] == 300 and np.allclose(product, product.T) and (np.linalg.eigvalsh(product) > -1e-6).all()


def test_left_out_ridge_of_500_features(spark):
    """More features than rows: p*(p+1)/2 sums would be 125,000 expressions."""
    p, n = 500, 60
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, p))
    y = x[:, 0] * 3 + rng.normal(size=n)
    names = [f"c{j}" for j in range(p)]
    df = spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y, z_scores(x))], "y double, " + ", ".join(f"{c} double" for c in names))
    made, alpha = ridge_by_leave_one_out(df, df, names, "y")
    z, c = z_scores(x), y - y.mean()
    w = z.T @ np.linalg.solve(z @ z.T + alpha * np.eye(n), c)
    assert np.allclose(sorted(r["prediction"] for r in made.select("prediction").collect()), sorted(y.mean() + z @ w), atol=1e-6)


def test_linear_models_per_key(spark):
    features = ["x0", "x1", "x2", "x3", "flat"]
    df = numbers(spark).withColumn("flat", F.lit(0.1))
    made = {(r["k"], r["model"]): r for r in fit_linear(df.repartition(5), "y", features, ["k"], ["ridge_lagged", "elasticnet_lagged"]).collect()}
    data = by_key(df, [*features, "y"])
    assert set(made) == {(k, m) for k in data for m in ("ridge_lagged", "elasticnet_lagged")}
    for k, v in data.items():
        x, y = v[:, :-1], v[:, -1]
        z, n = z_scores(x), len(y)
        w = np.linalg.solve(z.T @ z + np.eye(5), z.T @ (y - y.mean()))
        r = made[k, "ridge_lagged"]
        assert np.allclose(r["intercept"] + x @ np.array(r["weights"]), y.mean() + z @ w, rtol=1e-9) and r["rows"] == n
        w, rest = np.zeros(5), y - y.mean()
        for _ in range(5000):
            for j in range(5):
                rest = rest + z[:, j] * w[j]
                rho = z[:, j] @ rest / n
                w[j] = np.sign(rho) * max(abs(rho) - 0.004, 0) / (z[:, j] @ z[:, j] / n + 0.016)
                rest = rest - z[:, j] * w[j]
        r = made[k, "elasticnet_lagged"]
        assert np.allclose(r["intercept"] + x @ np.array(r["weights"]), y.mean() + z @ w, rtol=1e-9)


def test_left_out_ridge_per_key(spark):
    features = ["x0", "x1", "x2"]
    df = numbers(spark)
    for r in fit_left_out_ridge(df.repartition(4), "y", features, ["k"]).collect():
        v = by_key(df, [*features, "y"])[r["k"]]
        x, y = v[:, :-1], v[:, -1]
        z, n = z_scores(x), len(y)
        losses = []
        for alpha in RIDGE_ALPHAS:
            hat = 1 / n + z @ np.linalg.inv(z.T @ z + alpha * np.eye(3)) @ z.T
            fit = y.mean() + (hat - 1 / n) @ (y - y.mean())
            losses.append((((y - fit) / (1 - np.diag(hat))) ** 2).mean())
        alpha = RIDGE_ALPHAS[int(np.argmin(losses))]
        assert r["alpha"] == alpha
        w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        assert np.allclose(r["intercept"] + x @ np.array(r["weights"]), y.mean() + z @ w, rtol=1e-9)


def test_pooled_and_keyed_left_out_ridge_agree(spark):
    df = numbers(spark, groups=1)
    features = ["x0", "x1"]
    pooled, alpha = ridge_by_leave_one_out(standardize(df, df, features), standardize(df, df, features), features, "y")
    r = fit_left_out_ridge(df, "y", features, ["k"]).first()
    want = df.withColumn("p", F.lit(r["intercept"]) + sum(F.col(c) * w for c, w in zip(features, r["weights"])))
    assert alpha == r["alpha"]
    assert np.allclose([x["prediction"] for x in pooled.orderBy("date").collect()], [x["p"] for x in want.orderBy("date").collect()])


def test_medians_per_key(spark):
    rows = [("a", 1, 1.0, None), ("a", 2, 5.0, None), ("a", 3, None, None), ("a", 4, 100.0, None), ("b", 1, None, 2.0), ("b", 2, 7.0, 4.0), ("b", 3, 8.0, None)]
    marked = spark.createDataFrame(rows, "k string, date int, u double, v double").withColumn("part", F.when(F.col("date") < 4, "train").otherwise("test"))
    got = {(r["k"], r["date"]): (r["u"], r["v"]) for r in fill_medians(marked, ["u", "v"], ["k"]).collect()}
    assert got == {("a", 1): (1, 0), ("a", 2): (5, 0), ("a", 3): (3, 0), ("a", 4): (100, 0), ("b", 1): (7.5, 2), ("b", 2): (7, 4), ("b", 3): (8, 3)}


def test_keyed_contest_reports_short_keys(spark):
    df = numbers(spark, rows=30).select("k", "date", "y").where("k is null or k = 'k0' or date < '2015-06-01'")
    frame = supervised_strict(df, "y", [1, 2], [], calendar=False, keys=["k"])
    comparison, predictions = keyed_contest(frame, "y", ["y_lag_1", "y_lag_2"], 5, ["k"], ["ridge_lagged", "ridge"], panel=df)
    rows = {(r["k"], r["model"]): r for r in comparison.collect()}
    assert {k for k, r in rows.items() if r["status"] == "trained"} == {("k0", "ridge_lagged"), ("k0", "ridge")}
    assert rows["k2", "ridge"]["status"] == "skipped: Not enough supervised rows for test_size=5." and rows["k2", "ridge"]["rmse"] is None
    assert rows["k0", "ridge"]["rmse"] > 0 and predictions.count() == 10
    with pytest.raises(ValueError, match="needs keys"):
        keyed_contest(frame, "y", ["y_lag_1"], 5, [], ["ridge"])


def plain_tree(x, y, w, depth, least):
    """Nested tuples (feature, threshold, left, right), or a mean."""
    mean = (w * y).sum() / w.sum()
    total = (w * (y - mean) ** 2).sum()
    best = None
    if depth and total > 0:
        for j in range(x.shape[1]):
            values = np.unique(x[w > 0, j])
            for a, b in zip(values, values[1:]):
                left = x[:, j] <= (a + b) / 2
                wl, wr = w[left].sum(), w[~left].sum()
                if wl >= least and wr >= least:
                    gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (w * y).sum() ** 2 / w.sum()
                    share = round(gain / total, 9)
                    if share > 0 and (best is None or share > best[0]):
                        best = (share, j, (a + b) / 2, left)
    if best is None:
        return mean
    _, j, threshold, left = best
    return (j, threshold, plain_tree(x[left], y[left], w[left], depth - 1, least), plain_tree(x[~left], y[~left], w[~left], depth - 1, least))


def follow(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def predictions_of(df):
    return {(r["k"], r["date"]): r["prediction"] for r in df.collect()}


def tree_case(spark):
    df = numbers(spark, rows=36, p=3, seed=9)
    marked = mark_holdout(df, 6, ["k"])
    cases = {}
    for k, v in by_key(df, ["x0", "x1", "x2", "y"]).items():
        dates = sorted(r["date"] for r in df.where(F.col("k").eqNullSafe(F.lit(k))).collect())
        cases[k] = (v[:-6, :-1], v[:-6, -1], v[-6:, :-1], dates)
    return marked, cases


@pytest.mark.parametrize("depth, least", [(1, 1), (3, 3)])
def test_boosted_trees_equal_a_plain_search(spark, tmp_path, depth, least):
    marked, cases = tree_case(spark)
    got = predictions_of(boosted(marked, ["x0", "x1", "x2"], "y", ["k"], rounds=6, step=0.3, depth=depth, min_leaf=least, folder=str(tmp_path)))
    for k, (x, y, test, dates) in cases.items():
        fit, out = np.full(len(y), y.mean()), np.full(len(test), y.mean())
        for _ in range(6):
            tree = plain_tree(x, y - fit, np.ones(len(y)), depth, least)
            fit = fit + 0.3 * np.array([follow(tree, r) for r in x])
            out = out + 0.3 * np.array([follow(tree, r) for r in test])
        assert np.allclose([got[k, d] for d in dates[-6:]], out)


def test_forest_equals_a_plain_search(spark, tmp_path):
    import hashlib

    marked, cases = tree_case(spark)
    got = predictions_of(forest(marked, ["x0", "x1", "x2"], "y", ["k"], trees=5, depth=3, min_leaf=3, seed=7, folder=str(tmp_path)))
    cdf = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    for k, (x, y, test, dates) in cases.items():
        out = []
        for t in range(5):
            uniform = [int(hashlib.md5(f"7|{t}|{k or ''}|{d}".encode()).hexdigest()[:13], 16) / 16**13 for d in dates[:-6]]
            w = np.searchsorted(cdf, uniform, "right").astype(float)
            tree = plain_tree(x[w > 0], y[w > 0], w[w > 0], 3, 3)
            out.append([follow(tree, r) for r in test])
        assert np.allclose([got[k, d] for d in dates[-6:]], np.mean(out, axis=0))


def test_trees_without_keys_or_variance(spark, tmp_path):
    flat = numbers(spark, groups=1).withColumn("y", F.lit(2.0))
    made = boosted(mark_holdout(flat, 6), ["x0"], "y", rounds=2, folder=str(tmp_path / "a")).collect()
    assert [r["prediction"] for r in made] == [2.0] * 6 and made[0].asDict().keys() == {"date", "y", "prediction"}
    grown = forest(mark_holdout(numbers(spark, groups=1), 6), ["x0", "x1"], "y", trees=4, depth=2, folder=str(tmp_path / "b"))
    assert grown.count() == 6 and grown.where("prediction is null").isEmpty()
