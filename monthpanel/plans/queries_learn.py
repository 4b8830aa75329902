"""Registered queries: fitted models on nation revenue, pooled over nations, and with ``_keys`` one for each nation.

Linear fits have few features, so that SQL can state them in closed form; trees have few levels, trees and rounds, so that SQL can
search every split, redraw the bootstrap from the same hashes and add up the rounds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from monthpanel.operators.features import supervised_sparse, supervised_strict
from monthpanel.operators.fit_keys import keyed_contest
from monthpanel.operators.learn import ELASTIC_ALPHA, ELASTIC_L1_RATIO, RIDGE_ALPHA, RIDGE_ALPHAS, lagged_contest, sparse_contest, wide_predictions
from monthpanel.operators.trees import POISSON
from monthpanel.plans.views import CUSTOMER_MONTH, NATION_MONTH, customer_month, nation_month, rounded

KEYS = ["nation"]
LAGS = ["revenue_lag_1", "revenue_lag_12"]
# As few trees and rounds as SQL can spell out; the defaults are larger.
SMALL_FOREST = {"trees": 3, "depth": 2, "min_leaf": 3}
SMALL_BOOSTING = {"rounds": 3, "step": 0.05, "depth": 2}


def _strict(spark, sf_dir, model, features=None):
    frame = supervised_strict(nation_month(spark, sf_dir), "revenue", keys=KEYS)
    features = features or [c for c in frame.columns if c not in ("nation", "date", "__target__")]
    return frame, lagged_contest(frame, "revenue", features, 12, KEYS, [model])[1]


def _sparse(spark, sf_dir, models, features=None):
    frame, found = supervised_sparse(nation_month(spark, sf_dir), "revenue", ["orders"], keys=KEYS)
    return sparse_contest(frame, features or found, "revenue", 12, KEYS, models)[1]


def _whole(predictions):
    return predictions.select("nation", "date", "actual", F.round("prediction", 0).alias("prediction"))


def ml_ridge(spark, sf_dir):
    return _whole(_strict(spark, sf_dir, "ridge_lagged", LAGS)[1])


def ml_elasticnet(spark, sf_dir):
    return _whole(_strict(spark, sf_dir, "elasticnet_lagged", LAGS[:1])[1])


def ml_ridge_cv(spark, sf_dir):
    made = _sparse(spark, sf_dir, ["ridge"], LAGS)
    return made.select("nation", "date", "revenue", F.round("pred_ridge", 0).alias("pred_ridge"))


def ml_ridge_keys(spark, sf_dir):
    frame = supervised_strict(nation_month(spark, sf_dir), "revenue", keys=KEYS)
    return _whole(keyed_contest(frame, "revenue", LAGS, 12, KEYS, ["ridge_lagged"])[1])


def ml_elasticnet_keys(spark, sf_dir):
    frame = supervised_strict(nation_month(spark, sf_dir), "revenue", keys=KEYS)
    return _whole(keyed_contest(frame, "revenue", LAGS[:1], 12, KEYS, ["elasticnet_lagged"])[1])


def ml_ridge_cv_keys(spark, sf_dir):
    frame = supervised_sparse(nation_month(spark, sf_dir), "revenue", ["orders"], keys=KEYS)[0]
    return _whole(keyed_contest(frame, "revenue", LAGS, 12, KEYS, ["ridge"], target="revenue", impute=True)[1])


def ml_status_keys(spark, sf_dir):
    """Customers have a handful of months: many are too short for two lags and three test months."""
    months = customer_month(spark, sf_dir)
    frame = supervised_strict(months, "revenue", [1, 2], [], calendar=False, keys=["customer"])
    made = keyed_contest(frame, "revenue", ["revenue_lag_1", "revenue_lag_2"], 3, ["customer"], ["ridge_lagged", "elasticnet_lagged"], panel=months)[0]
    return made.groupBy("model", "status", F.col("rmse").isNotNull().alias("scored")).agg(F.count("*").alias("customers"))


def _trees(spark, sf_dir, model, **options):
    frame = supervised_strict(nation_month(spark, sf_dir), "revenue", keys=KEYS)
    return _whole(keyed_contest(frame, "revenue", LAGS, 12, KEYS, [model], options={model: options})[1])


def ml_tree_keys(spark, sf_dir):
    """A tree of one split."""
    return _trees(spark, sf_dir, "gradient_boosting", rounds=1, step=1.0, depth=1)


def ml_tree_depth2_keys(spark, sf_dir):
    return _trees(spark, sf_dir, "gradient_boosting", rounds=1, step=1.0, depth=2, min_leaf=3)


def ml_forest(spark, sf_dir):
    return _trees(spark, sf_dir, "random_forest", **SMALL_FOREST)


def ml_gbt(spark, sf_dir):
    return _trees(spark, sf_dir, "gradient_boosting", **SMALL_BOOSTING)


def ml_holdout(spark, sf_dir):
    """The second model set per nation, as one row a month."""
    frame = supervised_sparse(nation_month(spark, sf_dir), "revenue", ["orders"], keys=KEYS)[0]
    models = ["ridge", "random_forest", "gradient_boosting"]
    options = {"random_forest": SMALL_FOREST, "gradient_boosting": SMALL_BOOSTING}
    made = keyed_contest(frame, "revenue", LAGS, 12, KEYS, models, target="revenue", impute=True, options=options)[1]
    return rounded(wide_predictions(made, models, "revenue", KEYS), **{f"pred_{m}": 0 for m in models})


# Rows after the twelfth of a nation have all lags and windows; its last twelve are the test.
FRAME = f"""{NATION_MONTH},
lagged AS (
  SELECT nation, date, revenue AS y, lag(revenue, 1) OVER w AS x1, lag(revenue, 12) OVER w AS x2,
         row_number() OVER w AS rn, count(*) OVER (PARTITION BY nation) AS n
  FROM nation_month WINDOW w AS (PARTITION BY nation ORDER BY date)),
frame AS (SELECT *, rn <= n - 12 AS train FROM lagged WHERE rn > 12 AND n > 24)"""
SCALED = f"""{FRAME},
facts AS (
  SELECT count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2
  FROM frame WHERE train),
z AS (
  SELECT nation, date, train, y, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, y - my AS c, my, f.n AS rows
  FROM frame, facts f),
sums AS (
  SELECT sum(z1 * z1) AS a, sum(z1 * z2) AS b, sum(z2 * z2) AS d, sum(z1 * c) AS p, sum(z2 * c) AS q FROM z WHERE train)"""
KEYED = f"""{FRAME},
facts AS (
  SELECT nation, count(*) AS rows, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2
  FROM frame WHERE train GROUP BY nation),
z AS (
  SELECT nation, date, train, y, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, y - my AS c, my, rows FROM frame JOIN facts USING (nation)),
sums AS (
  SELECT nation, any_value(rows) AS rows, sum(z1 * z1) AS a, sum(z1 * z2) AS b, sum(z2 * z2) AS d, sum(z1 * c) AS p, sum(z2 * c) AS q
  FROM z WHERE train GROUP BY nation)"""


def split_sql(name: str, rows: str, level: int, min_leaf: int) -> str:
    """CTE ``name``: the best split of each node of a level of ``rows`` (``nation, tree, node, x1, x2, t, w``)."""
    return f"""{name}_long AS (
  SELECT nation, tree, node, feature, x, sum(w) AS w, sum(w * t) AS s, sum(w * t * t) AS q
  FROM (SELECT nation, tree, node, w, t, unnest([0, 1]) AS feature, unnest([x1, x2]) AS x FROM {rows} WHERE w > 0 AND node >= {2**level}) GROUP BY ALL),
{name}_scan AS (
  SELECT nation, tree, node, feature, x, lead(x) OVER o AS further, sum(w) OVER o AS wl, sum(s) OVER o AS sl,
         sum(w) OVER a AS wt, sum(s) OVER a AS st, sum(q) OVER a AS qt
  FROM {name}_long WINDOW o AS (PARTITION BY nation, tree, node, feature ORDER BY x), a AS (PARTITION BY nation, tree, node, feature)),
{name} AS (
  SELECT nation, tree, node, feature, (x + further) / 2 AS threshold, sl / wl AS l, (st - sl) / (wt - wl) AS r,
         round((sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt) / (qt - st * st / wt), 9) AS share
  FROM {name}_scan WHERE further IS NOT NULL AND wl >= {min_leaf} AND wt - wl >= {min_leaf} AND qt - st * st / wt > 0
  QUALIFY share > 0 AND row_number() OVER (PARTITION BY nation, tree, node ORDER BY share DESC, feature, threshold) = 1)"""


def tree_sql(prefix: str, rows: str, depth: int, min_leaf: int) -> tuple[str, str]:
    """CTEs that lead ``rows`` (with ``value``) down a tree of ``depth`` levels, and the name of the last."""
    steps, at = [], rows
    for level in range(depth):
        steps.append(split_sql(f"{prefix}_split{level}", at, level, min_leaf))
        steps.append(f"""{prefix}_at{level} AS (
  SELECT p.* EXCLUDE (node, value),
         CASE WHEN threshold IS NULL THEN p.node ELSE 2 * p.node + CASE WHEN CASE WHEN feature = 0 THEN x1 ELSE x2 END > threshold THEN 1 ELSE 0 END END AS node,
         CASE WHEN threshold IS NULL THEN value WHEN CASE WHEN feature = 0 THEN x1 ELSE x2 END > threshold THEN r ELSE l END AS value
  FROM {at} p LEFT JOIN {prefix}_split{level} s ON p.nation = s.nation AND p.tree = s.tree AND p.node = s.node)""")
        at = f"{prefix}_at{level}"
    return ",\n".join(steps), at


def boosting_sql(rounds: int, step: float, depth: int, min_leaf: int = 1) -> str:
    """CTE ``boosting`` (``nation, date, y, prediction`` of the test) after ``frame``."""
    parts = ["""boost0 AS (
  SELECT nation, date, train, y, x1, x2, 0 AS tree, 1 AS node, 0.0::DOUBLE AS value, m AS fit, y - m AS t, CASE WHEN train THEN 1.0 ELSE 0.0 END::DOUBLE AS w
  FROM frame JOIN (SELECT nation, avg(y) AS m FROM frame WHERE train GROUP BY nation) USING (nation))"""]
    for k in range(1, rounds + 1):
        steps, last = tree_sql(f"boost{k}", f"boost{k - 1}", depth, min_leaf)
        parts.append(steps)
        parts.append(f"boost{k} AS (SELECT * REPLACE (1 AS node, 0.0::DOUBLE AS value, fit + {step} * value AS fit, t - {step} * value AS t) FROM {last})")
    parts.append(f"boosting AS (SELECT nation, date, y, fit AS prediction FROM boost{rounds} WHERE NOT train)")
    return ",\n".join(parts)


def forest_sql(trees: int, depth: int, min_leaf: int) -> str:
    """CTE ``forest`` (as ``boosting``) after ``frame``."""
    steps, last = tree_sql("grown", "rooted", depth, min_leaf)
    cdf = ", ".join(repr(p) for p in [*POISSON, 1.0])
    return f"""drawn AS (
  SELECT nation, date, train, y, x1, x2, tree, 1 AS node, y - m AS t, m,
         CASE WHEN train THEN list_position(list_transform([{cdf}], lambda p:
           ('0x' || substr(md5('42|' || tree || '|' || nation || '|' || strftime(date, '%Y-%m-%d')), 1, 13))::BIGINT / 4503599627370496.0 < p), true) - 1 ELSE 0 END::DOUBLE AS w
  FROM frame JOIN (SELECT nation, avg(y) AS m FROM frame WHERE train GROUP BY nation) USING (nation), range(0, {trees}) AS r(tree)),
rooted AS (
  SELECT d.*, coalesce(root, 0.0) AS value FROM drawn d JOIN (SELECT nation, tree, sum(w * t) / nullif(sum(w), 0) AS root FROM drawn GROUP BY ALL) USING (nation, tree)),
{steps},
forest AS (SELECT nation, date, y, any_value(m) + avg(value) AS prediction FROM {last} WHERE NOT train GROUP BY nation, date, y)"""


LEFT_OUT = f"""alphas AS (SELECT unnest([{', '.join(repr(a) for a in RIDGE_ALPHAS)}]) AS t),
solved AS (
  SELECT nation, t, (a + t) * (d + t) - b * b AS det, a + t AS ta, d + t AS td, b,
         ((d + t) * p - b * q) / ((a + t) * (d + t) - b * b) AS w1, ((a + t) * q - b * p) / ((a + t) * (d + t) - b * b) AS w2
  FROM sums, alphas),
errors AS (
  SELECT nation, t, any_value(w1) AS w1, any_value(w2) AS w2,
         avg(power((c - w1 * z1 - w2 * z2) / (1 - 1.0 / rows - (td * z1 * z1 - 2 * b * z1 * z2 + ta * z2 * z2) / det), 2)) AS loss
  FROM z JOIN solved USING (nation) WHERE train GROUP BY nation, t),
best AS (SELECT nation, arg_min(w1, loss) AS w1, arg_min(w2, loss) AS w2 FROM errors GROUP BY nation),
ridge AS (SELECT nation, date, y, my + w1 * z1 + w2 * z2 AS prediction FROM z JOIN best USING (nation) WHERE NOT train)"""
ACTUAL = "SELECT nation, date, y AS actual, round(prediction, 0) AS prediction FROM"

SQL = {
    "ml_ridge": f"""WITH {SCALED},
solved AS (
  SELECT ((d + {RIDGE_ALPHA}) * p - b * q) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w1,
         ((a + {RIDGE_ALPHA}) * q - b * p) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w2 FROM sums)
SELECT nation, date, y AS actual, round(my + w1 * z1 + w2 * z2, 0) AS prediction FROM z, solved WHERE NOT train""",
    "ml_elasticnet": f"""WITH {SCALED},
solved AS (
  SELECT sign(p) * greatest(abs(p) / rows - {ELASTIC_ALPHA * ELASTIC_L1_RATIO}, 0) / (1 + {ELASTIC_ALPHA * (1 - ELASTIC_L1_RATIO)}) AS w
  FROM sums, (SELECT max(rows) AS rows FROM z))
SELECT nation, date, y AS actual, round(my + w * z1, 0) AS prediction FROM z, solved WHERE NOT train""",
    "ml_ridge_cv": f"""WITH {SCALED},
alphas AS (SELECT unnest([{', '.join(repr(a) for a in RIDGE_ALPHAS)}]) AS t),
solved AS (
  SELECT t, (a + t) * (d + t) - b * b AS det, a + t AS ta, d + t AS td, b,
         ((d + t) * p - b * q) / ((a + t) * (d + t) - b * b) AS w1, ((a + t) * q - b * p) / ((a + t) * (d + t) - b * b) AS w2
  FROM sums, alphas),
errors AS (
  SELECT t, any_value(w1) AS w1, any_value(w2) AS w2,
         avg(power((c - w1 * z1 - w2 * z2) / (1 - 1.0 / rows - (td * z1 * z1 - 2 * b * z1 * z2 + ta * z2 * z2) / det), 2)) AS loss
  FROM z, solved WHERE train GROUP BY t),
best AS (SELECT w1, w2 FROM errors ORDER BY loss, t LIMIT 1)
SELECT nation, date, y AS revenue, round(my + w1 * z1 + w2 * z2, 0) AS pred_ridge FROM z, best WHERE NOT train""",
    "ml_ridge_keys": f"""WITH {KEYED},
solved AS (
  SELECT nation, ((d + {RIDGE_ALPHA}) * p - b * q) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w1,
         ((a + {RIDGE_ALPHA}) * q - b * p) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b) AS w2 FROM sums)
SELECT nation, date, y AS actual, round(my + w1 * z1 + w2 * z2, 0) AS prediction FROM z JOIN solved USING (nation) WHERE NOT train""",
    "ml_elasticnet_keys": f"""WITH {KEYED},
solved AS (
  SELECT nation, sign(p) * greatest(abs(p) / rows - {ELASTIC_ALPHA * ELASTIC_L1_RATIO}, 0) / (1 + {ELASTIC_ALPHA * (1 - ELASTIC_L1_RATIO)}) AS w
  FROM sums)
SELECT nation, date, y AS actual, round(my + w * z1, 0) AS prediction FROM z JOIN solved USING (nation) WHERE NOT train""",
    "ml_ridge_cv_keys": f"WITH {KEYED},\n{LEFT_OUT}\n{ACTUAL} ridge",
    "ml_status_keys": f"""WITH {CUSTOMER_MONTH},
lengths AS (SELECT customer, greatest(count(*) - 2, 0) > 3 AS fits FROM customer_month GROUP BY customer)
SELECT model, CASE WHEN fits THEN 'trained' ELSE 'skipped: Not enough supervised rows for test_size=3.' END AS status, fits AS scored, count(*) AS customers
FROM lengths, (SELECT unnest(['ridge_lagged', 'elasticnet_lagged']) AS model) GROUP BY ALL""",
    "ml_tree_keys": f"WITH {FRAME},\n{boosting_sql(1, 1.0, 1)}\n{ACTUAL} boosting",
    "ml_tree_depth2_keys": f"WITH {FRAME},\n{boosting_sql(1, 1.0, 2, 3)}\n{ACTUAL} boosting",
    "ml_forest": f"WITH {FRAME},\n{forest_sql(**SMALL_FOREST)}\n{ACTUAL} forest",
    "ml_gbt": f"WITH {FRAME},\n{boosting_sql(**SMALL_BOOSTING)}\n{ACTUAL} boosting",
    "ml_holdout": f"""WITH {KEYED},
{LEFT_OUT},
{forest_sql(**SMALL_FOREST)},
{boosting_sql(**SMALL_BOOSTING)}
SELECT nation, date, r.y AS revenue, round(r.prediction, 0) AS pred_ridge, round(f.prediction, 0) AS pred_random_forest,
       round(b.prediction, 0) AS pred_gradient_boosting
FROM ridge r JOIN forest f USING (nation, date) JOIN boosting b USING (nation, date)""",
}

QUERIES = {f.__name__: (f, SQL[f.__name__]) for f in (
    ml_ridge, ml_elasticnet, ml_ridge_cv, ml_ridge_keys, ml_elasticnet_keys, ml_ridge_cv_keys, ml_status_keys, ml_tree_keys, ml_tree_depth2_keys,
    ml_forest, ml_gbt, ml_holdout,
)}
