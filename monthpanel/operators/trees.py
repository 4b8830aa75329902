"""Regression trees, forests and boosting for all keys at once, grown level by level.

A level is one aggregation: rows are counted by (key, tree, node, feature, bin), running sums over a feature's bins give every split, and the best of
a node is kept. Only these split tables, a row for each node, are stored and meet the rows again, in one join by key in which a row walks
down its trees; so rows are written once with their bins, whatever depth and number of trees. Boosting updates its residuals in each round and stores
them every ``KEEP`` rounds.

Bins are ``BINS`` quantiles of a key's train values. A feature with up to that many train rows has a bin for each value, so splits are those of an
exact search, half-way between neighbouring values of the node. The best split has the largest share of the node's squared error removed; shares that
agree to nine digits are ties, which go to the first feature and then the lowest threshold. Rows of the test walk along with weight 0.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.operators.moments import join_by_key, with_key
from monthpanel.sources.tables import new_folder, stored_at

BINS, KEEP = 256, 5
#: A weight of n needs a uniform of at least the n-th of these: a Poisson distribution of mean 1, as copies in a bootstrap have.
POISSON = [sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(12)]


def binned(rows: DataFrame, features: list[str], target: str, keys: list[str]) -> DataFrame:
    """``keys, date, part, y, mean`` (of the key's train), ``xs`` and ``bins`` of marked rows; features must not be null."""
    probs = [i / BINS for i in range(1, BINS)]
    train = F.col("part") == "train"
    edges = rows.groupBy(*keys).agg(
        F.avg(F.when(train, F.col(target))).alias("mean"),
        F.array(*[F.array_sort(F.array_distinct(F.percentile_approx(F.when(train, F.col(c).cast("double")), probs, 100_000))) for c in features]).alias("edges"),
    )
    xs = F.array(*[F.col(c).cast("double") for c in features])
    bins = F.transform(F.arrays_zip("edges", "xs"), lambda z: F.size(F.filter(z["edges"], lambda e: e < z["xs"])))
    return join_by_key(rows.select(*keys, "date", "part", F.col(target).cast("double").alias("y"), xs.alias("xs")), edges, keys).withColumn("bins", bins).drop("edges")


def walked(rows: DataFrame, splits: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows (with ``tree``) at the node and value that the split tables lead them to; ``value`` starts as the row has it."""
    if not splits:
        return rows.withColumn("node", F.lit(1))
    nodes = reduce(DataFrame.unionByName, splits).groupBy(*keys, "tree").agg(
        F.map_from_entries(F.collect_list(F.struct("node", F.struct("feature", "threshold", "left", "right")))).alias("__nodes")
    )
    placed = join_by_key(rows, nodes, [*keys, "tree"], "left").withColumn("node", F.lit(1))
    for _ in splits:
        at = F.try_element_at("__nodes", F.col("node"))
        placed = placed.withColumn("__at", at).withColumn("__right", F.get("xs", F.col("__at.feature")) > F.col("__at.threshold"))
        moved = F.col("__at").isNotNull()
        placed = placed.withColumns({
            "value": F.when(moved, F.when(F.col("__right"), F.col("__at.right")).otherwise(F.col("__at.left"))).otherwise(F.col("value")),
            "node": F.when(moved, 2 * F.col("node") + F.col("__right").cast("int")).otherwise(F.col("node")),
        })
    return placed.drop("__nodes", "__at", "__right")


def best_splits(placed: DataFrame, keys: list[str], level: int, min_leaf: int) -> DataFrame:
    """The best split of each node of a level: ``keys, tree, node, feature, threshold, left, right`` (means of ``t`` on both sides)."""
    node = [*keys, "tree", "node"]
    here = placed.where((F.col("w") > 0) & (F.col("node") >= 2**level))
    long = here.select(*node, "w", "t", F.posexplode(F.arrays_zip("xs", "bins")).alias("feature", "z"))
    counted = long.groupBy(*node, "feature", F.col("z.bins").alias("bin")).agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("t")).alias("s"), F.sum(F.col("w") * F.col("t") * F.col("t")).alias("q"),
        F.min("z.xs").alias("low"), F.max("z.xs").alias("high"),
    )
    whole = Window.partitionBy(*node, "feature")
    along = whole.orderBy("bin")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    scanned = counted.select(
        *node, "feature", "high", F.lead("low").over(along).alias("next"), F.sum("w").over(so_far).alias("wl"), F.sum("s").over(so_far).alias("sl"),
        F.sum("w").over(whole).alias("wt"), F.sum("s").over(whole).alias("st"), F.sum("q").over(whole).alias("qt"),
    ).where("next is not null").withColumns({"wr": F.col("wt") - F.col("wl"), "sr": F.col("st") - F.col("sl"), "error": F.col("qt") - F.col("st") * F.col("st") / F.col("wt")})
    fit = scanned.where((F.col("wl") >= min_leaf) & (F.col("wr") >= min_leaf) & (F.col("error") > 0))
    gain = F.col("sl") * F.col("sl") / F.col("wl") + F.col("sr") * F.col("sr") / F.col("wr") - F.col("st") * F.col("st") / F.col("wt")
    split = F.struct("feature", ((F.col("high") + F.col("next")) / 2).alias("threshold"), (F.col("sl") / F.col("wl")).alias("left"), (F.col("sr") / F.col("wr")).alias("right"))
    ranked = fit.withColumns({"share": F.round(gain / F.col("error"), 9), "split": split}).where("share > 0")
    best = ranked.groupBy(*node).agg(F.max_by("split", F.struct("share", -F.col("feature"), -F.col("split.threshold"))).alias("split"))
    return best.select(*node, "split.*")


def grow(rows: DataFrame, keys: list[str], depth: int, min_leaf: int, folder: str) -> list[DataFrame]:
    """Split tables of a tree per key and ``tree``, one for each level; rows have ``tree, w, t, value, xs, bins``."""
    splits: list[DataFrame] = []
    for level in range(depth):
        splits.append(stored_at(best_splits(walked(rows, splits, keys), keys, level, min_leaf), f"{folder}/level-{level}"))
    return splits


def bootstrap_weight(seed: int, tree: Column, keys: list[str]) -> Column:
    """How often a row is drawn for a tree: a Poisson count at a uniform hashed from seed, tree, keys and month."""
    name = F.concat_ws("|", F.lit(str(seed)), tree.cast("string"), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.col("date").cast("string"))
    uniform = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    return F.array_position(F.transform(F.array(*[F.lit(p) for p in [*POISSON, 1.0]]), lambda p: uniform < p), True) - 1


def forest(marked: DataFrame, features: list[str], target: str, keys: list[str] = (), trees: int = 250, depth: int = 6, min_leaf: int = 3,
           seed: int = 42, folder: str | None = None) -> DataFrame:
    """``keys, date, y, prediction`` of the test rows of a marked frame: the mean of trees grown on bootstrap copies of the key's train rows."""
    source, ids = with_key(marked, keys)
    folder = folder or new_folder(marked.sparkSession, "forest")
    rows = stored_at(binned(source, features, target, ids), f"{folder}/rows").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    weight = F.when(F.col("part") == "train", bootstrap_weight(seed, F.col("tree"), list(keys))).otherwise(0)
    drawn = rows.withColumns({"w": weight.cast("double"), "t": F.col("y") - F.col("mean"), "value": F.lit(0.0)})
    root = drawn.groupBy(*ids, "tree").agg(F.try_divide(F.sum(F.col("w") * F.col("t")), F.sum("w")).alias("root"))
    drawn = join_by_key(drawn.drop("value"), root, [*ids, "tree"]).withColumn("value", F.coalesce("root", F.lit(0.0))).drop("root")
    grown = walked(drawn, grow(drawn, ids, depth, min_leaf, folder), ids).where("part = 'test'")
    return grown.groupBy(*ids, "date").agg(F.first("y").alias("y"), (F.first("mean") + F.avg("value")).alias("prediction")).drop(*[k for k in ids if k not in keys])


def boosted(marked: DataFrame, features: list[str], target: str, keys: list[str] = (), rounds: int = 150, step: float = 0.05, depth: int = 2,
            min_leaf: int = 1, folder: str | None = None) -> DataFrame:
    """``keys, date, y, prediction`` of the test rows: the train mean and ``step`` of a tree on the residuals of each round."""
    source, ids = with_key(marked, keys)
    folder = folder or new_folder(marked.sparkSession, "boosted")
    rows = binned(source, features, target, ids).withColumns({
        "tree": F.lit(0), "w": (F.col("part") == "train").cast("double"), "t": F.col("y") - F.col("mean"), "fit": F.col("mean"),
    })
    rows = stored_at(rows, f"{folder}/rows-0")
    for k in range(1, rounds + 1):
        at = rows.withColumn("value", F.lit(0.0))
        after = walked(at, grow(at, ids, depth, min_leaf, f"{folder}/round-{k}"), ids)
        move = F.lit(step) * F.col("value")
        rows = after.withColumns({"fit": F.col("fit") + move, "t": F.col("t") - move}).drop("value", "node")
        if k % KEEP == 0:
            rows = stored_at(rows, f"{folder}/rows-{k}")
    return rows.where("part = 'test'").select(*keys, "date", "y", F.col("fit").alias("prediction"))
