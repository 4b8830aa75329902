"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source with ``n`` of ``N`` documents and the target share ``w`` has the mean repetition rate ``total * w / n``. Each
document draws its number of copies by inverting a Poisson distribution with that mean at a uniform number made from a
hash of the seed and its id, so a rerun after a lost executor draws the same. Large rates are the sum of several
draws with a mean of at most ``STEP`` each, which is the same distribution. Copies are then dealt over all partitions
by a hash of id and copy and sorted by it, a global shuffle in which a hot source or document spreads.

Only the rates, one row per source, are joined; the plan broadcasts them when they are measured small, and splits the
hot source otherwise.

Nulls: null sources are one source; a null id draws by its text. Rows that repeat an id draw the same number. Sources that
``weights`` doesn't name have weight 0. An empty table gives no rows. Columns of the input stay, whatever their names; only ``copy``,
``n_copies`` and ``shuffle_key`` replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.shared import free_names, stored, table

SEED, ALPHA, STEP = 17, 0.5, 16


def _uniform(key: Column) -> Column:
    """Number in [0, 1) of the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates(docs: DataFrame, source_col: str = "source", weights: dict[str, float] | None = None, alpha: float = ALPHA,
          total: int | None = None) -> DataFrame:
    """Per source: documents, target weight and mean repetitions. Without ``weights`` shares are the counts to the power ``alpha``."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    wanted = F.pow(F.col("n").cast("double"), F.lit(alpha))
    if weights is not None:
        wanted = F.coalesce(*[F.when(F.col("source") == k, F.lit(float(v))) for k, v in weights.items()], F.lit(0.0))
    counts = stored(counts.withColumn("wanted", wanted), "rates")
    sums = counts.agg(F.sum("wanted").alias("all_wanted"), F.sum("n").alias("all_n")).first()
    size = float(total if total is not None else sums["all_n"] or 0)
    weight = F.col("wanted") / F.lit(float(sums["all_wanted"] or 1.0))
    return counts.select("source", "n", weight.alias("weight"), (F.lit(size) * weight / F.col("n")).alias("rate"))


def replicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: dict[str, float] | None = None, alpha: float = ALPHA, total: int | None = None,
              seed: int = SEED) -> DataFrame:
    """Each document as often as it draws, in shuffled order."""
    names = free_names(docs, "drawn_source", "draws", "cdf", "own")
    of, draws, cdf, own = names
    drawn = rates(docs, source_col, weights, alpha, total).select(
        F.col("source").alias(of), F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int").alias(draws),
        (F.col("rate") / F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP))).alias("_mean"),
    )
    # Cumulative probabilities of 0, 1, 2 ... copies; beyond the last one no double below 1 is left.
    terms = F.expr(
        "aggregate(sequence(1, cast(ceil(_mean + 10 * sqrt(_mean) + 30) as int)),"
        " named_struct('term', exp(-_mean), 'total', exp(-_mean), 'cdf', array(exp(-_mean))),"
        " (a, k) -> named_struct('term', a.term * _mean / k, 'total', a.total + a.term * _mean / k,"
        " 'cdf', concat(a.cdf, array(a.total + a.term * _mean / k))), a -> a.cdf)"
    )
    drawn = drawn.withColumn(cdf, terms).drop("_mean")
    seeded = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    joined = docs.drop("copy", "n_copies", "shuffle_key").withColumn(own, seeded).join(
        drawn, F.col(source_col).eqNullSafe(F.col(of))
    )
    uniforms = F.transform(F.sequence(F.lit(1), F.col(draws)), lambda draw: _uniform(F.concat_ws("|", F.lit(seed), F.col(own), draw)))
    number = F.aggregate(uniforms, F.lit(0), lambda sum_, u: sum_ + F.size(F.filter(cdf, lambda p: p <= u)))
    copies = joined.withColumn("n_copies", number).where("n_copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))
    )
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col(own), F.col("copy"))))
    return keyed.drop(*names).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op9_source_mix(spark, sf_dir):
    return replicate(table(spark, sf_dir, "documents"))


MIX_SQL = """counts AS (SELECT source, count(*) AS n, sqrt(count(*)) AS wanted FROM {docs} GROUP BY source),
rates AS (SELECT source, sum(n) OVER () * (wanted / sum(wanted) OVER ()) / n AS rate FROM counts),
drawn AS (
  SELECT source, greatest(1, ceil(rate / 16))::INT AS draws, rate / greatest(1, ceil(rate / 16)) AS mean FROM rates),
terms AS (
  SELECT source, mean, k, exp(-mean) * CASE WHEN k = 0 THEN 1 ELSE
         list_product(list_transform(range(1, k + 1), lambda j: mean / j)) END AS p
  FROM drawn, range(0, 101) AS t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
tables AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM cdf GROUP BY source),
uniforms AS (
  SELECT doc_id, source, j,
         ('0x' || substr(md5('17|' || doc_id || '|' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM (SELECT doc_id, source, unnest(range(1, draws + 1)) AS j FROM {docs} JOIN drawn USING (source))),
numbers AS (
  SELECT doc_id, sum(len(list_filter(cdf, lambda c: c <= u)))::BIGINT AS n_copies
  FROM uniforms JOIN tables USING (source) GROUP BY doc_id),
mixed AS (
  SELECT d.*, n_copies, unnest(range(1, n_copies + 1)) AS copy FROM {docs} d JOIN numbers USING (doc_id))"""
MIX_SELECT = """SELECT * EXCLUDE (n_copies, copy), n_copies::INT AS n_copies, copy::INT AS copy,
  md5('17|order|' || doc_id || '|' || copy) AS shuffle_key FROM mixed"""
SQL = f"WITH {MIX_SQL.format(docs='documents')}\n{MIX_SELECT}"

QUERIES = {"op9_source_mix": (op9_source_mix, SQL)}
