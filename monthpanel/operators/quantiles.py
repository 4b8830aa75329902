"""Exact quantiles of groups of any size, by radix selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthpanel.sources.tables import new_folder, stored_at

# A round fixes two digits of 8 bits of the wanted values; 64 bits take four rounds.
DIGIT, ROUNDS = 256, 4
_FRACTION, _LEAST_NORMAL = float(2**52), 2.0**-1022


def image_of(v: Column) -> Column:
    """A 64-bit integer that orders as the double does: the bits of its size, negative for negative values; NaN is the largest."""
    size = F.abs(v)
    guess = F.floor(F.log2(size))
    low = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).otherwise(guess)
    power = F.when(size / F.pow(F.lit(2.0), low) >= 2, low + 1).otherwise(low)
    normal = (power + 1023) * F.lit(2**52) + ((size / F.pow(F.lit(2.0), power) - 1) * _FRACTION).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(2047 * 2**52))
        .when(size < _LEAST_NORMAL, (size * 2.0**537 * 2.0**537).cast("long")).otherwise(normal)
    )
    return F.when(F.isnan(v), F.lit(2**63 - 1)).otherwise(F.when(v < 0, -bits).otherwise(bits))


def value_of(image: Column) -> Column:
    """The double of an image, exactly."""
    bits = F.abs(image)
    power, rest = F.shiftright(bits, 52), F.pmod(bits, F.lit(2**52)).cast("double")
    size = (
        F.when(power == 0, rest * 2.0**-537 * 2.0**-537).when(power == 2047, F.lit(float("inf")))
        .otherwise((1 + rest / _FRACTION) * F.pow(F.lit(2.0), power - 1023))
    )
    return F.when(image == 2**63 - 1, F.lit(float("nan"))).otherwise(F.when(image < 0, -size).otherwise(size))


def _ranks(n: Column, probs: list[float]) -> Column:
    """The ranks, from 0, between which the quantiles lie."""
    places = [F.lit(p) * (n - 1) for p in probs]
    return F.array_distinct(F.array(*[f(p).cast("long") for p in places for f in (F.floor, F.ceil)]))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] = (), folder: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles per key as ``keys, n, quantiles`` (an array in ``probs`` order).

    Values become 64-bit integers of the same order. A round counts the next 16 bits of the values that agree with a wanted rank so far, in
    partial sums, and takes the rank's bucket; after four rounds the bits are the value. Nothing is sorted but the counts of a digit,
    at most 256 rows of a group, and no exchange has more of a group than its counts. The integers are worked out and written once, to ``folder`` or a
    new one, and so are the prefixes still wanted after a round: as their size is known, rows meet few of them without an exchange, and many in a
    join that adaptive execution splits where a group is large.
    """
    ids = list(keys)
    folder = folder or new_folder(df.sparkSession, "quantiles")
    v = F.col(value).cast("double")
    # Image and digits as of an unsigned integer: the sign bit flipped.
    rows = stored_at(df.where(v.isNotNull()).select(*keys, image_of(v).bitwiseXOR(F.lit(-(2**63))).alias("__u")), f"{folder}/rows")
    wanted = None
    for k in range(ROUNDS):
        shift = 64 - 16 * (k + 1)
        two = F.shiftrightunsigned("__u", shift).bitwiseAND(F.lit(DIGIT * DIGIT - 1))
        if wanted is None:
            here = rows.withColumns({"__prefix": F.lit(0).cast("long"), "__n": F.lit(0).cast("long"), "__wanted": F.array().cast("array<struct<rank:bigint,left:bigint>>")})
        else:
            prefix = F.shiftrightunsigned("__u", shift + 16)
            on = [F.col(f"w.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ids] + [F.col("w.__prefix") == F.col("r.__prefix")]
            joined = rows.withColumn("__prefix", prefix).alias("r").join(wanted.alias("w"), on)
            here = joined.select(*[F.col(f"r.{c}").alias(c) for c in ids], "__u", F.col("w.__prefix").alias("__prefix"), "__n", "__wanted")
        group = [*ids, "__prefix", "__n", "__wanted"]
        counts = here.groupBy(*group, F.floor(two / DIGIT).alias("__high"), F.pmod(two, F.lit(DIGIT)).alias("__low")).agg(F.count("*").alias("c"))
        highs = counts.groupBy(*group, "__high").agg(F.sum("c").alias("c"), F.collect_list(F.struct(F.col("__low").alias("low"), "c")).alias("lows"))
        in_group = Window.partitionBy(*ids, "__prefix")
        highs = highs.withColumn("before", F.sum("c").over(in_group.orderBy("__high")) - F.col("c"))
        if wanted is None:
            highs = highs.withColumn("__n", F.sum("c").over(in_group))
            highs = highs.withColumn("__wanted", F.transform(_ranks(F.col("__n"), probs), lambda r: F.struct(r.alias("rank"), r.alias("left"))))
        own = F.filter("__wanted", lambda w: (w["left"] >= F.col("before")) & (w["left"] < F.col("before") + F.col("c")))
        chosen = highs.withColumn("__wanted", F.transform(own, lambda w: F.struct(w["rank"].alias("rank"), (w["left"] - F.col("before")).alias("left")))).where(F.size("__wanted") > 0)
        lows = chosen.select(*ids, "__prefix", "__n", "__high", "__wanted", F.inline("lows"))
        below = F.sum("c").over(Window.partitionBy(*ids, "__prefix", "__high").orderBy("low")) - F.col("c")
        lows = lows.withColumn("before", below)
        longer = F.shiftleft("__prefix", 16).bitwiseOR((F.col("__high") * DIGIT + F.col("low")).cast("long"))
        own = F.filter("__wanted", lambda w: (w["left"] >= F.col("before")) & (w["left"] < F.col("before") + F.col("c")))
        left = F.transform(own, lambda w: F.struct(w["rank"].alias("rank"), (w["left"] - F.col("before")).alias("left")))
        wanted = stored_at(lows.select(*ids, longer.alias("__prefix"), "__n", left.alias("__wanted")).where(F.size("__wanted") > 0), f"{folder}/wanted-{k}")
    found = wanted.withColumn("v", value_of(F.col("__prefix").bitwiseXOR(F.lit(-(2**63))))).select(*ids, "__n", "v", F.explode("__wanted.rank").alias("rank"))
    by_rank = found.groupBy(*ids, "__n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def quantile(p: float) -> Column:
        place = F.lit(p) * (F.col("__n") - 1)
        first, last = (F.element_at("at", f(place).cast("long")) for f in (F.floor, F.ceil))
        return first + (last - first) * (place - F.floor(place))

    return by_rank.select(*keys, F.col("__n").alias("n"), F.array(*[quantile(p) for p in probs]).alias("quantiles"))
