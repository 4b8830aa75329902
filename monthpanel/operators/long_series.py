"""Lags, windows, gap filling and holdout of series too long for one task, such as one series of all rows.

Rows are range-partitioned by keys and order, written once with their place in their file, and numbered from the rows of each file (a small table): so every
row knows its position among all. Windows then run in buckets of equal numbers of rows, whatever the values; the last rows of a bucket are copied
into the next one as a halo as wide as the widest lag or window. What reaches further back, the last value before a gap, comes from a
summary with a row for each bucket and key. So no exchange brings more than a bucket of rows together, also with ``keys=[]``.

Windows are put together from blocks of 1, 8, 64, ... rows, each from eight of the size before, so that a row costs some lags for each of these sizes and
not its whole window. Sums, means and squared deviations are merged without subtracting totals, so nothing cancels out.

``order`` must order the rows of a key fully; rows equal in all its columns are in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

from monthpanel.sources.tables import new_folder, stored_at

BUCKET_ROWS = 1_000_000
#: So many blocks of rows make one of the next size.
BLOCKS = 8
_PLACE = 2**33  # of monotonically increasing ids: the partition above, the row below


def positions(df: DataFrame, order: list[str], keys: list[str] = (), folder: str | None = None) -> DataFrame:
    """Rows with ``__at``, their position from 0 in the order of keys and ``order``; written to ``folder``, or a new one."""
    by = [*keys, *order]
    numbered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    written = stored_at(numbered, folder or new_folder(df.sparkSession, "positions"))
    written = written.withColumn("__run", F.floor(F.col("__id") / _PLACE)).withColumn("__in", F.pmod("__id", F.lit(_PLACE)))
    runs = written.groupBy("__run").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("__run", F.coalesce(before, F.lit(0)).alias("__start"))
    # A row for each partition written, so the rows themselves need no exchange to meet it.
    return written.join(F.broadcast(runs), "__run").withColumn("__at", F.col("__start") + F.col("__in")).drop("__run", "__in", "__id", "__start")


def _haloed(placed: DataFrame, halo: int, rows: int) -> tuple[DataFrame, Callable]:
    """Rows in buckets with the last ``halo`` rows of the bucket before, and the window over a bucket."""
    size = max(rows, halo)
    bucket = F.floor(F.col("__at") / size)
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("halo"))
    copy = F.struct((bucket + 1).alias("bucket"), F.lit(True).alias("halo"))
    both = F.when(F.pmod("__at", F.lit(size)) >= size - halo, F.array(own, copy)).otherwise(F.array(own))
    return placed.select("*", F.inline(both)).withColumnsRenamed({"bucket": "__bucket", "halo": "__halo"}), Window.partitionBy("__bucket").orderBy("__at")


def _same_key(keys: list[str], back: int, window) -> Column:
    """Whether the row so far back is of the same series; without keys any row is."""
    if not keys:
        return F.lit(True)
    then = F.lag(F.struct(F.lit(True).alias("there"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), back).over(window)
    same = then["there"]
    for i, k in enumerate(keys):
        same = same & then[f"k{i}"].eqNullSafe(F.col(k))
    return F.coalesce(same, F.lit(False))


def lag_long(df: DataFrame, columns: list[str], lags: list[int], order: list[str], keys: list[str] = (), rows: int = BUCKET_ROWS,
             folder: str | None = None) -> DataFrame:
    """Add ``<column>_lag_<k>`` as :func:`monthpanel.operators.features.add_lags` does, for series of any length."""
    return features_long(df, {}, {c: lags for c in columns}, order, keys, rows, folder)


def rolling_long(df: DataFrame, columns: list[str], windows: list[int], order: list[str], keys: list[str] = (), rows: int = BUCKET_ROWS,
                 folder: str | None = None) -> DataFrame:
    """Add mean and deviation of the previous n values as :func:`monthpanel.operators.features.add_rolling` does, for series of any length."""
    return features_long(df, {c: windows for c in columns}, {}, order, keys, rows, folder)


def features_long(df: DataFrame, windows: dict[str, list[int]], lags: dict[str, list[int]], order: list[str], keys: list[str] = (),
                  rows: int = BUCKET_ROWS, folder: str | None = None) -> DataFrame:
    """Windows and lags by column, as :func:`rolling_long` and :func:`lag_long` add them, from one placing of the rows."""
    if any(k <= 0 for own in lags.values() for k in own):
        raise ValueError("a lag is at least one row")
    if any(n <= 1 for own in windows.values() for n in own):
        raise ValueError("a rolling window spans at least two rows")
    far = max((n for own in (*windows.values(), *lags.values()) for n in own), default=0)
    buckets, window = _haloed(positions(df, order, keys, folder), far, rows)
    # Decimals have exact means, which plain windows give.
    plain = {c for c in windows if not _is_double(df, c)}
    buckets, totals = _in_blocks(buckets, {c: own for c, own in windows.items() if c not in plain}, window)
    made = []
    for c, own in windows.items():
        for n in own:
            past = window.rowsBetween(-n, -1)
            full = _same_key(keys, n, window)
            if c in plain:
                full, mean, deviation = full & (F.count(c).over(past) == n), F.avg(c).over(past), F.stddev_samp(c).over(past)
            else:
                total, squares = totals[c, n]
                mean, deviation = F.col(total) / n, F.sqrt(F.col(squares) / (n - 1))
            made.append(F.when(full, mean).alias(f"{c}_roll_mean_{n}"))
            made.append(F.when(full, deviation).alias(f"{c}_roll_std_{n}"))
    made += [F.when(_same_key(keys, k, window), F.lag(c, k).over(window)).alias(f"{c}_lag_{k}") for c, own in lags.items() for k in own]
    return buckets.select(*df.columns, "__halo", *made).where(~F.col("__halo")).drop("__halo")


def _is_double(df: DataFrame, column: str) -> bool:
    """Whether means of the column are made in doubles."""
    kind = df.select(column).schema[0].dataType
    return isinstance(kind, NumericType) and not isinstance(kind, DecimalType)


def _in_blocks(buckets: DataFrame, windows: dict[str, list[int]], window) -> tuple[DataFrame, dict[tuple, tuple[str, str]]]:
    """Add sum and squared deviations of the previous n rows, null where a row or value is missing; their names by column and n."""
    sizes = [1]
    while sizes[-1] * BLOCKS <= max((n for own in windows.values() for n in own), default=0):
        sizes.append(sizes[-1] * BLOCKS)
    made, given = buckets, {f"__c{i}_1": c for i, c in enumerate(windows)}
    blocks = {f"__c{i}_1": (1, f"__c{i}_1", f"__c{i}_1", None) for i in range(len(windows))}
    for small, size in zip(sizes, sizes[1:]):
        wanted = {f"__c{i}_{size}": [(blocks[f"__c{i}_{small}"], k * small) for k in range(BLOCKS)]
                  for i, own in enumerate(windows.values()) if max(own, default=0) >= size}
        made, found = _merged(made, wanted, given, window)
        blocks |= found
    wanted = {}
    for i, own in enumerate(windows.values()):
        for n in own:
            parts, back = [], 1
            for size in sizes:
                for _ in range((n + 1 - back) % (size * BLOCKS) // size):
                    parts.append((blocks[f"__c{i}_{size}"], back))
                    back += size
            wanted[f"__w{i}_{n}"] = parts
    made, found = _merged(made, wanted, given, window)
    return made, {(c, n): found[f"__w{i}_{n}"][1::2] for i, (c, own) in enumerate(windows.items()) for n in own}


def _merged(df: DataFrame, wanted: dict[str, list[tuple]], given: dict[str, str], window) -> tuple[DataFrame, dict[str, tuple]]:
    """Add blocks of rows, each put together from ``(block, rows back)``; a block is its rows and the names of sum, mean and squared deviations.

    ``given`` has the columns behind blocks of one row; they are cast after the exchange, so that it brings none of them twice.
    """
    backs = {(name, back) for parts in wanted.values() for block, back in parts for name in block[1:] if name and back}
    df = df.withColumns({f"{name}_{back}": F.lag(given.get(name, name), back).over(window) for name, back in sorted(backs) if f"{name}_{back}" not in df.columns})

    def then(name: str, back: int) -> Column:
        found = F.col(f"{name}_{back}" if back else given.get(name, name))
        return found.cast("double") if name in given else found

    made, sums, means, squares = {}, {}, {}, {}
    for name, parts in wanted.items():
        made[name] = rows, total, mean, square = sum(block[0] for block, _ in parts), f"{name}_sum", f"{name}_mean", f"{name}_sq"
        # Means are counted from one of them, so that equal values deviate by nothing.
        first = then(parts[0][0][2], parts[0][1])
        sums[total] = reduce(add, (then(block[1], back) for block, back in parts), F.lit(0.0))  # no sum is a negative zero
        means[mean] = first + reduce(add, ((then(block[2], back) - first) * block[0] for block, back in parts)) / rows
        apart = [(then(block[2], back) - F.col(mean), block[0]) for block, back in parts]
        squares[square] = reduce(add, (*(d * d * n for d, n in apart), *(then(block[3], back) for block, back in parts if block[3])))
    return df.withColumns(sums | means).withColumns(squares), made


def _around(by: str, keys: list[str]) -> tuple:
    """The windows of the rows before a row and of those after it, nearest last.

    Both grow by a row at a time. A window up to the last row is counted anew for every row, the square of a bucket's rows.
    """
    own = Window.partitionBy(*keys)
    return tuple(own.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc(by), F.desc(by)))


def _carried(placed: DataFrame, columns: list[str], keys: list[str], rows: int) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    """Rows in buckets, and of each column the last present ``(at, v)`` before a row and the first after it, in the row's series."""
    buckets = placed.withColumn("__bucket", F.floor(F.col("__at") / rows))
    points = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("__at").alias("at"), F.col(c).alias("v"))) for c in columns}
    ends = []
    for i, c in enumerate(columns):
        there = F.when(F.col(c).isNotNull(), F.col("__at"))
        for name, edge, value in (("first", F.min, F.min_by), ("last", F.max, F.max_by)):
            point = F.struct(edge(there).alias("at"), value(F.col(c), there).alias("v"))
            ends.append(F.when(F.count(F.col(c)) > 0, point).alias(f"{name}{i}"))
    summary = buckets.groupBy("__bucket", *keys).agg(*ends)
    earlier, later = _around("__bucket", keys)
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    summary = summary.select(
        F.col("__bucket").alias("__of"), *[F.col(k).alias(n) for k, n in names.items()],
        *[F.last(f"last{i}", ignorenulls=True).over(earlier).alias(f"__before{i}") for i in range(len(columns))],
        *[F.last(f"first{i}", ignorenulls=True).over(later).alias(f"__after{i}") for i in range(len(columns))],
    )
    on = F.col("__bucket") == F.col("__of")
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    joined = buckets.join(summary, on)
    before, after = _around("__at", ["__bucket", *keys])
    found = {
        c: (F.coalesce(F.last(points[c], ignorenulls=True).over(before), F.col(f"__before{i}")),
            F.coalesce(F.last(points[c], ignorenulls=True).over(after), F.col(f"__after{i}")))
        for i, c in enumerate(columns)
    }
    return joined, found


def interpolate_long(df: DataFrame, columns: list[str], order: list[str], keys: list[str] = (), rows: int = BUCKET_ROWS,
                     folder: str | None = None) -> DataFrame:
    """Fill gaps between two observations linearly by row, for series of any length; ends stay empty."""
    joined, found = _carried(positions(df, order, keys, folder), columns, list(keys), rows)

    def filled(c: str) -> Column:
        left, right = found[c]
        share = (F.col("__at") - left["at"]) / (right["at"] - left["at"])
        return F.coalesce(F.col(c), left["v"] + share * (right["v"] - left["v"])).alias(c)

    return joined.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def fill_forward_long(df: DataFrame, columns: list[str], order: list[str], keys: list[str] = (), rows: int = BUCKET_ROWS,
                      folder: str | None = None) -> DataFrame:
    """Fill empty values with the last one before them, for series of any length."""
    joined, found = _carried(positions(df, order, keys, folder), columns, list(keys), rows)
    return joined.select(*[F.coalesce(F.col(c), found[c][0]["v"]).alias(c) if c in columns else F.col(c) for c in df.columns])


def holdout_long(df: DataFrame, test_size: int, order: list[str], keys: list[str] = (), folder: str | None = None) -> DataFrame:
    """Add ``part, step, train_rows`` as :func:`monthpanel.operators.baselines.mark_holdout` does, for series of any length."""
    if test_size <= 0:
        raise ValueError("test_size must be positive")
    placed = positions(df, order, keys, folder)
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    sizes = placed.groupBy(*keys).agg(F.min("__at").alias("__first"), (F.count("*") - test_size).cast("int").alias("train_rows"))
    if keys:
        on = F.lit(True)
        for k, n in names.items():
            on = on & F.col(k).eqNullSafe(F.col(n))
        placed = placed.join(sizes.withColumnsRenamed(names), on).drop(*names.values())
    else:
        one = sizes.first()
        placed = placed.withColumns({"__first": F.lit(one["__first"]), "train_rows": F.lit(one["train_rows"])})
    step = F.col("__at") - F.col("__first") + 1 - F.col("train_rows")
    return placed.select(*df.columns, F.when(step > 0, "test").otherwise("train").alias("part"), step.cast("int").alias("step"), "train_rows")
