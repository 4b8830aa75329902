"""Sums of lagged pairs of many columns with one target, as arrays over lags that are updated row batch by row batch.

Rows come sorted by key and date. For each lag the columns are shifted against the target once for a whole batch, and the sums of all keys in it are
taken together; of the batch before only the last rows and the sums of its last key are kept. So a key may be of any length, no
row is repeated for a lag, and memory is bounded by a batch and (columns x lags) sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SUMS = ("n", "x", "y", "xx", "yy", "xy")
# A variance under this share of the squares is taken for rounding of a constant.
ROUNDING = 1e-12


def _segments(batch: pa.RecordBatch, keys: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """Where each key begins in a batch sorted by key, and the keys."""
    n = batch.num_rows
    if not keys:
        return np.array([0]), [()]
    changed = np.zeros(n, bool)
    changed[0] = True
    for k in keys:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        changed[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(changed)
    return starts, list(zip(*[batch.column(k).take(pa.array(starts)).to_pylist() for k in keys]))


def _first_present(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each segment and column the first value that is present, else 0."""
    places = np.where(np.isnan(values), len(values), np.arange(len(values))[:, None])
    first = np.minimum.reduceat(places, starts, axis=0)
    padded = np.vstack([values, np.zeros(values.shape[1])])
    return padded[first, np.arange(values.shape[1])]


def correlations(keys: list[str], features: list[str], lags: int, least: int) -> Callable:
    """Function of Arrow batches with ``keys, __target, v0..``: rows ``keys, feature, lag, correlation, abs_correlation, observations``."""

    def rows(schema: pa.Schema, done: list[tuple], sums: np.ndarray) -> pa.RecordBatch:
        """``sums`` by key, sum, column and lag."""
        n, x, y, xx, yy, xy = (sums[:, i] for i in range(len(SUMS)))
        with np.errstate(all="ignore"):
            vx, vy = xx - x * x / n, yy - y * y / n
            r = (xy - x * y / n) / np.sqrt(vx * vy)
            fine = (n >= least) & (n > 0) & (vx > ROUNDING * xx) & (vy > ROUNDING * yy) & np.isfinite(r)
        key, feature, lag = np.nonzero(fine)
        r, n = r[fine], n[fine].astype(np.int64)
        names = [pa.array([done[k][i] for k in key], schema.field(c).type) for i, c in enumerate(keys)]
        made = [pa.array(np.array(features, object)[feature].tolist(), pa.string()), pa.array((lag + 1).astype(np.int32)), pa.array(r), pa.array(np.abs(r)), pa.array(n)]
        return pa.RecordBatch.from_arrays([*names, *made], names=[*keys, "feature", "lag", "correlation", "abs_correlation", "observations"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, schema = len(features), None
        last, held, tail, base = None, np.zeros((1, len(SUMS), p, lags)), np.zeros((0, p + 1)), None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            values = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ["__target", *(f"v{i}" for i in range(p))]])
            starts, names = _segments(batch, keys)
            going_on = last is not None and names[0] == last
            if last is not None and not going_on:
                yield rows(schema, [last], held)
            if not going_on:
                held, tail, base = np.zeros((1, len(SUMS), p, lags)), np.zeros((0, p + 1)), None
            # Values less the first of their key: sums of squares then lose no digits, and constants sum to 0.
            bases = _first_present(values, starts)
            if base is not None:
                bases[0] = base
            segment = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
            shifted = np.vstack([tail - bases[0], values - bases[segment]])
            owner = np.concatenate([np.zeros(len(tail), np.int64), segment])
            sums = np.zeros((len(starts), len(SUMS), p, lags))
            for k in range(1, min(lags, len(shifted) - 1) + 1):
                at = np.arange(max(k, len(tail)), len(shifted))
                at = at[owner[at] == owner[at - k]]
                if not len(at):
                    continue
                y, x = shifted[at, :1], shifted[at - k, 1:]
                there = ~(np.isnan(y) | np.isnan(x))
                x, y = np.where(there, x, 0.0), np.where(there, y, 0.0)
                begins = np.flatnonzero(np.diff(owner[at], prepend=-1))
                for i, term in enumerate((there.astype(float), x, y, x * x, y * y, x * y)):
                    sums[owner[at[begins]], i, :, k - 1] = np.add.reduceat(term, begins, axis=0)
            sums[0] += held[0]
            if len(names) > 1:
                yield rows(schema, names[:-1], sums[:-1])
            unshifted = np.vstack([tail, values])
            same = owner == len(starts) - 1
            last, held, tail, base = names[-1], sums[-1:], unshifted[same][-lags:], bases[-1]
        if last is not None:
            yield rows(schema, [last], held)

    return run
