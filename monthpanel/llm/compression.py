"""Quality classifier by compression.

Two zstandard dictionaries are trained, on good and on bad labelled text. A text is compressed with each, in blocks of
``BLOCK`` bytes so that its end counts as much as its beginning, and the difference of the two sizes over its length is turned
into a probability by a logistic curve fitted on labelled documents that trained no dictionary. As short texts tell little, the
curve is weighed by ``n / (n + pull)`` for ``n`` bytes, and the share of good labels has the rest of the weight.

Fit on bounded samples: the dictionaries on ``BLOCKS`` blocks of each label, from at most ``DOCS`` documents of each label (the
smallest by a hash), half of which calibrate the curve. Only rows whose id leaves no remainder 2 are learned from.
Scoring is one pass over all rows, in Arrow batches, and shuffles nothing; a text is read block by block.

Nulls and empty texts score the share of good labels. Labels that are null are ignored, repeated ones averaged.
Without labels of both kinds every score is the share of good labels (1 without labels). Rows that repeat score alike.
Empty tables give no rows. ``score_quality`` keeps all columns; its ``score`` replaces one of that name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of
from monthpanel.llm.shared import id_remainder, stored, table

DOCS, BLOCKS, BLOCK, DICTIONARY, LEVEL, THRESHOLD = 3000, 2000, 4096, 300_000, 3, 0.7
#: The lengths at which curve and share of good labels weigh alike, of which the likeliest is chosen.
PULLS = (0, 30, 100, 300, 1000, 3000)


@dataclass(frozen=True)
class Model:
    """Dictionaries of both labels; log odds are ``slope * difference + offset`` for long texts, ``prior`` for short ones."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0
    prior: float = 0.0
    pull: int = 0


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def differences(good: bytes, bad: bytes) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Function of Arrow batches: compressed size with the bad dictionary less that with the good one, over the length."""

    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = []
        for content in (bad, good):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False))
        with_bad, with_good = (coder.compress for coder in coders)
        for batch in batches:
            data, offsets = bytes_of(batch)
            view, out = memoryview(data), np.zeros(len(batch))
            for k, (begin, end) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                total = 0
                for at in range(begin, end, BLOCK):
                    block = view[at : min(end, at + BLOCK)]
                    total += len(with_bad(block)) - len(with_good(block))
                out[k] = total / (end - begin) if end > begin else 0.0
            yield pa.array(out)

    return measure


def fit_curve(x: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[float, float, int]:
    """Slope, offset and pull of the likeliest logistic curve, lightly held back, by Newton's method on a scaled ``x``."""
    scale, prior, found = float(np.std(x)) or 1.0, _log_odds(good.mean()), []
    for pull in PULLS:
        weight = n / np.maximum(1, n + pull)
        rows, beta = np.column_stack([weight * x / scale, weight]), np.zeros(2)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(rows @ beta + (1 - weight) * prior, -30, 30)))
            gradient = rows.T @ (good - p) - np.array([0.1, 0.0]) * beta
            hessian = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([0.1, 1e-6])
            step = np.linalg.solve(hessian, gradient)
            beta = beta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        p = np.clip(1 / (1 + np.exp(-np.clip(rows @ beta + (1 - weight) * prior, -30, 30))), 1e-9, 1 - 1e-9)
        found.append((float(-(good * np.log(p) + (1 - good) * np.log(1 - p)).mean()), pull, beta))
    _, pull, beta = min(found, key=lambda f: f[:2])
    return float(beta[0] / scale), float(beta[1]), pull


def _log_odds(share: float) -> float:
    return math.log(max(share, 1e-9) / max(1 - share, 1e-9))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Dictionaries and curve from labelled documents whose id leaves no remainder 2."""
    votes = labels.where(F.col(label_col).isNotNull() & (id_remainder(F.col(id_col), 4) != 2)).groupBy(F.col(id_col).alias("id")).agg(
        (F.avg(label_col) >= 0.5).alias("good")
    )
    some = [votes.where(F.col("good") == kind).orderBy(F.xxhash64("id"), "id").limit(DOCS) for kind in (True, False)]
    sample = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(some[0].unionAll(some[1])), "id"
    ).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(2)))
    sample = stored(sample, "labelled")
    data = F.col("text").cast("binary")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length("text")), F.lit(BLOCK))
    blocks = sample.where("fold = 0").select("id", "good", data.alias("data"), F.explode(starts).alias("at")).select(
        "id", "good", "at", F.expr(f"substring(data, at, {BLOCK})").alias("block")
    )
    samples = {
        kind: [bytes(r.block) for r in blocks.where(F.col("good") == kind).orderBy(F.xxhash64("id", "at"), "id", "at").limit(BLOCKS).collect()]
        for kind in (True, False)
    }
    counts = {r.good: r.n for r in votes.groupBy("good").agg(F.count("*").alias("n")).collect()}
    share = counts.get(True, 0) / sum(counts.values()) if counts else 1.0
    flat = Model(prior=_log_odds(share))
    if not samples[True] or not samples[False]:
        return flat
    model = Model(train_dictionary(samples[True]), train_dictionary(samples[False]))
    measured = sample.where("fold = 1").select("good", F.octet_length("text").alias("n"), _difference(model, F.col("text")).alias("x"))
    measured = measured.limit(2 * DOCS).toPandas()
    if measured["good"].nunique() < 2:
        return flat
    # The rarer label may have more than its share of the sample; the offset brings back the share in all labels.
    good = measured["good"].to_numpy(float)
    slope, offset, pull = fit_curve(measured["x"].to_numpy(float), measured["n"].to_numpy(float), good)
    return Model(model.good, model.bad, slope, offset + flat.prior - _log_odds(good.mean()), flat.prior, pull)


def _difference(model: Model, text: Column) -> Column:
    return F.arrow_udf(differences(model.good, model.bad), "double")(F.coalesce(text, F.lit("")))


def score_quality(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score``, the probability of a good label."""
    if not model.good:
        return docs.withColumn("score", F.lit(1 / (1 + math.exp(-model.prior))))
    length = F.coalesce(F.octet_length(text_col), F.lit(0))
    weight = length / F.greatest(F.lit(1), length + model.pull)
    curve = weight * (F.lit(model.slope) * _difference(model, F.col(text_col)) + F.lit(model.offset)) + (1 - weight) * F.lit(model.prior)
    return docs.withColumn("score", F.lit(1.0) / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), curve)))))


def op7_compression_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_compression_quality": (op7_compression_quality, None)}
