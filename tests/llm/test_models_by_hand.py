"""What the fitted models say about single texts, worked out again in plain Python."""

import math
import os

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from monthpanel.llm import compression, language_id, quality_rules

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def tables(spark):
    return (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))


def test_rules_judge_as_written(spark):
    docs, labels = tables(spark)
    rows = quality_rules.judge_quality(docs, labels).collect()
    rules = quality_rules.fit_rules(quality_rules.statistics(docs), labels)
    assert rules
    for r in rows:
        features = {}
        for name, formula in quality_rules.FEATURES.items():
            top, _, bottom = formula.partition(" / ")
            low = sum(r[c] for c in bottom.strip("()").split(" + ")) if bottom else 1
            features[name] = r[top] / low if low else 0.0
        fired = [k for k, rule in enumerate(rules, 1) if all(features[n] >= x if sign == ">=" else features[n] <= x for n, sign, x in rule)]
        assert r["rule"] == (fired[0] if fired else None) and r["kept"] == (not r["base_failed"] and not fired)


def test_rules_of_few_labels_find_held_out_documents(spark):
    docs, labels = tables(spark)
    rows = {r["doc_id"]: r for r in quality_rules.judge_quality(docs, labels).collect()}
    held_out = labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2).collect()
    bad = [rows[r["doc_id"]] for r in held_out if r["quality"] == 0]
    good = [rows[r["doc_id"]] for r in held_out if r["quality"] == 1]
    assert sum(not r["kept"] for r in bad) >= 15 and not any(r["rule"] for r in good)


def test_chance():
    assert quality_rules.by_chance(0, 0, 0.1) == 1 and quality_rules.by_chance(3, 0, 0.1) == pytest.approx(1e-3)
    assert quality_rules.by_chance(2, 1, 0.5) == pytest.approx(0.5)


def plain_grams(text):
    data = (" " + text.lower() + " ").encode()
    flat = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in data)
    return [int.from_bytes(flat[i : i + 4], "little") for i in range(len(flat) - 3)]


def test_languages_by_sets_of_grams(spark):
    docs, _ = tables(spark)
    filters = language_id.learn_filters(docs)
    bits = int(math.log2(len(filters.masks)))
    member = [set(np.flatnonzero(filters.masks >> np.uint64(k) & np.uint64(1)).tolist()) for k in range(len(filters.languages))]
    rows = language_id.identify(docs.where("doc_id < 60"), filters).collect()
    for r in rows:
        slots = [[(g * f & 0xFFFFFFFF) >> (32 - bits) for f in language_id.FACTORS] for g in plain_grams(r["text"])]
        real = []
        for k in range(len(filters.languages)):
            hits = sum(all(s in member[k] for s in both) for both in slots)
            real.append(max(0, (hits - len(slots) * filters.chance[k]) / max(1e-9, 1 - filters.chance[k])))
        assert r["lang_pred"] == filters.languages[int(np.argmax(real))]
        assert r["score"] == pytest.approx(max(real) / sum(real) if sum(real) else 0.0)


def test_quality_by_plain_sizes(spark):
    docs, labels = tables(spark)
    model = compression.fit(docs, labels)
    rows = compression.score_quality(docs.where("doc_id < 60"), model).collect()
    coders = [zstandard.ZstdCompressor(level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (model.bad, model.good)]
    for r in rows:
        data = r["text"].encode()
        sizes = [sum(len(c.compress(data[i : i + compression.BLOCK])) for i in range(0, len(data), compression.BLOCK)) for c in coders]
        weight = len(data) / max(1, len(data) + model.pull)
        odds = weight * (model.slope * (sizes[0] - sizes[1]) / len(data) + model.offset) + (1 - weight) * model.prior
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, odds)))))
