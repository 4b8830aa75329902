"""Quality rules as a learned decision list.

Statistics of every whole text are measured once and stored. Sequential covering learns from labelled rows of them: a rule
grows by the threshold with the best information gain until it covers no good row, and is pruned from its end on the rows of a fold that it
was not grown on. It is kept if it is precise there, and if so many bad rows as it finds there would hardly be found by chance (``CHANCE``, of a
binomial count with the fold's share of bad rows); else the next fold judges a rule grown on the others. The rows that a kept rule covers leave, and the
next rule is grown, until no fold accepts one. The list becomes one ordered Spark conditional expression, so judging is a column
expression over the statistics.

Fit on at most ``MAX_LABELLED`` labelled rows (the smallest by a hash of the id), whose id has no remainder 2: a bounded
sample of classifier labels, everything else covers all rows.

Nulls: a null text has no words and fails the base rule. Labels that are null are ignored, repeated ones averaged. Rows that
repeat are each judged. Without labels of both kinds the list is empty and only the base rule decides. Empty tables give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.batches import bytes_of
from monthpanel.llm.shared import id_remainder, stored, table

MAX_LABELLED, MAX_RULES, MAX_TERMS, PRECISION, CHANCE, FOLDS = 20_000, 12, 3, 0.95, 1e-3, 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unique", "n_upper", "n_lower",
          "n_digits", "n_bangs", "n_marks")
FEATURES = {
    "words": "n_words", "word_length": "word_chars / n_words", "symbols": "n_symbols / word_chars",
    "dup_lines": "n_dup_lines / n_lines", "repeats": "n_repeat_words / n_words", "unique": "n_unique / n_words",
    "upper": "n_upper / (n_upper + n_lower)", "digits": "n_digits / word_chars", "bangs": "n_bangs / n_words",
    "marks": "n_marks / n_words", "line_words": "n_words / n_lines",
}
#: Factors of the hash of a five-word window.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_SLICE = 1 << 20


def _classes() -> np.ndarray:
    """Class of each byte: 1 blank, 2 lower, 3 upper, 4 digit, 5 symbol, 6 exclamation mark, 7 other mark, 8 inside a character."""
    kind = np.zeros(256, np.uint8)
    kind[33:127] = 7
    for chars, k in ((b" \t\n\x0b\x0c\r", 1), (b"abcdefghijklmnopqrstuvwxyz", 2), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3), (b"0123456789", 4), (b"#*$%&|<>", 5), (b"!", 6)):
        kind[list(chars)] = k
    kind[0x80:0xC0] = 8
    return kind


_KIND = _classes()


def repeated_words(words: list[bytes], span: int = 5) -> int:
    """Words inside windows of ``span`` words that occur at least twice."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = reduce(operator.add, (hashes[k : n + k] * _FACTORS[k] for k in range(span)))
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, twice)
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:n] += found
    steps[span : n + span] -= found
    return int((np.cumsum(steps)[:-1] > 0).sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` for one text."""
    data = np.frombuffer(text, np.uint8)
    kinds = sum((np.bincount(_KIND[data[k : k + _SLICE]], minlength=9) for k in range(0, len(data), _SLICE)), np.zeros(9, np.int64))
    words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - int(kinds[8]) - int(kinds[1]), int(kinds[5]), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(set(words)), int(kinds[3]), int(kinds[2]), int(kinds[4]), int(kinds[6]), int(kinds[7]),
    )


def _count_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        data, offsets = bytes_of(batch)
        rows = np.array([count_text(data[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])], np.int64).reshape(-1, len(COUNTS))
        yield pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], names=list(COUNTS))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, the counts and the features; a feature without a denominator is 0."""
    count_texts = F.arrow_udf(_count_batches, ", ".join(f"{c} bigint" for c in COUNTS))
    counted = docs.select(F.col(id_col).alias(id_col), count_texts(F.coalesce(F.col(text_col), F.lit(""))).alias("counts"))
    counted = counted.select(id_col, "counts.*")
    ratios = {
        name: F.coalesce(F.expr(f"try_divide({top}, {bottom})"), F.lit(0.0)) if bottom else F.col(top).cast("double")
        for name, (top, _, bottom) in ((n, e.partition(" / ")) for n, e in FEATURES.items())
    }
    return counted.select("*", *[c.cast("double").alias(n) for n, c in ratios.items()])


Rule = list[tuple[str, str, float]]


def _covers(rule: Rule, rows: np.ndarray, names: list[str]) -> np.ndarray:
    hit = np.ones(len(rows), bool)
    for name, sign, limit in rule:
        x = rows[:, names.index(name)]
        hit &= x >= limit if sign == ">=" else x <= limit
    return hit


def _grow(rows: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    rule, hit = [], np.ones(len(rows), bool)
    while len(rule) < MAX_TERMS and (~bad & hit).any():
        p0, n0 = (bad & hit).sum(), (~bad & hit).sum()
        best = (0.0, None)
        for k, name in enumerate(names):
            for limit in np.unique(np.quantile(rows[hit & bad, k], np.linspace(0, 1, 33), method="nearest")):
                for sign in (">=", "<="):
                    now = hit & (rows[:, k] >= limit if sign == ">=" else rows[:, k] <= limit)
                    p, n = (bad & now).sum(), (~bad & now).sum()
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
                    if gain > best[0] + 1e-9:
                        best = (gain, (name, sign, float(limit)))
        if best[1] is None:
            break
        rule.append(best[1])
        hit = _covers(rule, rows, names)
    return rule


def by_chance(p: int, n: int, share: float) -> float:
    """Probability that at least ``p`` of ``p + n`` rows are bad when ``share`` of all are."""
    m = p + n
    return sum(math.comb(m, k) * share**k * (1 - share) ** (m - k) for k in range(p, m + 1)) if m < 1000 else float(p <= share * m)


def _judged_rule(rows: np.ndarray, bad: np.ndarray, judge: np.ndarray, names: list[str]) -> Rule:
    """A rule grown on the other rows and pruned on those of ``judge``, or an empty one if it isn't sure there."""
    if not bad[~judge].any() or not bad[judge].any():
        return []
    rule = _grow(rows[~judge], bad[~judge], names)
    own, marks = rows[judge], bad[judge]

    def found(terms: Rule) -> tuple[int, int]:
        hit = _covers(terms, own, names)
        return int((hit & marks).sum()), int((hit & ~marks).sum())

    def worth(terms: Rule) -> float:
        p, n = found(terms)
        return (p + 1) / (p + n + 2) if terms else 0.0

    # The shortest beginning of the rule that is as precise as the best one.
    rule = rule[: max(range(len(rule) + 1), key=lambda k: (round(worth(rule[:k]), 3), -k))]
    p, n = found(rule)
    sure = rule and p >= PRECISION * (p + n) and by_chance(p, n, marks.mean()) < CHANCE
    return rule if sure else []


def learn_rules(rows: np.ndarray, bad: np.ndarray, folds: np.ndarray, names: list[str]) -> list[Rule]:
    """Ordered rules that find bad rows; each is grown on all ``folds`` but one and judged on that."""
    rules, left = [], np.ones(len(rows), bool)
    while len(rules) < MAX_RULES and (bad & left).any():
        tried = (_judged_rule(rows[left], bad[left], folds[left] == f, names) for f in range(FOLDS))
        rule = next((r for r in tried if r), None)
        if rule is None:
            break
        rules.append(rule)
        left &= ~_covers(rule, rows, names)
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The list as an ordered conditional: the number of the first rule that fires, or null."""
    out = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        terms = [F.col(name) >= limit if sign == ">=" else F.col(name) <= limit for name, sign, limit in rules[k]]
        out = F.when(reduce(operator.and_, terms), F.lit(k + 1)).otherwise(out)
    return out


def fit_rules(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
              max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules from measured rows with a label of 0 (bad) or 1."""
    votes = labels.where(F.col(label_col).isNotNull() & (id_remainder(F.col(id_col), 4) != 2)).groupBy(id_col).agg(
        (F.avg(label_col) < 0.5).alias("bad")
    )
    sample = F.broadcast(votes.orderBy(F.xxhash64(id_col), id_col).limit(max_labelled))
    names = list(FEATURES)
    rows = measured.select(id_col, *names).join(sample, id_col).orderBy(F.xxhash64(id_col), id_col).limit(max_labelled).toPandas()
    if rows.empty or rows["bad"].nunique() < 2:
        return []
    return learn_rules(rows[names].to_numpy(float), rows["bad"].to_numpy(bool), np.arange(len(rows)) % FOLDS, names)


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, counts, features, ``base_failed``, ``rule`` (the number that fired) and ``kept``."""
    measured = stored(statistics(docs, id_col, text_col), "statistics")
    rules = fit_rules(measured, labels, id_col)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.withColumns({"base_failed": base, "rule": rule_number(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op1_quality_rules(spark, sf_dir):
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule")


QUERIES = {"op1_quality_rules": (op1_quality_rules, None)}
