"""The language model against one with dictionaries."""

import math
import zlib
from collections import Counter

import pytest

from monthpanel.llm import kneser_ney as kn

TEXTS = ["the cat sat on the mat", "The cat sat", "a dog sat on\tthe log", "", None, "  ", "the the the cat\ncat é É"] + [
    f"word{i % 7} is {'the ' * (i % 4)}cat w{i}" for i in range(60)
]


def brute(train, texts):
    def tokens(text):
        return [w.lower() for w in (text or "").encode().split()] + [None]

    uni, bi = Counter(), Counter()
    for t in train:
        words = tokens(t)
        uni.update(words)
        bi.update(zip(["<s>", *words[:-1]], words))
    ns = Counter(min(c, 5) for c in bi.values())
    d = kn._discounts(*[ns[k] for k in (1, 2, 3)], sum(c == 4 for c in bi.values()))
    contexts, total, held = Counter(w for _, w in bi), Counter(), Counter()
    for (v, _), c in bi.items():
        total[v] += c
        held[v] += d[min(c, 3) - 1]
    e = kn._discounts(*[sum(c == k for c in contexts.values()) for k in (1, 2, 3, 4)])
    n, v = sum(uni.values()), len(uni)
    backoff = sum(e[min(c, 3) - 1] for c in contexts.values()) / max(1, len(bi))

    def unigram(w):
        c = contexts[w]
        return (max(c - e[min(c, 3) - 1], 0) if c else 0) / len(bi) + backoff / (v + 1)

    out = []
    for t in texts:
        words, score, base = tokens(t), 0.0, 0.0
        for before, w in zip(["<s>", *words[:-1]], words):
            c, p = bi[before, w], unigram(w)
            if total[before]:
                p = (c - d[min(c, 3) - 1] if c else 0) / total[before] + held[before] / total[before] * p
            score += math.log10(p)
            base += math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1)))
        out.append((len(words), sum(uni[w] > 0 for w in words), base, score))
    return n, out


@pytest.mark.parametrize("shard_words", [3_000_000, 20])
def test_scores_equal_those_of_dictionaries(spark, monkeypatch, shard_words):
    monkeypatch.setattr(kn, "SHARD_WORDS", shard_words)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    train = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 10 != 0]
    model = kn.train(docs.where(kn.id_remainder(docs.doc_id, 10) != 0))
    n, want = brute(train, TEXTS)
    got = {r.doc_id: r for r in kn.score_texts(docs, model).collect()}
    assert model.tokens == n
    for i, (tokens, known, base, score) in enumerate(want):
        assert (got[i].n_tokens, got[i].n_known) == (tokens, known)
        assert got[i].base_score == pytest.approx(base, abs=1e-9)
        assert got[i].score == pytest.approx(score, abs=1e-9)


def test_counts_over_254_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b " * 400), (1, "a b " * 400), (2, "a c")], "doc_id long, text string")
    n, want = brute(["a b " * 400, "a b " * 400, "a c"], ["a b " * 400])
    model = kn.train(docs)
    got = kn.score_texts(docs, model).where("doc_id = 1").collect()
    assert model.tokens == n and len(got) == 2
    assert all(r.score == pytest.approx(want[0][3], rel=1e-9) for r in got)


def test_probabilities_add_up_to_one(spark):
    import numpy as np

    texts = ["a b c", "a c b a", "b b"]
    model = kn.train(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    words = np.array([kn.word_hashes[w] for w in (b"a", b"b", b"c", b"unknown")] + [kn.END], np.uint64)
    for before in (kn.START, words[0], words[1], words[3]):
        p, _ = kn.Lookup(model).score(np.full(len(words), before, np.uint64), words)
        assert (10**p).sum() == pytest.approx(1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = kn.train(docs)
    assert model.tokens == 0 and kn.score_texts(docs, model).count() == 0
    one = kn.score_texts(spark.createDataFrame([(1, "x y")], "doc_id long, text string"), model).first()
    assert (one.n_tokens, one.n_known, one.base_score) == (3, 0, 0.0)


def test_contexts_beyond_a_part_of_a_shard_are_spread(spark, monkeypatch):
    """No word makes up a thousandth of the text, but one comes more often than a tenth of a shard."""
    monkeypatch.setattr(kn, "SHARD_WORDS", 5000)
    texts = [" ".join(f"w{k * 50 + j}" for j in range(50)) for k in range(12_000)]
    texts = [f"often {t}" if k % 20 == 0 else t for k, t in enumerate(texts)]
    # 600 times in 612,600 words with the ends: over 500, under a thousandth. Besides it the marks of start and end are hot.
    model = kn.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert len(model.hot) == 3 and 600 < model.tokens / 1000
