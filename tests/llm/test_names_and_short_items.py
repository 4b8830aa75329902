"""Extra columns keep their names and values, whatever the operators call their own; short benchmark items."""

import pytest
from pyspark.sql import functions as F

from monthpanel.llm import compression, decontaminate, language_id, line_dedup, mixing, near_duplicates, url_filter

NAMES = """doc item id body text_ words gone gone_id gone_body gone_lines all_lines _id _body _lines _gone hit h at wide around wanted same of
_own _source _draws _mean _cdf own draws cdf drawn_source found _found best _best rep key name n pos line part keys block any""".split()
TEXTS = [
    "a line that is long enough to count\nanother line of this text that stays", "a line that is long enough to count\nmore", "a line that is long enough to count",
    "one two three four five six seven eight nine ten eleven twelve", None, "",
]


def crowded(spark):
    rows = [(i, t, f"s{i % 2}", f"http://www.example.com/{i}") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, url string")
    return docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in NAMES])


OPERATORS = {
    "drop_lines": (lambda d, s: line_dedup.drop_lines(d), ["n_lines", "n_dropped"]),
    "one_of_each": (lambda d, s: near_duplicates.one_of_each(d), []),
    "decontaminate": (lambda d, s: decontaminate.decontaminate(d, s.createDataFrame([(1, "nothing of this is in any text here at all")], "item_id long, text string")), []),
    "replicate": (lambda d, s: mixing.replicate(d, weights={"s0": 1.0, "s1": 1.0}, total=60), ["copy", "n_copies", "shuffle_key"]),
    "identify": (lambda d, s: language_id.identify(d, language_id.learn_filters(
        s.createDataFrame([(i, "words of a text " * 9, "xx") for i in range(40)], "doc_id long, text string, lang string"))), ["lang_pred", "score"]),
    "judge_urls": (lambda d, s: url_filter.judge_urls(d), ["host", "path", "rule", "verdict"]),
    "score_quality": (lambda d, s: compression.score_quality(d, compression.Model()), ["score"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_stay(spark, name):
    operator, made = OPERATORS[name]
    docs = crowded(spark)
    out = operator(docs, spark)
    assert sorted(out.columns) == sorted([c for c in docs.columns if c not in made] + made)
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n}-{r.doc_id}" for n in NAMES)


def test_short_items(spark):
    texts = [
        "we ask: What is the Capital of france today", "what is the capital of spain", "yes", "yes and no", "the answer is forty two ok", "forty two", "a b c", "x a b c y a b c", None, "",
        "what is the capital of france what is the capital of france",
    ]
    items = [(1, "what is the capital of france"), (2, "Yes"), (3, "forty two"), (4, "a b c"), (5, None), (6, " "), (7, "a b c"), (8, "is the capital of")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {(0, 1): 6, (10, 1): 6, (2, 2): 1, (5, 3): 2, (6, 4): 3, (7, 4): 3, (6, 7): 3, (7, 7): 3, (0, 8): 4, (1, 8): 4, (10, 8): 4}
    for block in (250_000, 1):
        found = {(r.doc, r.item): (r.matched, r.similarity) for r in decontaminate.overlaps(docs, benchmark, block=block).collect()}
        assert found == {k: (n, 1.0) for k, n in want.items()}
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()) == [3, 4, 8, 9]


def test_lower_similarity_is_refused(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError, match="0.8"):
        decontaminate.overlaps(docs, docs.withColumnRenamed("doc_id", "item_id"), similarity=0.7)
