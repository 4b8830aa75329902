"""Registered queries without SQL against brute force and held-out accuracy; the pipeline's later stages against SQL."""

import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from monthpanel.llm import compression, decontaminate, kneser_ney, language_id, line_dedup, mixing, near_duplicates, quality_rules
from test_kneser_ney import brute
from test_small_cases import brute_counts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def texts_of(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_quality_rules(spark):
    texts = texts_of(spark)
    rows = quality_rules.op1_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_words, _, _, _, n_repeat = counts = brute_counts(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.COUNTS[:5]) == counts
        assert r.base_failed == (n_words < 10 or 100 * n_repeat > 20 * n_words)
        assert not (r.kept and r.base_failed)


def test_languages_held_out(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = language_id.op3_language_id(spark, SF).collect()
    held_out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held_out} == {d for d in langs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held_out) >= 0.95 * len(held_out)


@pytest.mark.parametrize("sf_dir, kept, found", [("/root/testdata/sf0.01", 0.9, 0.7), ("/root/testdata/sf0.1", 0.98, 0.9)])
def test_quality_scores_held_out(spark, sf_dir, kept, found):
    """The small table has some forty bad documents to learn from, the other some four hundred."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = compression.op7_compression_quality(spark, sf_dir).collect()
    held_out = [r for r in rows if r.held_out and r.doc_id in labels]
    good = [r.predicted for r in held_out if labels[r.doc_id] == 1]
    bad = [r.predicted for r in held_out if labels[r.doc_id] == 0]
    assert sum(good) >= kept * len(good) and sum(bad) <= (1 - found) * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_language_model(spark):
    texts = texts_of(spark)
    n, want = brute([t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 10 != 0], list(texts.values()))
    rows = {r.doc_id: r for r in kneser_ney.op10_kneser_ney(spark, SF).collect()}
    for doc, (tokens, known, base, score) in zip(texts, want):
        r = rows[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, zlib.crc32(str(doc).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_later_stages_equal_sql(spark, tmp_path):
    docs = corpus_pipeline.filter_quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    docs.write.parquet(str(tmp_path / "filtered"))
    docs = spark.read.parquet(str(tmp_path / "filtered"))
    for name, stage in corpus_pipeline.STAGES[1:]:
        made = stage(spark, docs, SF)
        path = str(tmp_path / name.replace(" ", "-"))
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW filtered AS SELECT * FROM read_parquet('{tmp_path}/filtered/*.parquet')")
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")
    duck.execute(f"""CREATE TABLE lines AS WITH {line_dedup.KEPT_SQL.format(docs='filtered')}
      SELECT doc_id, kept.text, lang, source, length(kept.text) AS n_chars FROM kept JOIN filtered USING (doc_id)""")
    duck.execute(f"""CREATE TABLE apart AS WITH RECURSIVE {near_duplicates.sql_of('lines', 5, 80)}
      SELECT l.* FROM lines l JOIN component c USING (doc_id) WHERE doc_id = component_id""")
    duck.execute(f"""CREATE TABLE clean AS WITH {decontaminate.PAIRS_SQL.format(docs='apart')}
      SELECT * FROM apart WHERE doc_id NOT IN (SELECT doc_id FROM pairs)""")
    cursor = duck.execute(f"WITH {mixing.MIX_SQL.format(docs='clean')} {mixing.MIX_SELECT}")
    names = sorted(d[0] for d in cursor.description)
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    want = sorted(tuple(str(r[i]) for i in order) for r in cursor.fetchall())
    got = sorted(tuple(str(r[n]) for n in names) for r in docs.collect())
    assert names == sorted(docs.columns) and got == want and got
