"""Token files, tokenizer alignment and ranked search against plain Python over whole texts."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthpanel.llm import lexical_search, token_files, tokenizer_spans

SF = "/root/testdata/sf0.001"
WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\n", "a", "  two  spaces ", "Line one.\nLine two,\tand\r\n\r\nmore ", "it's WE'RE o'clock 'S", "naïve café café H̱ ΣΣ İ",
    "<|endoftext|> x<|startoftext|>y <|STARTOFTEXT|>", "<s>a</s> <unk> <0x41>", "你好 世界！ ①", "\U0001f600\U0001f600 \U0001f468‍\U0001f469‍\U0001f467!", "x▁y ▁", "a\x1cb \x1f c",
    "a\xa0b　c d", "end.,; .x ,y 1,000.50 3rd", "\x00 nul", "é ́x", "same words same words", "x" * 300 + " " + "yz" * 100,
    "สวัสดี क्ष աբ", "tab\tspace  \n  newline", "A" * 50 + "," + "b" * 70 + ".",
]


def mixed(seed, n=200):
    """Texts of random pieces of the odd ones."""
    rng = random.Random(seed)
    pieces = [w for t in ODD if t for w in re.split(r"(?<= )", t)] + list(" .,\n\t'") * 3
    return ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


def documents(spark, texts, extra="shard int, doc_no string, part int, n int"):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in enumerate(texts)], f"doc_id long, text string, {extra}")


def real_texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


# --- token files


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_ids_of_chunks_are_those_of_whole_texts():
    texts = [t for t in ODD if t is not None] + mixed(1)
    for text, ids in zip(texts, plain_ids(texts)):
        assert np.frombuffer(token_files.ids_of(text, WORDS), "<u4").tolist() == ids[:-1], repr(text)


def checked_index(rows, texts):
    start = 0
    for r, ids in zip(rows, plain_ids(texts)):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == len(texts)


def test_token_files_round_trip(spark, tmp_path):
    texts = [*ODD, "word " * 20_000, *mixed(2, 50)]
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(documents(spark, texts).repartition(3), folder, WORDS)
    checked_index(token_files.document_index(spark, folder).orderBy("doc_id").collect(), texts)
    parts = token_files.token_parts(spark, folder)
    assert parts.columns == ["shard", "doc_no", "doc_id", "part", "before", "ids"] and parts.agg(F.max(F.size("ids"))).first()[0] <= token_files.PART_IDS
    got = {r.doc_id: r.ids for r in token_files.tokens_of(spark, folder, [7, len(ODD), 10_000]).collect()}
    want = plain_ids(texts)
    assert got == {7: want[7], len(ODD): want[len(ODD)]}


def test_token_files_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "first"), (3, "b b"), (3, "a"), (3, "a"), (1, None)]
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "t"), WORDS)
    made = token_files.document_index(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in made] == [None, 1, 3, 3, 3]
    assert [r.start for r in made] == [sum(x.n_tokens for x in made[:i]) for i in range(5)]
    assert sorted(r.n_tokens for r in made[2:]) == [2, 2, 3]


def test_token_files_empty(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([], "doc_id string, text string"), str(tmp_path / "t"), WORDS)
    assert token_files.document_index(spark, str(tmp_path / "t")).collect() == []


@pytest.mark.parametrize("damage", ["part >= 1", "part <> 1"])
def test_damaged_token_files(spark, tmp_path, damage):
    token_files.write_tokens(documents(spark, ["word " * 10_000]), str(tmp_path / "a"), WORDS)
    token_files.token_parts(spark, str(tmp_path / "a")).where(damage).write.orc(str(tmp_path / "b"))
    with pytest.raises(Exception, match="missing or damaged"):
        token_files.document_index(spark, str(tmp_path / "b")).collect()
    changed = token_files.token_parts(spark, str(tmp_path / "a")).withColumn("ids", F.when(F.col("part") == 1, F.reverse("ids")).otherwise(F.col("ids")))
    changed.withColumn("ids", F.when(F.col("part") == 1, F.transform("ids", lambda x: x + 1)).otherwise(F.col("ids"))).write.orc(str(tmp_path / "c"))
    with pytest.raises(Exception, match="missing or damaged"):
        token_files.document_index(spark, str(tmp_path / "c")).collect()


def test_filters_on_ids_skip_index_entries(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(spark.range(20_000).select((F.col("id") * 2).alias("doc_id"), F.lit("a few words").alias("text")), folder, WORDS)
    files = [f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".orc")]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(files[0]), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == token_files.STRIDE and "ZSTD" in str(reader.getCompressionKind())

    def read(doc):
        """Rows that leave the scan before the filter."""
        found = token_files.token_parts(spark, folder).where(F.col("doc_id") == doc)
        plan = found._jdf.queryExecution().executedPlan()
        found._jdf.queryExecution().toRdd().count()
        while not plan.children().isEmpty():
            plan = plan.children().head()
        return plan.metrics().apply("numOutputRows").value()

    assert 0 < read(2000) <= 2 * token_files.STRIDE
    assert read(2001) == 0  # in the range of an entry, but not in its Bloom filter


def test_token_files_query(spark):
    texts = real_texts(spark)
    checked_index(token_files.op11_token_files(spark, SF).orderBy("doc_id").collect(), [texts[d] for d in sorted(texts)])


# --- tokenizer spans


def byte_tokens(text):
    """Ids and bytes of both tokenizers over a whole text."""
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {c: b for b, c in zip(visible, map(chr, visible))}
    of.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in visible)})
    encoded = a.encode(" " + text, add_special_tokens=False)
    pieces = b.encode(text, out_type=str)
    return (
        [(i, bytes(of[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)],
        [(i, bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) and b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(b.encode(text), pieces)],
    )


def brute_alignment(texts):
    made, docs_of = [], Counter()
    for text in texts:
        groups = []
        if text:
            a, b = byte_tokens(text)
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
                cuts = sorted(ends[0] & ends[1])
                sides = []
                for side in (a, b):
                    at, parts = 0, defaultdict(list)
                    for i, x in side:
                        at += len(x)
                        parts[next(c for c in cuts if c >= at)].append(i)
                    sides.append(parts)
                groups = [(sides[0][c], sides[1][c]) for c in cuts]
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        docs_of.update(set(links))
        made.append((groups, links))
    most = Counter()
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    rows = []
    for groups, links in made:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if docs_of[p] == most[p[0]]), sum(n * docs_of[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return rows


SPANS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_of_odd_texts(spark):
    texts = [*ODD, *mixed(3), "same text again and again", "same text again and again"]
    docs = documents(spark, texts, "pairs int, times string, n_a int, name int").repartition(3)
    rows = tokenizer_spans.align_tokenizers(docs, BYTES, PIECES).orderBy("doc_id").collect()
    want = brute_alignment(texts)
    for r, w, text in zip(rows, want, texts):
        assert tuple(r[c] for c in SPANS) == w, repr(text)
    assert len(rows) == len(texts) and want[0] == want[1] == (0, 0, 0, 0, 0, 0, "")


def test_chunks_give_what_whole_texts_give():
    pair = tokenizer_spans.pair_of(BYTES, PIECES)
    assert pair.chunked
    long = ("A long line, of words\nwithout end; café 你好 x². (a|b) 'tis\n\n" * 4000).strip()
    for text in [t for t in ODD if t] + mixed(11, 400) + [long]:
        whole, (a, b, groups, written, links) = pair.align(text), pair.document(text)
        if whole is None:
            assert (a, b, groups, written, len(links)) == (0, 0, 0, "", 0)
        else:
            assert (a, b, groups, written, links.tobytes()) == whole, repr(text)


def test_texts_with_other_bytes_have_no_tokens():
    pair = tokenizer_spans.pair_of(BYTES, PIECES)
    assert pair.document("some words before x▁y")[:4] == (0, 0, 0, "")


def test_alignment_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokenizer_spans.align_tokenizers(empty, BYTES, PIECES).collect() == []
    rows = tokenizer_spans.align_tokenizers(spark.createDataFrame([(None, "a b"), (None, "a b"), (5, None)], "doc_id long, text string"), BYTES, PIECES).collect()
    assert Counter(r.doc_id for r in rows) == {None: 2, 5: 1} and {r.count_sum for r in rows if r.doc_id is None} == {4}


def test_alignment_query(spark):
    texts = real_texts(spark)
    some = sorted(texts)
    rows = {r.doc_id: tuple(r[c] for c in SPANS) for r in tokenizer_spans.op12_tokenizer_spans(spark, SF).collect()}
    assert [rows[d] for d in some] == brute_alignment([texts[d] for d in some])


# --- ranked search


def brute_search(docs, items, k=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    bags = [(d, Counter(words(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_words = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for _, b in bags for w in b)
    rows = []
    for item, text in items:
        wanted, scores = Counter(words(text)), []
        for (doc, bag), size in zip(bags, sizes):
            if size:
                m = 100 - 75 + (75 * size * n_docs) // n_words
                s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m)) for w, n in wanted.items() if bag[w])
                if s > 0:
                    scores.append((-s, doc is None, doc or 0, doc))
        rows += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(rows, key=str)


def small_search():
    rng = random.Random(5)
    words = ["Red", "blue", "green-ish", "café", "cafÉ", "x1", "2024", "你好", "the", "THE", "rare"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(150)]
    texts += ["the red blue"] * 60 + [None, "", " ... ", "the " * 3000, "green ish"]
    docs = [(1000 - i if i % 40 else None, t) for i, t in enumerate(texts)] + [(7, "red rare"), (7, "red rare")]
    items = [(0, "the red blue"), (1, "RARE rare x1"), (2, None), (3, "unseen"), (4, "你好 café cafÉ"), (4, "green-ish"), (None, "2024")]
    return docs, items


@pytest.mark.parametrize("k, block", [(10, 200_000), (3, 2)])
def test_search(spark, k, block):
    docs, items = small_search()
    made = lexical_search.search(
        spark.createDataFrame([(d, t, 1, "y") for d, t in docs], "doc_id long, text string, hash int, item_id string").repartition(5),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"), k, block_terms=block,
    )
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute_search(docs, items, k)


def test_search_without_rows(spark):
    docs, items = (spark.createDataFrame([], f"{i} string, text string") for i in ("doc_id", "item_id"))
    one = spark.createDataFrame([("a", "words")], "item_id string, text string")
    assert lexical_search.search(docs, items).collect() == [] and lexical_search.search(docs, one).collect() == []
    assert lexical_search.search(spark.createDataFrame([("d", None)], "doc_id string, text string"), one).collect() == []


def test_members_of_a_class_take_places_by_id(spark):
    """Sixty copies and others of the same score in other classes: places go by id over classes."""
    docs = [(i, "red blue" if i % 2 else "blue red red") for i in range(60)] + [(i, "red green") for i in range(60, 64)]
    items = [(0, "red"), (1, "blue green")]
    made = lexical_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame(items, "item_id long, text string"), 10
    )
    assert sorted((tuple(r) for r in made.collect()), key=str) == brute_search(docs, items)
