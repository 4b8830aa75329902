"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names; each operator against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthpanel.llm import (
    compression, decontaminate, language_id, line_dedup, mixing, near_duplicates, quality_rules, url_filter, warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, id string, h1 string, rule string"


def docs_of(spark, texts, ids=None, sources=None, langs=None):
    """Documents with extra columns whose names operators also use."""
    rows = [
        ((ids or range(1, len(texts) + 1))[k], t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k], 0, 9.0, "k", "i", "h", "r")
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


LONG = "a long line that repeats in documents"
ODD = [None, "", "   ", "\n", "x", LONG, f"{LONG}\n\n{LONG.upper()} \t\nown", f" {LONG}\nother\n", "é\u2028ü", "word " * 50_000]


def brute_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if not (len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != doc)]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out)


def test_lines(spark):
    docs = docs_of(spark, [*ODD, f"{LONG}\nlast"])
    got = line_dedup.drop_lines(docs)
    assert {"id", "h1", "score"} <= set(got.columns)
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()]
    assert sorted(rows) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in rows) == 4


def test_lines_of_repeated_rows_and_null_ids(spark):
    texts = [LONG, LONG, LONG, f"{LONG}\nx", f"{LONG}\nx", None]
    got = [(r.doc_id, r.n_dropped) for r in line_dedup.drop_lines(docs_of(spark, texts, [1, 1, 2, None, None, None])).collect()]
    # Three documents: null, 1 and 2, the largest keeps the line.
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (2, 0), (None, 1), (None, 1), (None, 0)], key=str)
    assert line_dedup.drop_lines(docs_of(spark, [LONG]).limit(0)).count() == 0


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen, inside = {}, set()
    for k, w in enumerate(windows):
        seen.setdefault(w, []).append(k)
    for places in seen.values():
        if len(places) > 1:
            inside.update(k + j for k in places for j in range(5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside),
    )


def test_counts(spark):
    texts = [*ODD[:-1], "a b c d e f a b c d e", "# $% |<> é\u00a0ü\x1c x", "a b\na b\n\na b\n ", "one two three four five " * 3, "x y " * 9]
    rows = quality_rules.statistics(docs_of(spark, texts)).collect()
    for r in rows:
        assert tuple(r[c] for c in quality_rules.COUNTS[:5]) == brute_counts(texts[r.doc_id - 1]), texts[r.doc_id - 1]


def test_rules_find_bad_rows_and_keep_good_ones(spark):
    draw = random.Random(1)
    good = [" ".join(draw.choices("tree house river stone cloud grass light".split(), k=40)) + f" n{i}" for i in range(300)]
    bad = [" ".join(w + "###" for w in draw.choices("tree house river".split(), k=40)) + f" n{i}" for i in range(100)]
    docs = docs_of(spark, [*good, *bad, None, ""])
    labels = spark.createDataFrame([(i, int(i <= 300)) for i in range(1, 401)] + [(7, None), (None, 0)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality_rules.judge_quality(docs, labels).collect()}
    assert all(rows[i].rule is None for i in range(1, 301))
    assert all(not rows[i].kept for i in range(301, 403)) and rows[401].base_failed and rows[402].base_failed
    none = quality_rules.judge_quality(docs, labels.limit(0))
    assert none.where("kept").count() == none.where("NOT base_failed").count() > 300
    assert quality_rules.judge_quality(docs.limit(0), labels).count() == 0


def test_rule_list_is_ordered(spark):
    rules = [[("words", ">=", 5.0)], [("words", ">=", 2.0), ("upper", "<=", 0.5)]]
    rows = spark.createDataFrame([(6.0, 0.9), (3.0, 0.1), (3.0, 0.9), (1.0, 0.0)], "words double, upper double")
    assert [r[0] for r in rows.select(quality_rules.rule_number(rules)).collect()] == [1, 2, None, None]


def test_archives(spark):
    big = "payload é " * 300
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (6, "u", big), (6, "u", big),
         (None, "u", big), (8, "u", "WARC/1.1\r\n\r\n" * 3)],
        "page_id long, url string, html string",
    )
    from monthpanel.llm.shared import new_folder

    records = warc.plan_records(pages)
    archives = warc.write_archives(records, new_folder(spark, "warc"), size=64)
    chunks = warc.read_archives(archives, size=64, data=True).collect()
    bodies, ends = {}, []
    for r in sorted(chunks, key=lambda r: (r.archive, r.ordinal, r.chunk)):
        assert len(r.data) <= 64
        bodies[r.archive, r.ordinal] = bodies.get((r.archive, r.ordinal), b"") + bytes(r.data)
        if r.record_type == "response":
            assert r.sha1 == hashlib.sha1(bodies[r.archive, r.ordinal]).hexdigest()
        if r.last:
            ends.append((r.page, r.record_type, r.refers_to, r.size, r.sha1, bodies[r.archive, r.ordinal]))
    full = hashlib.sha1(big.encode()).hexdigest()
    assert sorted(e[:3] for e in ends if e[4] == full and e[0] is not None) == [("1", "revisit", "6"), ("2", "revisit", "6"), ("6", "response", None), ("6", "response", None)]
    assert [e[:3] for e in ends if e[0] is None] == [(None, "revisit", "6")]
    assert all(e[3] == len(big.encode()) for e in ends if e[4] == full)
    assert sorted((e[0], e[5]) for e in ends if e[1] == "response" and e[0] in ("3", "4", "5", "8")) == [
        ("3", b""), ("4", b""), ("5", b"small"), ("8", b"WARC/1.1\r\n\r\n" * 3)]
    none = warc.write_archives(warc.plan_records(pages.limit(0)), new_folder(spark, "warc"))
    assert warc.read_archives(none).count() == 0


def test_archive_is_plain_gzip(spark):
    import gzip
    from urllib.parse import urlparse

    from monthpanel.llm.shared import new_folder

    pages = spark.createDataFrame([(1, "http://a/ b", "text")], "page_id long, url string, html string")
    archive = warc.write_archives(warc.plan_records(pages), new_folder(spark, "warc")).first()
    content = gzip.open(urlparse(archive.archive).path).read().decode()
    assert archive.records == 1 and content.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and content.endswith("\r\n\r\ntext\r\n\r\n")
    assert "WARC-Target-URI: http://a/%20b\r\n" in content


def test_languages(spark):
    words = {"en": "the house and river with them", "fr": "la maison et le fleuve avec", "de": "das haus und der fluss mit"}
    draw, texts, langs = random.Random(2), [], []
    for i in range(240):
        lang = sorted(words)[i % 3]
        texts.append(" ".join(draw.choices(words[lang].split(), k=20)))
        langs.append(lang if i % 10 else None)
    truth = [sorted(words)[i % 3] for i in range(240)]
    docs = docs_of(spark, [*texts, None, "", "12 34 !?", "ЖЖЖЖЖ", "the house " * 20_000], langs=[*langs, *["en"] * 5])
    filters = language_id.learn_filters(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, filters).collect()}
    assert [rows[i + 1].lang_pred for i in range(240)] == truth
    assert [rows[i].lang_pred for i in (241, 242, 243)] == ["und"] * 3 and rows[244].lang_pred in words and rows[244].score == 0
    assert rows[245].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows.values())
    nothing = language_id.learn_filters(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_more_languages_than_a_mask_word_has_bits(spark):
    draw = random.Random(8)
    words = {f"l{k:02d}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for k in range(70)}
    # The later a language's name, the fewer documents it has.
    truth = [lang for k, lang in enumerate(sorted(words)) for _ in range(10 + (70 - k) // 10)]
    docs = docs_of(spark, [" ".join(draw.choices(words[lang], k=15)) for lang in truth], langs=truth)
    filters = language_id.learn_filters(docs)
    assert sorted(filters.languages) == sorted(words)
    rows = {r.doc_id: r.lang_pred for r in language_id.identify(docs, filters).collect()}
    assert [rows[i + 1] for i in range(len(truth))] == truth


def test_filters_give_all_languages_of_an_ngram_and_texts_may_be_cut(spark, monkeypatch):
    docs = docs_of(spark, ["same words here only"] * 20 + ["same others there"] * 20, langs=["aa"] * 20 + ["bb"] * 20)
    filters = language_id.learn_filters(docs)
    bits = int(np.log2(len(filters.masks)))
    for text, want in (("same", 0b11), ("only", 0b01 if filters.languages[0] == "aa" else 0b10)):
        gram = int.from_bytes(text.encode(), "little")
        slots = [(gram * f & 0xFFFFFFFF) >> (32 - bits) for f in language_id.FACTORS]
        assert int(filters.masks[slots[0]] & filters.masks[slots[1]]) & want == want
    whole = np.concatenate(list(language_id.grams_of(b"some words " * 50)))
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert (np.concatenate(list(language_id.grams_of(b"some words " * 50))) == whole).all()


def brute_rule(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r, _ in url_filter.HOST_RULES if ("." + host).endswith("." + r.split("/")[0]) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def test_urls(spark):
    urls = [
        None, "", "nourl", "http://", "http://COM/", "http://com", "http://xcom/", "http://a.example.com/en/x?y=/z", "http://www.example.com/en/",
        "http://www.example.com/en", "http://EXAMPLE.com/EN/", "ftp://b.net/es/1#f", "http://net/fr/", "http://a.org/x.example.com/en/", "http://a.net/x://b.com/",
        "http://a.org/f.exe", "http://a.org/login", "http://a.com?x", "http://é.net/es/é", "http://a\nb.com/\n/en/", "http://h/" + "a" * 5000 + ".zip", "http://a.com/cart/x",
    ]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for r in url_filter.judge_urls(pages).collect():
        assert (r.host, r.path, r.rule) == brute_rule(urls[r.page_id]), urls[r.page_id]
        if r.rule is not None:
            assert r.verdict == dict(url_filter.HOST_RULES)[r.rule]
        else:
            text = f".{r.host}{r.path}"
            glob = any(re.fullmatch(re.escape(g).replace(r"\*", "(?s:.*)"), text) for g in url_filter.BLOCK_GLOBS)
            assert r.verdict == ("block" if glob else "allow")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_automaton_over_many_words():
    draw = random.Random(3)
    globs = ["".join(draw.choices("ab*?/.", k=draw.randint(1, 40))) for _ in range(60)]
    texts = ["".join(draw.choices("ab/.", k=draw.randint(0, 30))) for _ in range(200)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    hit = url_filter.Automaton([], globs).matches(data, np.cumsum([0, *map(len, texts)]))
    for k, glob in enumerate(globs):
        rule = re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob), re.S)
        assert [bool(rule.fullmatch(t)) for t in texts] == hit[:, k].tolist(), glob


def test_overlaps(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    item, other = draw.choices(words, k=30), draw.choices(words, k=12)
    near = list(item)
    for k in (5, 11, 17, 23):
        near[k] = "changed"
    texts = [" ".join(["x"] * 20 + item), " ".join([*near, "y"] * 1).upper(), " ".join(item[:12]), " ".join(item[::2]), None, "", " ".join(draw.choices(words, k=300)), " ".join(other)]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, " ".join(other)), (3, "short one"), (4, None), (5, "")], "item_id long, text string")
    found = decontaminate.overlaps(docs_of(spark, texts), benchmark)
    assert {(r.doc, r.item): r.matched for r in found.collect()} == {(1, 1): 16, (2, 1): 14, (3, 1): 12, (8, 2): 12}
    blocks = decontaminate.overlaps(docs_of(spark, texts), benchmark, block=7)
    assert sorted(blocks.collect()) == sorted(found.collect())
    kept = decontaminate.decontaminate(docs_of(spark, texts, [1, 2, 3, 4, 5, 6, 7, None]), benchmark)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [4, 5, 6, 7, None]
    assert decontaminate.overlaps(docs_of(spark, texts).limit(0), benchmark).count() == 0
    assert decontaminate.overlaps(docs_of(spark, texts), benchmark.limit(0)).count() == 0


def brute_overlaps(texts, items, similarity=0.8):
    """All windows of all items slid over all windows of the texts, without hashes."""
    best = {}
    for d, text in texts.items():
        for t, item in items.items():
            for i in range(len(item) - 7):
                span = range(max(0, i - 4), min(len(item), i + 12))
                for j in range(len(text) - 7):
                    same = sum(0 <= k - i + j < len(text) and text[k - i + j] == item[k] for k in span)
                    if same >= similarity * len(span) - 1e-9:
                        matched, share = best.get((d, t), (0, 0))
                        best[d, t] = max(matched, same), max(share, same / len(span))
    return best


def test_every_placement_of_other_words_has_a_seed():
    """Of 8 to 16 words, up to a fifth of them other ones: a seed lies on equal words, wherever the others are."""
    for n in range(8, 17):
        for changed in itertools.combinations(range(n), n // 5):
            assert any(
                all(x == "0" or at + k not in changed for k, x in enumerate(seed))
                for seed in decontaminate.SEEDS for at in range(n - len(seed) + 1)
            ), (n, changed)


def test_overlaps_equal_sliding_comparison(spark):
    """All placements of 3 other words in 16 and 15 words and of 2 in 10, and passages inside longer items and at the texts' ends."""
    draw = random.Random(7)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (16, 15, 10, 40)}
    texts = {}

    def put(words, changed):
        own = [f"other{draw.randrange(10**9)}" if k in changed else w for k, w in enumerate(words)]
        texts[len(texts)] = [f"x{draw.randrange(50)}" for _ in range(draw.choice((0, 0, 3)))] + own + ["y"] * draw.choice((0, 0, 9))

    for n, changed in ((16, 3), (15, 3), (10, 2)):
        for places in itertools.combinations(range(n), changed):
            put(items[n], places)
    whole = len(texts)
    for _ in range(150):
        at, size = draw.randrange(32), draw.randint(8, 24)
        part = items[40][at : at + size]
        put(part, draw.sample(range(len(part)), draw.randint(0, len(part) // 5 + 1)))
    want = brute_overlaps(texts, items)
    assert {d for d, _ in want} >= set(range(whole)) and whole < len(want) < len(texts)
    docs = docs_of(spark, [" ".join(t) for t in texts.values()], list(texts))
    benchmark = spark.createDataFrame([(t, " ".join(words)) for t, words in items.items()], "item_id long, text string")
    found = {(r.doc, r.item): (r.matched, r.similarity) for r in decontaminate.overlaps(docs, benchmark).collect()}
    assert found == want


def brute_groups(rows, size, percent):
    def shingles(text):
        words = [w.lower() for w in (text or "").encode().split()]
        return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())

    sets = [(doc, shingles(text)) for doc, text in rows]
    root = {doc: doc for doc, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[k + 1:]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {doc: (len(x), find(doc)) for doc, x in sets}


@pytest.mark.parametrize("block", [192, 4])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    draw = random.Random(5)
    base, texts = [draw.choices([f"w{i}" for i in range(2000)], k=60) for _ in range(8)], [None, "", " ", "one", "One", "one two", "a b c", "A b\tc"]
    for words in base:
        for _ in range(12):
            own = list(words)
            for _ in range(draw.choice((0, 1, 1, 2, 3, 5))):
                own[draw.randrange(60)] = f"new{draw.randrange(10**6)}"
            texts.append(" ".join(own))
    docs = docs_of(spark, texts, list(range(len(texts), 0, -1)))
    rows = near_duplicates.near_duplicates(docs, size=3, percent=85).collect()
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    kept = near_duplicates.one_of_each(docs, size=3, percent=85)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_near_duplicates_of_repeated_rows_and_null_ids(spark):
    docs = docs_of(spark, ["a b c d e", "a b c d e", "a b c d e", "a b c d e", None], [3, 3, 2, None, None])
    rows = near_duplicates.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=str) == sorted(
        [(3, 2, False), (3, 2, False), (2, 2, True), (None, None, True), (None, None, True)], key=str)
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0
    two = docs_of(spark, ["a b c d e", "a b c d e", "v w x y z"], [2, 3, 3])
    assert sorted(r.doc_id for r in near_duplicates.one_of_each(two).collect()) == [2, 3, 3]


def test_pruning_misses_at_most_the_chosen_probability():
    import math

    for percent in (80, 85):
        for n, m in near_duplicates.least_matches(percent).items():
            at_threshold = sum(math.comb(n, k) * (percent / 100) ** k * (1 - percent / 100) ** (n - k) for k in range(m))
            assert at_threshold < 1e-6 and m > 0.3 * n


def test_compression_scores(spark):
    draw = random.Random(6)
    def text(words, n): return " ".join("".join(draw.choices(words, k=3)) for _ in range(n))
    good, bad = ["ta", "ri", "no", "el", "su"], ["##", "QX", "!!", "ZV", "||"]
    texts = [text(good, draw.randint(40, 200)) for _ in range(200)] + [text(bad, draw.randint(40, 200)) for _ in range(200)]
    docs = docs_of(spark, [*texts, None, "", text(good, 30_000)])
    labels = spark.createDataFrame([(i, int(i <= 200)) for i in range(1, 401)] + [(5, None)], "doc_id long, quality int")
    scored = compression.score_quality(docs, compression.fit(docs, labels))
    rows = {r.doc_id: r.score for r in scored.collect()}
    held_out = [i for i in range(1, 401) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held_out) > 50 and sum((rows[i] >= 0.5) == (i <= 200) for i in held_out) >= 0.98 * len(held_out)
    assert all(0 <= s <= 1 for s in rows.values()) and rows[401] == rows[402] and rows[403] > 0.9
    alone = compression.score_quality(docs, compression.fit(docs, labels.where("quality = 1")))
    assert {round(r.score, 6) for r in alone.collect()} == {1.0}
    assert compression.score_quality(docs.limit(0), compression.Model()).count() == 0


def test_mix(spark):
    texts = [f"t{i}" for i in range(600)]
    sources = ["big"] * 400 + ["small"] * 99 + ["one"] + [None] * 100
    docs = docs_of(spark, texts, sources=sources)
    got = mixing.replicate(docs).collect()
    shares = {s: sum(r.source == s for r in got) for s in ("big", "small", "one", None)}
    assert 240 < shares["big"] < 350 and 110 < shares["small"] < 190 and 110 < shares[None] < 190 and 0 < shares["one"] < 40
    assert all(1 <= r.copy <= r.n_copies for r in got) and len({(r.doc_id, r.copy) for r in got}) == len(got)
    again = mixing.replicate(docs.repartition(3)).collect()
    assert sorted(r.shuffle_key for r in again) == sorted(r.shuffle_key for r in got)
    only = mixing.replicate(docs, weights={"one": 1.0}, total=2000).collect()
    assert {r.source for r in only} == {"one"} and 1700 < len(only) < 2300
    assert mixing.replicate(docs.limit(0)).count() == 0


def test_mix_of_repeated_rows_null_ids_and_null_texts(spark):
    docs = docs_of(spark, ["a", "a", None, "b"], [1, 1, None, None])
    rates = {r.source: r.rate for r in mixing.rates(docs).collect()}
    assert rates == {"s": pytest.approx(1.0)}
    got = mixing.replicate(docs, total=400).groupBy("doc_id", "text").agg(F.count("*").alias("n"), F.max("n_copies").alias("each")).collect()
    assert {(r.doc_id, r.text): r.n // r.each for r in got} == {(1, "a"): 2, (None, None): 1, (None, "b"): 1}


def test_draws_follow_the_distribution(spark):
    docs = spark.range(1, 4001).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    for mean in (0.5, 40.0):
        n = {r.doc_id: r.n for r in mixing.replicate(docs, total=int(4000 * mean)).groupBy("doc_id").agg(F.max("n_copies").alias("n")).collect()}
        values = np.array([n.get(i, 0) for i in range(1, 4001)])
        assert values.mean() == pytest.approx(mean, rel=0.05) and values.var() == pytest.approx(mean, rel=0.1)
