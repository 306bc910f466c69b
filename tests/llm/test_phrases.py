"""Phrase mining against a plain count of all phrases, and the filters it counts with."""

import re
from collections import Counter

import numpy as np
import pytest

from tokenlake.llm import phrase_mining
from tokenlake.llm.phrase_mining import mine_phrases, top_phrases
from tokenlake.llm.quotient_filter import WORD, CountingFilter, Layout


def plain(rows, least, longest, cover):
    """{(lang, phrase): (a, l, r, n, score)}"""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    key = (lang, tuple(words[i : i + m]))
                    counts[key] = counts.get(key, 0) + 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        within = [f for (g, w), f in candidates.items() if g == lang and len(w) > len(words) and 100 * f >= cover * a and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if within:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang, " ".join(words)] = (a, left, right, totals[lang], score)
    return out


def texts():
    rng = np.random.default_rng(5)
    names = ["The", "the", "of", "a\u00a0b", "é", "new", "york", "city", "in", "x" * 80, "to", "be", "or", "not"]
    rows = []
    for i in range(60):
        words = [names[j] for j in rng.zipf(1.6, 60).clip(1, len(names)) - 1]
        text = " ".join(words) + ". New York city!\tto  be or\tnot to be\x0bTo be, or: not"
        rows.append((["en", "en", "de", None][i % 4], text))
    hot = "hot pair " * 300
    return rows + [("en", None), ("en", ""), (None, None), ("en", " \n,,\t"), ("en", hot), ("en", hot), ("fr", "seul"), ("und", "to be or not")] + [("en", "same row here")] * 5


def got(df):
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("setting,cover", [("as it is", 100), ("words joined", 60), ("short rows", 100), ("few places", 60)])
def test_phrases_as_by_a_plain_count(spark, monkeypatch, setting, cover):
    if setting == "words joined":
        monkeypatch.setattr(phrase_mining, "SHARED_WORDS", 3)
    if setting == "short rows":
        monkeypatch.setattr(phrase_mining, "ROW_IDS", 7)
        monkeypatch.setattr(phrase_mining, "SHARED_BYTES", 2)
    if setting == "few places":
        monkeypatch.setattr(phrase_mining, "PLACES", 50)
        monkeypatch.setattr(phrase_mining, "WORDS_AT_ONCE", 4)
        monkeypatch.setattr(phrase_mining, "BUCKET", 100)
    rows = texts()
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "lang string, text string, f long, ids string, word string").repartition(3)
    want = plain(rows, 5, 5, cover)
    assert got(mine_phrases(df, least=5, cover=cover)) == want and len(want) > 20
    assert any(len(p) > 80 for _, p in want)


def test_a_text_of_a_million_words_and_no_text(spark):
    text = "one two three " * 350_000
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    n = 1_050_000
    found = got(mine_phrases(df, least=100_000))
    assert found == plain([("en", text)], 100_000, 5, 100) and {v[3] for v in found.values()} == {n}
    assert mine_phrases(df.limit(0)).count() == 0 and mine_phrases(df.selectExpr("lang", "'a b' AS text")).count() == 0


def test_ranks_break_ties_by_count_and_bytes(spark):
    rows = [("en", p, a, 1, 1, 9, s) for p, a, s in [("b", 5, 7), ("a", 5, 7), ("é", 5, 7), ("z", 6, 7), ("c", 1, 8)]] + [("de", "q", 1, 1, 1, 9, 1)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    ranked = {(r["lang"], r["rank"]): r["phrase"] for r in top_phrases(df, top=4).collect()}
    assert ranked == {("en", 1): "c", ("en", 2): "z", ("en", 3): "a", ("en", 4): "b", ("de", 1): "q"}


def test_scores_pass_64_bits(spark):
    from tokenlake.workspace import Workspace

    schema = "ids array<int>, f long"
    big = 10**13
    phrases = spark.createDataFrame([([1], big), ([2], big - 1), ([1, 2], big - 7)], schema)
    words = type("W", (), {"words": spark.createDataFrame([("en", "a", big, 1), ("en", "b", big - 1, 2)], "lang string, word string, f long, id long")})
    n = spark.createDataFrame([("en", 10**14 - 1)], "lang string, n long")
    row = phrase_mining.score_phrases(phrases, words, n, Workspace(spark, "t"), 100).first()
    assert row["score"] == 1000 * (big - 7) * (10**14 - 1) // (big * (big - 1))


@pytest.mark.parametrize("n,bits,prefix", [(2, 1, 0), (2, 3, 1), (3, 17, 5), (4, 16, 9), (5, 12, 6), (5, 25, 3), (5, 32, 8)])
def test_filters_keep_every_key_and_count(n, bits, prefix):
    layout, rng = Layout(n, bits, prefix), np.random.default_rng(n * bits)
    cells = [rng.integers(0, min(1 << bits, 40), 2000).astype(WORD) for _ in range(n)]
    shards, buckets = [slice(0, 700), slice(700, 701), slice(701, 2000)], {}
    for shard in shards:
        for bucket, data in CountingFilter.count(layout, [c[shard] for c in cells]).buckets():
            buckets.setdefault(bucket, []).append(CountingFilter.read(layout, bucket, data))
    found = Counter()
    for filters in buckets.values():
        ids, counts = CountingFilter.merge(filters).at_least(1)
        found.update(dict(zip(zip(*(c.tolist() for c in ids)), counts.tolist())))
    assert found == Counter(zip(*(c.tolist() for c in cells)))
    assert len(buckets) <= 1 << prefix


def test_counters_of_any_size_are_kept():
    layout = Layout(3, 20, 0)
    cells = [np.arange(6).astype(WORD) for _ in range(3)]
    counts = np.array([1, 2, 255, 256, 257, 10**15])
    held = CountingFilter.of(layout, layout.pack(layout.permute(cells)), counts)
    ((bucket, data),) = held.buckets()
    ids, found = CountingFilter.read(layout, bucket, data).at_least(1)
    assert dict(zip(ids[0].tolist(), found.tolist())) == dict(enumerate(counts.tolist()))
    assert len(data) < 6 * 16
