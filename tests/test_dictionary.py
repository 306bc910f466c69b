"""Encoding by a dictionary gives the ids of encoding row by row, and words are encoded once."""

import pytest
from pyspark.sql import functions as F

from tokenlake.operators import bpe, codec, dictionary, skew
from tokenlake.operators.dictionary import OtherTokenizerError, WordDictionary

EOT = "<|endoftext|>"
TEXTS = [
    "", " ", None, "The cat sat on the mat.", f"{EOT} hi", f"a{EOT}{EOT}b{EOT}", "na\u00efve  caf\u00e9\r\n\r\n\U0001f600",
    "hot " * 5000, "same row", "same row", "x" * 200_000,
]


@pytest.fixture(scope="module")
def tok(spark, data):
    return bpe.train_bpe(spark.read.parquet(f"{data}/documents.parquet").limit(60), 257 + 60, [EOT])


@pytest.fixture(scope="module")
def docs(spark, data):
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    some = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").filter("doc_id < 60")
    return some.union(extra).withColumns({"row": F.lit("r"), "ids": F.lit("i"), "word": F.lit("w")})


def rows(df):
    return sorted((r["doc_id"], None if r["ids"] is None else tuple(r["ids"]), r["n_tokens"]) for r in df.collect())


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_same_ids_as_row_by_row(spark, tok, docs, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", broadcast)
    held = WordDictionary(spark, str(tmp_path / "d"), tok)
    want = [(d, i, -1 if i is None else n) for d, i, n in rows(codec.encode(docs, tok))]
    got = [(d, i, -1 if i is None else n) for d, i, n in rows(dictionary.encode_by_dictionary(docs, held))]
    assert got == want
    n = held.table().count()
    assert n == held.table().select("word").distinct().count() and held.parts() == [0]
    # The second run finds all words, a third adds one.
    assert held.cover(held.table().select("word")) == 0
    dictionary.encode_by_dictionary(spark.createDataFrame([(1, "The unseenword")], "doc_id long, text string"), held)
    assert held.table().count() == n + 1 or held.table().count() == n + 2
    assert dictionary.encode_by_dictionary(docs.limit(0), held).count() == 0


def test_a_dictionary_knows_its_tokenizer(spark, tok, docs, tmp_path):
    held = WordDictionary(spark, str(tmp_path / "d"), tok)
    assert held.parts() == [] and held.table().count() == 0
    held.cover(spark.createDataFrame([("ab",), ("ab",), ("",)], "word string"))
    assert {r["word"]: r["ids"] for r in held.table().collect()}[""] == []
    other = WordDictionary(spark, held.path, type(tok)(tok.merges[:-1], tok.specials))
    with pytest.raises(OtherTokenizerError):
        other.table()
    # A part without its mark was broken off and is not read.
    (tmp_path / "d" / "part=1").mkdir()
    assert held.parts() == [0]


def test_the_method_follows_the_measured_share(spark, tok, docs, tmp_path):
    same = spark.createDataFrame([(i, "again and again and again") for i in range(300)], "doc_id long, text string")
    assert dictionary.distinct_share(same, tok) < 0.01 < 0.5 < dictionary.distinct_share(spark.createDataFrame([(1, "all words differ here")], "doc_id long, text string"), tok)
    assert dictionary.best_method(same, tok) == "dictionary" and dictionary.best_method(docs.limit(0), tok) == "row"
    path = str(tmp_path / "m")
    by_words = rows(dictionary.encode_measured(same, tok, path))
    assert WordDictionary(spark, path, tok).parts() == [0]
    assert rows(dictionary.encode_measured(same, tok, str(tmp_path / "none"), most=0.0)) == by_words
    assert not (tmp_path / "none").exists()


def test_a_word_is_joined_once_for_a_chunk(spark, tok, tmp_path, monkeypatch):
    joined = []
    join = dictionary.join_groups
    monkeypatch.setattr(dictionary, "join_groups", lambda words, *a: joined.append(words.count()) or join(words, *a))
    docs = spark.createDataFrame([(i, "one two three " * 200) for i in range(50)] + [(50, None)], "doc_id long, text string").repartition(2)
    got = dictionary.encode_by_dictionary(docs, WordDictionary(spark, str(tmp_path / "d"), tok))
    assert [(d, i) for d, i, _ in rows(got)] == [(d, i) for d, i, _ in rows(codec.encode(docs, tok))]
    # 30,000 places of words, a handful of distinct words in each of a few chunks.
    assert joined[0] <= 5 * 4
