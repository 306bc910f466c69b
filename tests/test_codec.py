import json

import plain
import pytest
from pyspark.sql import functions as F

from tokenlake.operators import bpe, codec, stats
from tokenlake.operators.tokenizer import Merge, Tokenizer
from tokenlake.sources import tokenizer_io

EOT = "<|endoftext|>"
TEXTS = [
    "", " ", "The cat sat on the mat.", f"{EOT} hi", f"a{EOT}{EOT}b{EOT}", "naïve  café\r\n\r\n\U0001f600", "aaaa aaa aa a",
]


@pytest.fixture(scope="module")
def tok(spark, data):
    return bpe.train_bpe(spark.read.parquet(f"{data}/documents.parquet"), 257 + 150, [EOT])


@pytest.fixture(scope="module")
def docs(spark, data):
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").union(extra).cache()


def test_a_special_last_file_encodes_the_same_from_tables_and_json(spark, tok, docs, tmp_path):
    # Bytes, merges, then specials in another order than they are stripped in.
    specials = ["<|b|>", EOT]
    tokens = [t for t, kind in zip(tok.token_bytes, tok.kinds()) if kind != "special"] + [s.encode() for s in specials]
    moved = {old: new for new, old in enumerate(i for i, kind in enumerate(tok.kinds()) if kind != "special")}
    document = {
        "vocab": {str(i): list(t) for i, t in enumerate(tokens)},
        "merges": [[moved[m.a], moved[m.b]] for m in tok.merges],
        "special_tokens": specials[::-1],
    }
    (tmp_path / "given.json").write_text(json.dumps(document))
    given = tokenizer_io.load_json(spark, str(tmp_path / "given.json"))
    assert given.token_bytes == tokens and given.specials == tuple(specials[::-1])
    tokenizer_io.save_tables(spark, given, str(tmp_path / "t"))
    from_tables = tokenizer_io.load_tables(spark, str(tmp_path / "t"))
    tokenizer_io.save_json(spark, from_tables, str(tmp_path / "j"))
    from_json = tokenizer_io.load_json(spark, str(tmp_path / "j"))
    want = encoded_ids(codec.encode(docs, given))
    assert max(map(max, filter(None, want.values()))) == len(tokens) - 1
    for again in (from_tables, from_json):
        assert again.token_bytes == tokens and again.specials == given.specials
        assert [(m.a, m.b) for m in again.merges] == [(m.a, m.b) for m in given.merges]
        assert encoded_ids(codec.encode(docs, again)) == want
    kinds = {r["kind"]: r["n"] for r in from_tables.vocab_table(spark).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"byte": 256, "special": 2, "merge": 150}
    made = from_tables.merges_table(spark).collect()
    assert [r["new_id"] for r in made] == list(range(256, 406))


def test_a_vocabulary_with_gaps_or_without_its_specials_is_refused(spark, tmp_path):
    whole = {str(i): [i] for i in range(256)}
    for vocab, specials in (({**whole, "257": [1, 2]}, []), (whole, [EOT]), ({**whole, "7": [8]}, [])):
        (tmp_path / "bad.json").write_text(json.dumps({"vocab": vocab, "merges": [], "special_tokens": specials}))
        with pytest.raises(ValueError):
            tokenizer_io.load_json(spark, str(tmp_path / "bad.json"))


def encoded_ids(df):
    return {r["doc_id"]: list(r["ids"]) for r in df.collect()}


@pytest.mark.parametrize("method", ["fold", "arrow"])
def test_encode_equals_the_rank_loop(docs, tok, method):
    wanted = {
        r["doc_id"]: plain.encode_text(r["text"], tok.encode_rules(), {EOT: 256})
        for r in docs.collect()
        if len(r["text"]) < 3000
    }
    coded = codec.encode(docs, tok, method=method)
    got = encoded_ids(coded)
    assert {i: got[i] for i in wanted} == wanted
    assert coded.filter(F.col("n_tokens") != F.size("ids")).count() == 0


@pytest.mark.parametrize("method", ["fold", "arrow"])
def test_round_trip(docs, tok, method):
    row = codec.roundtrip_check(docs, tok, method=method).first()
    assert (row["n_docs"], row["n_failed"]) == (docs.count(), 0)


def test_encode_and_decode_do_not_shuffle(docs, tok):
    for method in ("fold", "arrow"):
        coded = codec.encode(docs, tok, method=method)
        for frame in (coded, codec.decode(coded, tok)):
            assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_decode_by_join_equals_lookup(docs, tok):
    coded = codec.encode(docs, tok).cache()
    back = codec.decode(coded, tok, method="join")
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


def test_same_bytes_of_two_merges_use_the_last_id(spark):
    # 256 = bc, 257 = a+bc, 258 = ab, 259 = ab+c: 257 and 259 spell the same.
    tok = Tokenizer((Merge(98, 99), Merge(97, 256), Merge(97, 98), Merge(258, 99), Merge(259, 259), Merge(257, 257)))
    df = spark.createDataFrame([(1, "abcabc abc bcabcc")], "doc_id long, text string")
    wanted = {1: plain.encode_text("abcabc abc bcabcc", tok.encode_rules(), {})}
    assert encoded_ids(codec.encode(df, tok, method="fold")) == wanted
    assert encoded_ids(codec.encode(df, tok, method="arrow")) == wanted
    assert 257 not in wanted[1]


def test_ids_beyond_the_surrogate_range(spark):
    # Many merges that never apply push the last ids past 0xD800.
    idle = [Merge(200 + i % 50, 200 + i // 50 % 50) for i in range(60_000)]
    tok = Tokenizer((*idle, Merge(97, 98), Merge(60_256, 99)))
    df = spark.createDataFrame([(1, "abcab")], "doc_id long, text string")
    assert encoded_ids(codec.encode(df, tok)) == {1: [60_257, 60_256]}
    assert codec.roundtrip_check(df, tok).first()["n_failed"] == 0


def test_malformed_bytes_decode_with_replacement(spark):
    cases = ["6162ff", "e282", "e28261", "f09f98", "c0af", "eda080", "f5808080", "8080", "c3a9"]
    rows = [(i, list(bytes.fromhex(h))) for i, h in enumerate(cases)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for method in ("lookup", "join"):
        got = {r["doc_id"]: r["text"] for r in codec.decode(df, Tokenizer(), method=method).collect()}
        assert got == {i: bytes.fromhex(h).decode("utf-8", "replace") for i, h in enumerate(cases)}


def test_unknown_ids_fail(spark):
    df = spark.createDataFrame([(1, [97, 9999])], "doc_id long, ids array<int>")
    for method in ("lookup", "join"):
        with pytest.raises(Exception, match="unknown token id 9999"):
            codec.decode(df, Tokenizer(), method=method).collect()


def test_compression_ratio_is_a_ratio_of_sums(spark):
    tok = Tokenizer((Merge(97, 97),))
    df = spark.createDataFrame([(1, "aaaa", "x"), (2, "bb", "x"), (3, "", "y")], "doc_id long, text string, lang string")
    rows = {r["lang"]: r for r in stats.compression_ratio(df, tok, ["lang"]).collect()}
    assert (rows["x"]["n_bytes"], rows["x"]["n_tokens"], rows["x"]["ratio"]) == (6, 4, 1.5)
    assert (rows["y"]["n_bytes"], rows["y"]["n_tokens"], rows["y"]["ratio"]) == (0, 0, 0.0)
    assert stats.compression_ratio(df, tok).count() == 1


def test_throughput_report(spark, docs, tok):
    row = stats.throughput_report(docs, tok).first()
    assert row["n_bytes"] > 0 and row["bytes_per_sec"] > 0 and row["projected_hours"] > 0


def test_sample_docs_takes_the_first_in_order(spark, docs):
    assert [r["doc_id"] for r in stats.sample_docs(docs, 3).collect()] == [0, 1, 2]


def test_tokenizer_files(spark, tok, tmp_path):
    tokenizer_io.save_tables(spark, tok, str(tmp_path / "tables"))
    loaded = tokenizer_io.load_tables(spark, str(tmp_path / "tables"))
    assert loaded == tok and loaded.token_bytes == tok.token_bytes
    tokenizer_io.save_json(spark, tok, str(tmp_path / "json"))
    loaded = tokenizer_io.load_json(spark, str(tmp_path / "json"))
    assert loaded.token_bytes == tok.token_bytes and loaded.encode_rules() == tok.encode_rules()
    # A single file from elsewhere.
    document = {
        "vocab": {str(i): list(t) for i, t in enumerate(tok.token_bytes)},
        "merges": [[m.a, m.b] for m in tok.merges],
        "special_tokens": [EOT],
    }
    (tmp_path / "one.json").write_text(json.dumps(document))
    assert tokenizer_io.load_json(spark, str(tmp_path / "one.json")).encode_rules() == tok.encode_rules()


def test_decode_by_join_keeps_repeated_keys_and_null(spark):
    rows = [(1, [97, 98]), (1, [99]), (None, [100]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for method in ("lookup", "join"):
        got = [(r["doc_id"], r["text"]) for r in codec.decode(df, Tokenizer(), method=method).collect()]
        assert sorted(got, key=str) == sorted([(1, "ab"), (1, "c"), (None, "d"), (2, None), (3, "")], key=str)


def test_merges_out_of_learning_order_follow_the_lowest_rank(spark, monkeypatch):
    df = spark.createDataFrame([(1, "abc ababc abab")], "doc_id long, text string")
    # 256 = ab+c before 257 = ab; and 256 = ab+a, which a single merge makes best.
    for merges in ((Merge(257, 99), Merge(97, 98)), (Merge(257, 97), Merge(97, 98))):
        table = {257: b"ab", 256: b"ab" + bytes([merges[0].b])}
        vocab = (*[bytes([i]) for i in range(256)], table[256], table[257])
        tok = Tokenizer(merges, loaded_vocab=vocab)
        monkeypatch.setattr(Tokenizer, "encode_rules", lambda self: [(257, self.merges[0].b, 256), (97, 98, 257)])
        wanted = {1: plain.encode_text("abc ababc abab", tok.encode_rules(), {})}
        for bound in (0, 2_000):
            monkeypatch.setattr(codec, "RULES_PER_PASS", bound)
            for method in ("auto", "fold", "arrow"):
                assert encoded_ids(codec.encode(df, tok, method=method)) == wanted
        assert 256 in wanted[1]


def test_a_large_batch_is_encoded_by_slices(spark, tok):
    texts = ["some words and others " * 40 * (i % 50) for i in range(400)] + [None, "", "x" * (codec.SLICE_BYTES + 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = df.orderBy("doc_id").select(codec.marked_words(F.col("text"), tok).alias("m")).toArrow().column("m").combine_chunks()
    parts = list(codec.arrow_encoder(df, tok).func(iter([marked.slice(0, 0), marked])))
    # No piece has more than a slice, unless it is one text.
    assert all(len(p) == 1 or len(p.flatten()) <= codec.SLICE_BYTES for p in parts) and len(parts) > 4
    got = [ids for p in parts for ids in p.to_pylist()]
    assert got == [None if t is None else plain.encode_text(t, tok.encode_rules(), {EOT: 256}) if len(t) < 3000 else got[i] for i, t in enumerate(texts)]
    want = codec.encode(df.filter("text IS NOT NULL"), tok, method="fold").orderBy("doc_id").collect()
    assert [ids for ids in got if ids is not None] == [r["ids"] for r in want]
