import os
import time

import pytest

from tokenlake.operators import bpe, codec, pretoken
from tokenlake.streaming import corpus

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def pieces(spark, data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("arriving"))
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    docs.repartition(3, "doc_id").write.mode("overwrite").parquet(folder)
    return folder, docs


def stream(spark, folder):
    return corpus.stream_corpus(spark, folder, SCHEMA, max_files_per_batch=1)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_streams_equal_batches_and_take_up_new_files(spark, pieces, tmp_path):
    folder, docs = pieces
    tok = bpe.train_bpe(docs, 257 + 20, ["<|endoftext|>"])
    out, state = str(tmp_path / "enc"), str(tmp_path / "enc-state")
    corpus.stream_encode(stream(spark, folder), tok, out, state)
    assert same(spark.read.parquet(out), codec.encode(docs, tok))

    freq, freq_state = str(tmp_path / "freq"), str(tmp_path / "freq-state")
    corpus.stream_pretoken_freq(stream(spark, folder), freq, freq_state)
    assert same(corpus.latest_freq(spark, freq), pretoken.pretoken_freq(docs))

    stats, stats_state = str(tmp_path / "stats"), str(tmp_path / "stats-state")
    corpus.stream_corpus_stats(stream(spark, folder), tok, stats, stats_state)
    per_batch = corpus.batch_stats(spark, stats).orderBy("batch").collect()
    assert len(per_batch) == 3
    assert per_batch[0]["tokens_per_sec"] is None and per_batch[1]["tokens_per_sec"] > 0
    row = corpus.running_stats(spark, stats).first()
    assert row["n_docs"] == docs.count()
    assert row["n_tokens"] == codec.encode(docs, tok).agg({"n_tokens": "sum"}).first()[0]

    more = spark.createDataFrame([(100_000, "new new words")], SCHEMA)
    more.write.mode("append").parquet(folder)
    grown = docs.union(more)
    corpus.stream_pretoken_freq(stream(spark, folder), freq, freq_state)
    assert same(corpus.latest_freq(spark, freq), pretoken.pretoken_freq(grown))
    corpus.stream_encode(stream(spark, folder), tok, out, state)
    assert same(spark.read.parquet(out), codec.encode(grown, tok))


def test_counts_are_read_from_a_snapshot_and_recent_batches(spark, pieces, tmp_path):
    _, docs = pieces
    folder, out, state = (str(tmp_path / n) for n in ("in", "freq", "state"))
    docs.limit(60).repartition(7, "doc_id").write.parquet(folder)
    corpus.stream_pretoken_freq(stream(spark, folder), out, state, compact_every=2)
    want = pretoken.pretoken_freq(spark.read.schema(SCHEMA).parquet(folder))
    assert same(corpus.latest_freq(spark, out), want)
    held = sorted(n for n in os.listdir(out) if "=" in n)
    assert held == ["batch=4", "batch=5", "batch=6", "snapshot=3", "snapshot=5"]
    # Batches and snapshots that run again, or are broken off, change nothing.
    spark.createDataFrame([("the", 1)], "pretoken string, freq bigint").write.parquet(f"{out}/batch=1")
    corpus.compact_freq(spark, out, 5)
    os.mkdir(f"{out}/snapshot=6")
    assert same(corpus.latest_freq(spark, out), want)
    files = corpus.latest_freq(spark, out).inputFiles()
    assert {f.split("/")[-2] for f in files} == {"snapshot=5", "batch=6"}
    corpus.compact_freq(spark, out, 6)
    assert same(corpus.latest_freq(spark, out), want)


def test_a_stream_goes_on_until_it_is_stopped(spark, data, pieces, tmp_path):
    _, docs = pieces
    folder, out, state = (str(tmp_path / n) for n in ("in", "freq", "state"))
    first, second, third = docs.filter("doc_id < 10"), docs.filter("doc_id between 10 and 19"), docs.filter("doc_id between 20 and 24")
    first.coalesce(1).write.parquet(folder)

    def wait_for(query, rows):
        want, deadline = pretoken.pretoken_freq(rows), time.time() + 60
        while time.time() < deadline:
            query.processAllAvailable()
            if same(corpus.latest_freq(spark, out), want):
                return True
        return False

    query = corpus.stream_pretoken_freq(stream(spark, folder), out, state, every="200 milliseconds")
    assert query.isActive and wait_for(query, first)
    second.coalesce(1).write.mode("append").parquet(folder)
    assert wait_for(query, first.union(second)) and query.isActive
    query.stop()
    third.coalesce(1).write.mode("append").parquet(folder)
    resumed = corpus.stream_pretoken_freq(stream(spark, folder), out, state, every="200 milliseconds")
    assert wait_for(resumed, first.union(second).union(third))
    resumed.stop()
    assert not resumed.isActive


def test_a_table_that_is_a_folder_streams_like_one_file(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    docs.limit(1).write.parquet(str(tmp_path / "in" / "other.parquet"))
    tok = bpe.train_bpe(docs, 257 + 5, ["<|endoftext|>"])

    def folder():
        return corpus.stream_corpus(spark, str(tmp_path / "in"), SCHEMA, "documents.parquet", spread_by="doc_id")

    out = [str(tmp_path / name) for name in ("enc", "enc-state", "stats", "stats-state", "freq", "freq-state")]
    corpus.stream_encode(folder(), tok, *out[:2])
    assert same(spark.read.parquet(out[0]), codec.encode(docs, tok))
    corpus.stream_corpus_stats(folder(), tok, *out[2:4])
    assert corpus.running_stats(spark, out[2]).first()["n_docs"] == 20
    corpus.stream_pretoken_freq(folder(), *out[4:])
    assert same(corpus.latest_freq(spark, out[4]), pretoken.pretoken_freq(docs))
