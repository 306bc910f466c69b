import random
from collections import Counter

import plain
import pytest

from tokenlake.functions import chars
from tokenlake.operators import bpe, pretoken
from tokenlake.operators.tokenizer import vocab_stats
from tokenlake.sources.job_checkpoint import JobCheckpoint, OtherJobError

EOT = "<|endoftext|>"


def words_frame(spark, words):
    rows = [("".join(chars.symbol(i) for i in w), n) for w, n in words.items()]
    return spark.createDataFrame(rows, "word string, freq long")


@pytest.fixture(scope="module")
def texts(spark, data):
    return [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]


@pytest.fixture(scope="module")
def learned(texts):
    return plain.learn(plain.words_of(texts, [EOT]), 40, 257)


def triples(merges):
    return [(m.a, m.b, m.cnt) for m in merges]


def test_learns_the_same_merges_as_a_recount(spark, data, learned):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    tok = bpe.train_bpe(docs, 257 + 40, [EOT])
    assert triples(tok.merges) == learned


@pytest.mark.parametrize("settings", [{"leaders_limit": 8, "sample_words": 4}, {"max_guesses": 1}, {"rounds_per_table": 1}])
def test_bounds_of_the_loop_do_not_change_the_result(spark, texts, learned, settings):
    words = words_frame(spark, plain.words_of(texts, [EOT]))
    assert triples(bpe.train_bpe_words(words, 25, 257, **settings)) == learned[:25]


def test_random_words_with_many_ties_and_runs(spark):
    rng = random.Random(5)
    for _ in range(3):
        words = Counter()
        for _ in range(60):
            words[tuple(rng.choice((97, 98, 99)) for _ in range(rng.randint(1, 9)))] += rng.randint(1, 3)
        wanted = plain.learn(words, 30, 256)
        got = bpe.train_bpe_words(words_frame(spark, words), 30, 256, leaders_limit=5, sample_words=10)
        assert triples(got) == wanted


def test_stops_when_no_pair_is_left(spark):
    words = words_frame(spark, {(97, 98): 3, (99,): 5})
    assert triples(bpe.train_bpe_words(words, 10)) == [(97, 98, 3)]
    assert bpe.train_bpe_words(words, 0) == []
    docs = spark.createDataFrame([(1, "ab ab")], "doc_id long, text string")
    assert bpe.train_bpe(docs, 100, [EOT]).vocab_size == 257


def test_resumes_from_a_saved_state(spark, texts, learned, tmp_path):
    words = words_frame(spark, plain.words_of(texts, [EOT]))
    states = JobCheckpoint(spark, str(tmp_path / "bpe"))
    bpe.train_bpe_words(words, 15, 257, checkpoint=states, save_every=5)
    assert states.steps()
    (tmp_path / "bpe" / "step=000000999").mkdir()  # an interrupted state without its description
    assert states.latest().step < 999
    assert triples(bpe.train_bpe_words(words.repartition(3), 25, 257, checkpoint=states)) == learned[:25]
    # Another corpus or another first id is another job.
    for other, first in ((words.limit(5), 257), (words, 258), (words.limit(0), 257)):
        with pytest.raises(OtherJobError):
            bpe.train_bpe_words(other, 25, first, checkpoint=states)


def test_pair_counts_and_deltas_equal_recounts(spark):
    words = Counter({(97, 97, 97): 2, (97, 97, 97, 97): 1, (98, 97, 97, 98): 4, (97,): 9, (97, 98, 97, 98): 3})
    for pair in ((97, 97), (97, 98), (98, 97)):
        frame = words_frame(spark, words)
        counts = bpe.pair_counts(frame)
        found = {(r["a"], r["b"]): r["cnt"] for r in counts.collect()}
        assert found == dict(plain.recount(words))
        assert sum(found.values()) == sum(n * (len(w) - 1) for w, n in words.items())
        after = {}
        for w, n in words.items():
            m = plain.merged(w, pair, 300)
            after[m] = after.get(m, 0) + n
        delta = bpe.pair_count_delta(frame, counts, *pair, 300)
        assert {(r["a"], r["b"]): r["cnt"] for r in delta.collect()} == dict(plain.recount(after))
        merged = bpe.merge_words(frame, *pair, 300).collect()
        assert {tuple(chars.id_of(c) for c in r["word"]): r["freq"] for r in merged} == after


def test_best_pair_ties_go_to_the_larger_ids(spark):
    counts = spark.createDataFrame([(1, 2, 5), (200, 1, 5), (9, 9, 4)], "a int, b int, cnt long")
    row = bpe.best_pair(counts).first()
    assert (row["a"], row["b"], row["cnt"]) == (200, 1, 5)
    assert bpe.best_pair(counts.limit(0)).count() == 0


def test_max_bytes_trains_on_the_start_of_the_corpus(spark):
    docs = spark.createDataFrame([(1, "ab" * 10), (2, "cd" * 50)], "doc_id long, text string")
    tok = bpe.train_bpe(docs, 257, max_bytes=20)
    assert (tok.merges[0].a, tok.merges[0].b) == (97, 98)
    tok = bpe.train_bpe(docs, 257)
    assert (tok.merges[0].a, tok.merges[0].b) == (99, 100)


def test_vocab_stats(spark):
    docs = spark.createDataFrame([(1, "abab abab abab")], "doc_id long, text string")
    tok = bpe.train_bpe(docs, 256 + 1 + 2, ["<x>"])
    row = vocab_stats(tok.vocab_table(spark)).first()
    assert row["vocab_size"] == 259
    assert bytes(row["longest_token"]) == b"abab"
    kinds = tok.vocab_table(spark).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in kinds} == {"byte": 256, "special": 1, "merge": 2}


def test_round_has_no_single_partition_or_product(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    words = pretoken.word_table(pretoken.pretoken_freq(docs))
    for frame in (bpe.pair_counts(words), bpe.staged_deltas(words, [(97, 98, 256), (99, 256, 257)])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
