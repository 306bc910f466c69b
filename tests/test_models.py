import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tokenlake.operators import dataset, ngram
from tokenlake.operators.skew import join_groups, salted_join, table_bytes
from tokenlake.sources import token_store
from tokenlake.workspace import Workspace

SEQUENCES = {1: [5, 6, 5, 6, 7], 2: [5], 3: [], 4: [6, 7, 7, 7, 5, 6], 5: list(range(40)) * 30}


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(i, ids, len(ids)) for i, ids in SEQUENCES.items()]
    return spark.createDataFrame(rows, "doc_id long, ids array<int>, n_tokens int").cache()


def plain_counts():
    return Counter(p for ids in SEQUENCES.values() for p in zip(ids, ids[1:]))


def test_pairs_and_counts(encoded):
    pairs = dataset.next_token_pairs(encoded)
    assert pairs.count() == sum(max(0, len(s) - 1) for s in SEQUENCES.values())
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    counts = ngram.fit_ngram(ngram.context_pairs(encoded)).collect()
    assert {(r["context"], r["target"]): r["cnt"] for r in counts} == dict(plain_counts())
    second = ngram.fit_ngram(ngram.context_pairs(encoded, 2)).collect()
    want = Counter(t for s in SEQUENCES.values() for t in zip(s, s[1:], s[2:]))
    assert {(*divmod(r["context"], 1 << 21), r["target"]): r["cnt"] for r in second} == dict(want)


def test_stream_positions(encoded):
    flat = [t for i in sorted(SEQUENCES) for t in SEQUENCES[i]]
    stream = dataset.token_stream(encoded).orderBy("pos").collect()
    assert [r["token"] for r in stream] == flat
    assert [r["pos"] for r in stream] == list(range(len(flat)))


@pytest.mark.parametrize("length", [3, 50, 1100])
def test_sampled_windows(encoded, length, monkeypatch):
    flat = [t for i in sorted(SEQUENCES) for t in SEQUENCES[i]]
    rows = dataset.sample_windows(encoded, 40, length, 3).collect()
    assert sorted(r["sample_id"] for r in rows) == list(range(40))
    for r in rows:
        assert 0 <= r["start"] < len(flat) - length - 1
        assert r["tokens"] == flat[r["start"] : r["start"] + length]
    monkeypatch.setattr(token_store, "NAMED_BLOCKS", 0)
    shuffled = dataset.sample_windows(encoded, 40, length, 3)
    assert "CartesianProduct" not in shuffled._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, rows))


def test_too_short_a_stream(encoded):
    with pytest.raises(ValueError):
        dataset.sample_windows(encoded, 1, 10_000)


def test_log_softmax_sums_to_one(spark):
    rows = [(c, t, 700.0 * c + t / 10) for c in range(4) for t in range(50)]
    out = ngram.log_softmax(spark.createDataFrame(rows, "context long, target int, logit double"))
    sums = out.groupBy("context").agg(F.sum(F.exp("logp")).alias("s")).collect()
    assert len(sums) == 4 and all(abs(r["s"] - 1) < 1e-9 for r in sums)


def test_log_softmax_is_one_shuffle_and_no_job(spark):
    rows = [(c, t, float(t)) for c in range(4) for t in range(50)]
    logits = spark.createDataFrame(rows, "context long, target int, logit double").withColumn("row", F.lit("kept"))
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    out = ngram.log_softmax(logits)
    top = ngram.next_token_topk(logits, 5, 0.5)
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (out, top)]
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == before
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 1] and "Join" not in "".join(plans)
    assert out.columns == ["context", "target", "logit", "row", "logp"] and out.select("row").distinct().count() == 1
    assert top.count() == 20 and all(abs(r["p"] - 1) < 1e-9 for r in top.groupBy("context").agg(F.sum("prob").alias("p")).collect())


def test_a_draw_without_a_context_comes_from_the_vocabulary(spark):
    topk = spark.createDataFrame([(1, 2, 0.0)], "context long, token int, logit double")
    states = spark.createDataFrame([(i, None) for i in range(50)] + [(50, 1)], "item_id long, context long")
    drawn = {r["item_id"]: r["token"] for r in ngram.sample_next(states, topk, 10, 3).collect()}
    assert drawn[50] == 2 and set(drawn.values()) <= set(range(10)) and len(set(drawn.values())) > 4


def test_cross_entropy_and_perplexity(encoded):
    counts, alpha, v = plain_counts(), 0.5, 64
    totals = defaultdict(int)
    for (c, _), n in counts.items():
        totals[c] += n
    model = ngram.fit_ngram(ngram.context_pairs(encoded))
    held = encoded.select("doc_id", F.reverse("ids").alias("ids"))
    pairs = [(i, p) for i, s in SEQUENCES.items() for p in zip(s[::-1], s[::-1][1:])]
    nll = lambda p: -math.log((counts.get(p, 0) + alpha) / (totals.get(p[0], 0) + alpha * v))
    row = ngram.cross_entropy(ngram.context_pairs(held), model, v, alpha).first()
    assert row["n_pairs"] == len(pairs)
    assert row["mean_nll"] == pytest.approx(sum(nll(p) for _, p in pairs) / len(pairs))
    per_doc = defaultdict(list)
    for i, p in pairs:
        per_doc[i].append(nll(p))
    got = ngram.perplexity(ngram.context_pairs(held), model, v, ["doc_id"], alpha).collect()
    assert {r["doc_id"]: r["ppl"] for r in got} == pytest.approx(
        {i: math.exp(sum(x) / len(x)) for i, x in per_doc.items()}
    )


def test_topk_keeps_ties_and_renormalises(spark):
    rows = [(1, 10, 3.0), (1, 11, 2.0), (1, 12, 2.0), (1, 13, 1.0), (2, 20, 0.0)]
    logits = spark.createDataFrame(rows, "context long, target int, logit double")
    kept = ngram.next_token_topk(logits, 2, 0.5).collect()
    assert {(r["context"], r["token"]) for r in kept} == {(1, 10), (1, 11), (1, 12), (2, 20)}
    assert {r["token"]: r["logit"] for r in kept}[10] == 6.0
    by = defaultdict(float)
    for r in kept:
        by[r["context"]] += r["prob"]
    assert by == pytest.approx({1: 1.0, 2: 1.0})
    assert ngram.next_token_topk(logits, 0).count() == 5
    assert ngram.next_token_topk(logits, 99, 0.0).filter("token = 10").first()["logit"] == 3.0
    plan = ngram.next_token_topk(logits, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_draws_are_seeded_and_follow_the_probabilities(spark):
    logits = spark.createDataFrame([(1, 0, math.log(3.0)), (1, 1, 0.0)], "context long, target int, logit double")
    top = ngram.next_token_topk(logits, 0)
    states = spark.range(4000).select(F.col("id").alias("item_id"), F.lit(1).cast("long").alias("context"))
    drawn = ngram.sample_next(states, top, 10, seed=1)
    share = drawn.filter("token = 0").count() / 4000
    assert abs(share - 0.75) < 0.03
    again = ngram.sample_next(states.repartition(9), top, 10, seed=1)
    assert drawn.select("item_id", "token").exceptAll(again.select("item_id", "token")).count() == 0
    unseen = ngram.sample_next(states.withColumn("context", F.lit(99).cast("long")), top, 10, seed=1)
    bounds = unseen.agg(F.min("token"), F.max("token")).first()
    assert tuple(bounds) == (0, 9)


def test_generation_follows_the_only_path_and_stops(spark):
    rows = [(i, i + 1, 0.0) for i in range(20)]
    top = ngram.next_token_topk(spark.createDataFrame(rows, "context long, target int, logit double"), 5)
    prompts = spark.createDataFrame([(1, [0]), (2, [3, 4])], "item_id long, ids array<int>")
    out = {r["item_id"]: (r["ids"], r["n_new"]) for r in ngram.generate_batch(prompts, top, 30, 10).collect()}
    assert out == {1: (list(range(11)), 10), 2: (list(range(3, 15)), 10)}
    stopped = ngram.generate_batch(prompts, top, 30, 10, stop_token=7)
    out = {r["item_id"]: (r["ids"], r["n_new"]) for r in stopped.collect()}
    assert out == {1: (list(range(8)), 7), 2: ([3, 4, 5, 6, 7], 3)}
    empty = spark.createDataFrame([(3, [])], "item_id long, ids array<int>")
    assert ngram.generate_batch(empty, top, 30, 2).first()["n_new"] == 2


def test_finished_prompts_leave_the_loop(spark, monkeypatch):
    monkeypatch.setattr(ngram, "ROUNDS_PER_TABLE", 2)
    # 1 goes to 2, 2 to 3, and so on; 9 is the stop.
    topk = spark.createDataFrame([(i, i + 1, 0.0) for i in range(20)], "context long, token int, logit double")
    prompts = spark.createDataFrame([(s, [s]) for s in (8, 5, 0, 9, 12)] + [(99, [8])], "item_id long, ids array<int>")
    sizes, save = {}, Workspace.save

    def watch(self, df, name, *rest):
        table = save(self, df, name, *rest)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(Workspace, "save", watch)
    out = {r["item_id"]: (r["ids"], r["n_new"]) for r in ngram.generate_batch(prompts, topk, 30, 7, stop_token=9).collect()}
    assert out == {8: ([8, 9], 1), 99: ([8, 9], 1), 5: ([5, 6, 7, 8, 9], 4), 0: (list(range(8)), 7), 9: (list(range(9, 17)), 7), 12: (list(range(12, 20)), 7)}
    assert [sizes[f"live-{n}"] for n in (2, 4, 6)] == [4, 3, 3]
    ended = ngram.generate_batch(prompts.filter("item_id in (8, 5)"), topk, 30, 20, stop_token=9)
    assert ended.count() == 2 and "live-6" in sizes and sizes["live-4"] == 0


def test_joins_of_groups_agree_when_a_key_is_hot(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 40).alias("k"), "id")
    rows = rows.withColumn("k", F.when(F.col("id") == 2999, F.lit(None)).otherwise(F.col("k")))
    groups = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        wanted = sorted(map(str, rows.join(groups, "k", how).collect()))
        assert sorted(map(str, join_groups(rows, groups, ["k"], how).collect())) == wanted
        assert sorted(map(str, salted_join(rows, groups, ["k"], how, rows_per_salt=100).collect())) == wanted
    assert table_bytes(groups) == 30 * 16
