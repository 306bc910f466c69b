import math

import pytest

from tokenlake.operators import trainer
from tokenlake.operators.trainer import BIAS_KEY, Run
from tokenlake.sources.job_checkpoint import JobCheckpoint, OtherJobError

EXAMPLES = {1: (1.0, {3: 0.5, 4: 0.5}), 2: (0.0, {4: 1.0}), 3: (1.0, {5: 0.25, 3: 0.75}), 4: (0.0, {})}
RUNS = (Run(0, lr=0.1, batch_size=3), Run(1, lr=0.01, batch_size=5, weight_decay=0.5))


@pytest.fixture(scope="module")
def features(spark):
    encoded = spark.createDataFrame(
        [(1, [3, 4]), (2, [4]), (3, [3, 5, 3, 3]), (4, []), (9, [1])], "doc_id long, ids array<int>"
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    return trainer.example_features(encoded, labels).cache()


def full(x):
    return {BIAS_KEY: 1.0, **x}


def predict(params, x):
    return 1 / (1 + math.exp(-sum(params[k] * v for k, v in full(x).items())))


def test_features(features):
    got = {}
    for r in features.collect():
        got.setdefault(r["doc_id"], (r["y"], {}))[1][r["param_key"]] = r["x"]
    assert got == {i: (y, full(x)) for i, (y, x) in EXAMPLES.items()}


def drawn(features, steps, seed):
    out = {}
    for r in trainer.draw_batches(features, RUNS, steps, seed).filter(f"param_key = {BIAS_KEY}").collect():
        out.setdefault((r["step"], r["run_id"]), {})[r["doc_id"]] = r["w"]
    return out


def test_batches_are_drawn_with_replacement_and_reproducibly(features):
    batches = drawn(features, 20, 1)
    assert batches == drawn(features.repartition(3), 20, 1)
    for (_, run), batch in batches.items():
        assert sum(batch.values()) == RUNS[run].batch_size
    assert any(w > 1 for b in batches.values() for w in b.values())
    assert {i for b in batches.values() for i in b} == set(EXAMPLES)


def replay(batches, steps):
    keys = {k for _, x in EXAMPLES.values() for k in full(x)}
    finals, log = {}, {}
    for run in RUNS:
        p, m, v = ({k: 0.0 for k in keys} for _ in range(3))
        for t in range(1, steps + 1):
            batch = batches[(t, run.run_id)]
            n = sum(batch.values())
            grad = {k: 0.0 for k in keys}
            for i, w in batch.items():
                y, x = EXAMPLES[i]
                for k, value in full(x).items():
                    grad[k] += w * (predict(p, x) - y) * value / n
            for k in keys:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
            p = {
                k: p[k] - run.lr * (
                    (m[k] / (1 - 0.9**t)) / (math.sqrt(v[k] / (1 - 0.999**t)) + 1e-8) + run.weight_decay * p[k]
                )
                for k in keys
            }
            each = [(w, predict(p, EXAMPLES[i][1]), EXAMPLES[i][0]) for i, w in batch.items()]
            log[(run.run_id, t)] = sum(w * -math.log(q if y else 1 - q) for w, q, y in each) / n
        finals.update({(run.run_id, k): p[k] for k in keys})
    return finals, log


def test_training_equals_a_plain_replay(features):
    trained = trainer.train_loglinear(features, RUNS, 4, seed=1, log_every=2)
    finals, log = replay(drawn(features, 4, 1), 4)
    got = {(r["run_id"], r["param_key"]): r["value"] for r in trained.params.collect()}
    assert got == pytest.approx(finals)
    rows = trained.log.collect()
    assert {(r["run_id"], r["step"]): r["loss"] for r in rows} == pytest.approx({k: x for k, x in log.items() if k[1] % 2 == 0})
    assert all(r["ppl"] == pytest.approx(math.exp(r["loss"])) and r["rate"] > 0 for r in rows)
    report = trainer.sweep_report(trained.log, RUNS).orderBy("step").collect()
    assert [r["step"] for r in report] == [2, 4]
    assert report[1]["run_1"] == pytest.approx(log[(1, 4)])


def test_resumed_training_ends_the_same(spark, features, tmp_path):
    whole = trainer.train_loglinear(features, RUNS, 4, seed=1)
    states = JobCheckpoint(spark, str(tmp_path / "train"))
    trainer.train_loglinear(features, RUNS, 2, seed=1, save_every=1, checkpoint=states)
    assert states.steps() == [1, 2]
    resumed = trainer.train_loglinear(features, RUNS, 4, seed=1, save_every=1, checkpoint=states)
    want = {(r["run_id"], r["param_key"]): r["value"] for r in whole.params.collect()}
    assert {(r["run_id"], r["param_key"]): r["value"] for r in resumed.params.collect()} == pytest.approx(want)
    assert resumed.log.count() == whole.log.count() == 8
    with pytest.raises(OtherJobError):
        trainer.train_loglinear(features, RUNS, 4, seed=2, checkpoint=states)
    with pytest.raises(OtherJobError):
        trainer.train_loglinear(features.filter("doc_id > 0"), RUNS[:1], 4, seed=1, checkpoint=states)


def test_moments_decay_without_a_gradient(spark):
    params = spark.createDataFrame([(0, 7, 1.0, 0.2, 0.3)], "run_id int, param_key long, value double, m double, v double")
    grads = spark.createDataFrame([], "run_id int, param_key long, grad double")
    row = trainer.adamw_step(params, grads, 1, [Run(0)]).first()
    assert row["m"] == pytest.approx(0.18) and row["v"] == pytest.approx(0.2997)
    assert row["value"] == pytest.approx(1 - 1e-3 * (1.8 / (math.sqrt(299.7) + 1e-8) + 0.01))


def test_gate(spark):
    log = spark.createDataFrame([(0, 1, 2.0), (0, 2, 1.0), (0, 3, 1.0), (0, 4, 1.5)], "run_id int, step int, loss double")
    row = trainer.target_gate(log, 1.45).first()
    assert (row["best_loss"], row["best_step"], row["final_loss"], row["passed"]) == (1.0, 2, 1.5, True)
    assert not trainer.target_gate(log, 0.5).first()["passed"]
