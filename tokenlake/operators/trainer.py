"""A log-linear model trained on tables: gradients are grouped sums, parameters
and moments are rows.

Examples are sparse: (example, label, param_key, x). Every table carries
``run_id``, so a sweep over settings advances all its runs in the same job.
All batches of all steps are drawn in one pass over the examples before the
loop, so a step reads its batch and not the corpus.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenlake.functions import hashing
from tokenlake.operators.prefix import running_total
from tokenlake.operators.skew import join_groups, table_bytes
from tokenlake.sources.job_checkpoint import JobCheckpoint, fingerprint
from tokenlake.workspace import Workspace

BIAS_KEY = -1
# Batches up to this many examples are looked up by broadcast.
BROADCAST_SLOTS = 1_000_000
# Steps after which the parameters are written, and parameters of all runs for one task.
STEPS_PER_TABLE = 20
KEYS_PER_TASK = 20_000
LOG = "run_id int, step int, loss double, ppl double, rate double"
_LOG_COLUMNS = ("run_id", "step", "loss", "ppl", "rate")


@dataclass(frozen=True)
class Run:
    """Settings of one training run."""

    run_id: int
    lr: float = 1e-3
    batch_size: int = 16
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    weight_decay: float = 0.01


def example_features(encoded: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """(key, y, param_key, x): token frequencies of labelled documents, and a bias.

    Counting is per document, so it is complete before the shuffle.
    """
    tokens = encoded.join(labels.select(key, F.col(label).cast("double").alias("y")), key)
    size = F.greatest(F.size("ids"), F.lit(1)).cast("double")
    counted = (
        tokens.select(key, "y", size.alias("_size"), F.explode("ids").alias("param_key"))
        .groupBy(key, "y", "_size", "param_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "y", F.col("param_key").cast("bigint").alias("param_key"), (F.col("_n") / F.col("_size")).alias("x"))
    )
    bias = tokens.select(key, "y", F.lit(BIAS_KEY).cast("bigint").alias("param_key"), F.lit(1.0).alias("x"))
    return counted.unionByName(bias)


def _scored(examples: DataFrame, params: DataFrame, ids: Sequence[str], param_bytes: int | None) -> DataFrame:
    """Examples with ``p``, the predicted probability of their label being 1."""
    values = params.select("run_id", "param_key", "value")
    if param_bytes is None:
        param_bytes = table_bytes(values)
    joined = join_groups(examples, values, ["run_id", "param_key"], "left", param_bytes)
    # One example per group: at most one row per vocabulary entry.
    example = Window.partitionBy(*ids)
    score = F.sum(F.coalesce("value", F.lit(0.0)) * F.col("x")).over(example)
    return joined.withColumn("p", 1.0 / (1.0 + F.exp(-score)))


def gradient_sum(
    examples: DataFrame, params: DataFrame, ids: Sequence[str] = ("run_id", "doc_id"), param_bytes: int | None = None
) -> DataFrame:
    """(run_id, param_key, grad): gradient of the mean log loss.

    ``examples`` are (ids, w, y, param_key, x), with ``w`` the number of times an
    example counts. Gradients combine on the map side, so frequent keys do not skew.
    """
    scored = _scored(examples, params, ids, param_bytes)
    sums = scored.groupBy("run_id", "param_key").agg(F.sum(F.col("w") * (F.col("p") - F.col("y")) * F.col("x")).alias("_g"))
    sizes = examples.filter(F.col("param_key") == BIAS_KEY).groupBy("run_id").agg(F.sum("w").alias("_b"))
    return sums.join(F.broadcast(sizes), "run_id").select("run_id", "param_key", (F.col("_g") / F.col("_b")).alias("grad"))


def mean_loss(
    examples: DataFrame, params: DataFrame, ids: Sequence[str] = ("run_id", "doc_id"), param_bytes: int | None = None
) -> DataFrame:
    """(run_id, loss): mean log loss per run."""
    each = _scored(examples, params, ids, param_bytes).filter(F.col("param_key") == BIAS_KEY)
    nll = -F.log(F.when(F.col("y") > 0.5, F.col("p")).otherwise(1.0 - F.col("p")))
    return each.groupBy("run_id").agg((F.sum(F.col("w") * nll) / F.sum("w")).alias("loss"))


def init_params(keys: DataFrame, runs: Iterable[Run]) -> DataFrame:
    """(run_id, param_key, value, m, v), all zero, for (param_key) rows."""
    run_ids = F.array(*[F.lit(r.run_id) for r in runs])
    zero = F.lit(0.0)
    return keys.select(
        F.explode(run_ids).alias("run_id"), "param_key", zero.alias("value"), zero.alias("m"), zero.alias("v")
    )


def adamw_step(params: DataFrame, grads: DataFrame, step: int, runs: Iterable[Run]) -> DataFrame:
    """Parameters and moments after update number ``step`` (from 1).

    A key without a gradient has gradient zero: its moments still decay. Weight
    decay is decoupled and reaches every parameter.
    """
    rows = [
        (r.run_id, r.lr, r.beta1, r.beta2, r.eps, r.weight_decay, 1.0 - r.beta1**step, 1.0 - r.beta2**step) for r in runs
    ]
    settings = params.sparkSession.createDataFrame(
        rows, "run_id int, lr double, b1 double, b2 double, eps double, wd double, c1 double, c2 double"
    )
    moved = (
        params.join(grads, ["run_id", "param_key"], "left")
        .join(F.broadcast(settings), "run_id")
        .withColumn("g", F.coalesce("grad", F.lit(0.0)))
        .withColumn("m", F.expr("b1 * m + (1 - b1) * g"))
        .withColumn("v", F.expr("b2 * v + (1 - b2) * (g * g)"))
        .withColumn("value", F.expr("value - lr * ((m / c1) / (sqrt(v / c2) + eps) + wd * value)"))
    )
    return moved.select("run_id", "param_key", "value", "m", "v")


def draw_batches(
    features: DataFrame, runs: Sequence[Run], num_steps: int, seed: int, key: str = "doc_id"
) -> DataFrame:
    """(step, run_id, key, w, y, param_key, x): the batches of steps 1..num_steps.

    Slot s of a step takes the example whose number is a seeded hash modulo the
    number of examples, with replacement; a run of batch size B uses slots 0..B-1.
    """
    spark = features.sparkSession
    examples = features.filter(F.col("param_key") == BIAS_KEY).select(key, F.lit(1).alias("_one"))
    numbered = running_total(examples, key, "_one", "_number")
    n = numbered.count()
    widest = max(r.batch_size for r in runs)
    slots = spark.range(num_steps * widest).select(
        (F.expr(f"id div {widest}") + 1).cast("int").alias("step"), (F.col("id") % widest).cast("int").alias("_slot")
    )
    slots = slots.withColumn("_number", hashing.md5_number(hashing.keyed(seed, F.col("step"), F.col("_slot")), 15) % n)
    sizes = F.array(*[F.struct(F.lit(r.run_id).alias("run_id"), F.lit(r.batch_size).alias("size")) for r in runs])
    drawn = (
        slots.select("step", "_slot", "_number", F.inline(sizes))
        .filter(F.col("_slot") < F.col("size"))
        .groupBy("step", "run_id", "_number")
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    )
    small = num_steps * widest * len(runs) <= BROADCAST_SLOTS
    picked = numbered.join(F.broadcast(drawn) if small else drawn, "_number").drop("_number")
    return features.join(F.broadcast(picked) if small else picked, key).select(
        "step", "run_id", key, "w", "y", "param_key", "x"
    )


@dataclass(frozen=True)
class Trained:
    """``params`` after the last step and ``log`` (run_id, step, loss, ppl, rate)."""

    params: DataFrame
    log: DataFrame


def train_loglinear(
    features: DataFrame,
    runs: Sequence[Run],
    num_steps: int,
    seed: int = 42,
    log_every: int = 1,
    save_every: int | None = None,
    checkpoint: JobCheckpoint | None = None,
    key: str = "doc_id",
) -> Trained:
    """Mini-batch training of all ``runs`` together.

    ``features`` (key, y, param_key, x) is read several times and should be a
    table. The loss of a logged step is that of its batch after the update.

    The batches of all steps are one table in order of steps. Parameters stay on the executors from step to step; the job
    that takes the loss of a step makes them. They are written every ``STEPS_PER_TABLE`` steps, so a lost executor costs
    the steps since then, and files don't grow with steps times tasks. A step sends one row per run to the driver.
    """
    spark = features.sparkSession
    workspace = Workspace(spark, "train")
    drawn = draw_batches(features, runs, num_steps, seed, key)
    ordered = drawn.repartitionByRange("step", F.xxhash64(key)).sortWithinPartitions("step")
    workspace.save(ordered, "batches")
    settings = {"job": "loglinear", "seed": seed, "runs": [list(vars(r).values()) for r in runs], "log_every": log_every}
    resumed = checkpoint.claim(fingerprint(features, **settings)) if checkpoint is not None else None
    logged: list[tuple] = []
    if resumed is not None:
        first, start = resumed.step + 1, f"{resumed.path}/params"
        if resumed.meta["logged"]:
            logged = [tuple(row) for row in resumed.table("log").select(*_LOG_COLUMNS).collect()]
    else:
        first, start = 1, f"{workspace.path}/params-0"
        workspace.save(init_params(features.select("param_key").distinct(), runs), "params-0")
    loop = _loop_session(spark, features, runs)
    batches = loop.read.schema(drawn.schema).parquet(f"{workspace.path}/batches")
    params = loop.read.parquet(start)
    ids = ("run_id", key)
    param_bytes = table_bytes(params)  # the keys stay the same
    sizes = {r.run_id: r.batch_size for r in runs}
    started = time.perf_counter()
    held: list[DataFrame] = []
    workspace.spark = loop
    for step in range(first, num_steps + 1):
        batch = batches.filter(F.col("step") == step).drop("step")
        params = adamw_step(params, gradient_sum(batch, params, ids, param_bytes), step, runs)
        if (step - first + 1) % STEPS_PER_TABLE == 0 or step == num_steps:
            params = workspace.save(params, f"params-{step}")
        else:
            params = params.persist()
            held.append(params)
        if step % log_every == 0:
            losses = mean_loss(batch, params, ids, param_bytes).collect()
            per_second = (step - first + 1) / (time.perf_counter() - started)
            logged += [(r["run_id"], step, r["loss"], math.exp(r["loss"]), sizes[r["run_id"]] * per_second) for r in losses]
        elif held and held[-1] is params:
            params.count()  # else later steps would make them again and again
        if checkpoint is not None and save_every and step % save_every == 0:
            log = loop.createDataFrame(logged, LOG)
            checkpoint.save(step, {"params": params, "log": log}, {"logged": bool(logged)})
        # The parameters before the last ones are made no more; written ones need none of the earlier.
        while len(held) > (0 if (step - first + 1) % STEPS_PER_TABLE == 0 else 2):
            held.pop(0).unpersist()
    for frame in held:
        frame.unpersist()
    last = spark.read.parquet(f"{workspace.path}/params-{num_steps}") if num_steps >= first else spark.read.parquet(start)
    log = Workspace(spark, "train").save(spark.createDataFrame(logged, LOG), "log")
    return Trained(last, log)


def _loop_session(spark: SparkSession, features: DataFrame, runs: Sequence[Run]) -> SparkSession:
    """A session for many small jobs: a step moves the parameters and one batch, so partitions follow their number."""
    loop = spark.newSession()
    keys = features.agg(F.approx_count_distinct("param_key")).first()[0] * len(runs)
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // KEYS_PER_TASK)))
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    loop.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return loop


def sweep_report(log: DataFrame, runs: Sequence[Run]) -> DataFrame:
    """(step, run_<id>...): one loss column per run."""
    curves = log.groupBy("step").pivot("run_id", [r.run_id for r in runs]).agg(F.first("loss"))
    return curves.select("step", *[F.col(str(r.run_id)).alias(f"run_{r.run_id}") for r in runs])


def target_gate(log: DataFrame, target: float) -> DataFrame:
    """(run_id, best_loss, best_step, final_loss, passed) of each run's log.

    Of equal best losses the earliest step is reported.
    """
    return log.groupBy("run_id").agg(
        F.min("loss").alias("best_loss"),
        F.min_by("step", F.struct("loss", "step")).alias("best_step"),
        F.max_by("loss", "step").alias("final_loss"),
        (F.min("loss") <= F.lit(float(target))).alias("passed"),
    )
