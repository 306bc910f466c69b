"""Next-token models as count tables: fitting, scoring and sampling.

A context is one token, or two tokens packed into one BIGINT, so that keys stay
fixed-width. Counts are combined on the map side before any shuffle; after that
a context has at most one row per vocabulary entry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenlake.functions import hashing
from tokenlake.functions.chars import PAIR_BASE
from tokenlake.operators.dataset import next_token_pairs
from tokenlake.operators.skew import join_groups, table_bytes
from tokenlake.workspace import Workspace

ROUNDS_PER_TABLE = 8


def context_pairs(encoded: DataFrame, order: int = 1, keep: Sequence[str] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """(keep, context, target) with a context of ``order`` (1 or 2) tokens."""
    if order == 1:
        pairs = next_token_pairs(encoded, keep, ids_col)
        return pairs.select(*keep, F.col("context").cast("bigint").alias("context"), "target")
    if order != 2:
        raise ValueError("order must be 1 or 2")
    n = F.size(ids_col)
    triples = F.arrays_zip(
        F.slice(ids_col, F.lit(1), n - 2).alias("x"),
        F.slice(ids_col, F.lit(2), n - 2).alias("y"),
        F.slice(ids_col, F.lit(3), n - 2).alias("target"),
    )
    rows = encoded.filter(n > 2).select(*keep, F.explode(triples).alias("t"))
    packed = F.col("t.x").cast("bigint") * PAIR_BASE + F.col("t.y")
    return rows.select(*keep, packed.alias("context"), F.col("t.target").alias("target"))


def fit_ngram(pairs: DataFrame) -> DataFrame:
    """(context, target, cnt)"""
    return pairs.groupBy("context", "target").agg(F.count(F.lit(1)).alias("cnt"))


def log_softmax(logits: DataFrame, group: str = "context", logit: str = "logit", out: str = "logp") -> DataFrame:
    """Adds ``out``: logit minus the log of the summed exponentials of its group.

    The largest logit is subtracted first. Both reductions are windows over one partitioning, so rows are shuffled once,
    and not at all if they lie by group already. A group has at most a row per vocabulary entry.
    """
    whole = Window.partitionBy(group)
    shift = F.max(logit).over(whole)
    total = F.sum(F.exp(F.col(logit) - F.col("shift"))).over(whole)
    row = logits.select(F.struct(*logits.columns).alias("row"), F.col(group).alias(group), F.col(logit).alias(logit))
    normed = row.withColumn("shift", shift).withColumn("norm", F.log(total) + F.col("shift"))
    kept = [F.col("row")[c].alias(c) for c in logits.columns if c != out]
    return normed.select(*kept, (F.col(logit) - F.col("norm")).alias(out))


def pair_nll(
    pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, context, target, n, nll): distinct held-out pairs with their
    count and add-alpha negative log likelihood; unseen pairs get the floor.

    ``model`` is read twice and measured, so it should be a table.
    """
    held = pairs.groupBy(*groups, "context", "target").agg(F.count(F.lit(1)).alias("n"))
    totals = model.groupBy("context").agg(F.sum("cnt").alias("_total"))
    # The totals have at most as many rows as the model.
    model_bytes = table_bytes(model)
    known = join_groups(held, totals, ["context"], "left", model_bytes)
    known = join_groups(known, model, ["context", "target"], "left", model_bytes)
    seen = F.coalesce("cnt", F.lit(0)) + F.lit(float(alpha))
    mass = F.coalesce("_total", F.lit(0)) + F.lit(float(alpha) * vocab_size)
    return known.select(*groups, "context", "target", "n", (-F.log(seen / mass)).alias("nll"))


def cross_entropy(pairs: DataFrame, model: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """(n_pairs, mean_nll) over all predicted positions."""
    scored = pair_nll(pairs, model, vocab_size, alpha)
    return scored.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), (F.sum(F.col("n") * F.col("nll")) / F.sum("n")).alias("mean_nll")
    )


def perplexity(
    pairs: DataFrame, model: DataFrame, vocab_size: int, groups: Sequence[str], alpha: float = 1.0
) -> DataFrame:
    """(groups, n_pairs, ppl)"""
    scored = pair_nll(pairs, model, vocab_size, alpha, groups)
    return scored.groupBy(*groups).agg(
        F.sum("n").alias("n_pairs"), F.exp(F.sum(F.col("n") * F.col("nll")) / F.sum("n")).alias("ppl")
    )


def next_token_topk(logits: DataFrame, k: int, temperature: float = 1.0) -> DataFrame:
    """(context, token, logit, prob): candidates at or above the k-th largest logit.

    Ties at the threshold stay; ``k`` <= 0 keeps all; a temperature that is not
    positive leaves the logits as they are. ``rank`` with a bound lets Spark drop
    rows below the threshold before the shuffle.
    """
    scaled = logits.select(
        "context",
        F.col("target").alias("token"),
        (F.col("logit") / F.lit(float(temperature)) if temperature > 0 else F.col("logit")).alias("logit"),
    )
    if k > 0:
        best = Window.partitionBy("context").orderBy(F.desc("logit"))
        scaled = scaled.withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") <= k).drop("_rank")
    return log_softmax(scaled).withColumn("prob", F.exp("logp")).drop("logp")


def candidate_lists(topk: DataFrame) -> DataFrame:
    """(context, candidates): one row per context, at most one entry per token."""
    return topk.groupBy("context").agg(F.collect_list(F.struct("token", "logit")).alias("candidates"))


def _drawn(candidates: Column, item: Column, step: Column, seed: int, vocab_size: int) -> Column:
    """One categorical draw by Gumbel noise; a context without candidates draws
    evenly from the vocabulary. Equal scores go to the larger token."""
    noisy = F.transform(
        candidates,
        lambda c: F.struct(
            (c["logit"] + hashing.gumbel(seed, item, step, c["token"])).alias("score"), c["token"].alias("token")
        ),
    )
    anywhere = F.floor(hashing.uniform(seed, item, step) * vocab_size).cast("int")
    return F.coalesce(F.array_max(noisy)["token"], anywhere)


def sample_next(
    states: DataFrame, topk: DataFrame, vocab_size: int, seed: int = 0, step: Column | int = 0, key: str = "item_id"
) -> DataFrame:
    """Adds ``token`` to rows of (key, context): a seeded draw from ``topk``."""
    step = F.lit(step) if isinstance(step, int) else step
    joined = join_groups(states, candidate_lists(topk), ["context"], "left")
    drawn = _drawn(F.col("candidates"), F.col(key), step, seed, vocab_size)
    return joined.withColumn("token", drawn).drop("candidates")


def generate_batch(
    prompts: DataFrame,
    topk: DataFrame,
    vocab_size: int,
    max_tokens: int,
    seed: int = 0,
    order: int = 1,
    stop_token: int | None = None,
    key: str = "item_id",
) -> DataFrame:
    """(key, ids, n_new): all prompts (key, ids) go on by one token per round.

    ``topk`` sets temperature and k. Each round is a join of the states with the
    candidates of their contexts; the states are written every few rounds. With a
    ``stop_token`` the prompts that have reached it then leave the loop, and it
    ends when none is left.
    """
    workspace = Workspace(prompts.sparkSession, "generate")
    lists = workspace.save(candidate_lists(topk), "candidates")
    lists_bytes = table_bytes(lists)

    def context(ids: str) -> Column:
        last = F.element_at(ids, -1).cast("bigint")
        return last if order == 1 else F.when(
            F.size(ids) > 1, F.element_at(ids, -2).cast("bigint") * PAIR_BASE + last
        )

    states = prompts.select(key, "ids", F.lit(0).alias("n_new"), F.lit(False).alias("_done"))
    finished: list[DataFrame] = []
    for step in range(max_tokens):
        here = F.when(F.size("ids") > 0, context("ids"))
        joined = join_groups(states.withColumn("context", here), lists, ["context"], "left", lists_bytes)
        drawn = _drawn(F.col("candidates"), F.col(key), F.lit(step), seed, vocab_size)
        states = joined.select(
            key,
            F.when(F.col("_done"), F.col("ids")).otherwise(F.array_append("ids", drawn)).alias("ids"),
            F.when(F.col("_done"), F.col("n_new")).otherwise(F.col("n_new") + 1).alias("n_new"),
            "_done",
        )
        if stop_token is not None:
            states = states.withColumn("_done", F.element_at("ids", -1) == stop_token)
        if (step + 1) % ROUNDS_PER_TABLE == 0 and step + 1 < max_tokens:
            states = workspace.save(states, f"states-{step + 1}")
            if stop_token is not None:
                finished.append(states.filter("_done"))
                # Written by themselves, so that later rounds read live prompts alone.
                states = workspace.save(states.filter("NOT _done"), f"live-{step + 1}")
                if states.isEmpty():
                    break
    for part in finished:
        states = states.unionByName(part)
    return states.drop("_done")
