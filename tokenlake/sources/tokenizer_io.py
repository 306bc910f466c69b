"""Saving and loading tokenizers, as tables and as one JSON document."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tokenlake.operators.tokenizer import N_BYTES, Merge, Tokenizer


def save_tables(spark: SparkSession, tokenizer: Tokenizer, path: str) -> None:
    """The tables merges, vocab and specials, the last in the order in which specials are stripped."""
    tokenizer.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    tokenizer.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    specials = spark.createDataFrame(list(enumerate(tokenizer.specials)), "at int, special string")
    specials.coalesce(1).write.mode("overwrite").parquet(f"{path}/specials")


def load_tables(spark: SparkSession, path: str) -> Tokenizer:
    """Reads what :func:`save_tables` wrote; ids are those of the vocab table, wherever its specials stand."""
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    vocab = spark.read.parquet(f"{path}/vocab").orderBy("token_id").collect()
    specials = spark.read.schema("at int, special string").parquet(f"{path}/specials").orderBy("at").collect()
    return _with_vocab(
        tuple(Merge(m["a"], m["b"], m["cnt"]) for m in merges),
        tuple(s["special"] for s in specials),
        {v["token_id"]: bytes(v["token"]) for v in vocab},
    )


def _with_vocab(merges: tuple[Merge, ...], specials: tuple[str, ...], vocab: dict[int, bytes]) -> Tokenizer:
    """The tokenizer of a vocabulary that may not follow from the merges."""
    if sorted(vocab) != list(range(len(vocab))) or len(vocab) < N_BYTES:
        raise ValueError("token ids must run from 0 without gaps and cover all bytes")
    tokens = tuple(vocab[i] for i in range(len(vocab)))
    tokenizer = Tokenizer(merges, specials, tokens)
    missing = [s for s in specials if s.encode("utf-8") not in tokenizer.canonical_id]
    if missing or not {bytes([i]) for i in range(N_BYTES)} <= set(tokens):
        raise ValueError(f"the vocabulary lacks {missing or 'single bytes'}")
    followed = Tokenizer(merges, specials)
    return followed if len(tokens) == N_BYTES + len(specials) + len(merges) and followed.token_bytes == list(tokens) else tokenizer


def save_json(spark: SparkSession, tokenizer: Tokenizer, path: str) -> None:
    """One JSON object: vocab (string id to byte list), merges, special_tokens."""
    document = {
        "vocab": {str(i): list(token) for i, token in enumerate(tokenizer.token_bytes)},
        "merges": [[m.a, m.b] for m in tokenizer.merges],
        "special_tokens": list(tokenizer.specials),
    }
    frame = spark.createDataFrame([(json.dumps(document),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> Tokenizer:
    """Reads what :func:`save_json` wrote, or a single file with the same object."""
    document = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    merges = tuple(Merge(a, b) for a, b in document["merges"])
    vocab = {int(i): bytes(token) for i, token in document["vocab"].items()}
    return _with_vocab(merges, tuple(document.get("special_tokens", ())), vocab)
