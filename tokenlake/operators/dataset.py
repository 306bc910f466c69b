"""Token datasets: one stream with global positions, pairs, sampled windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenlake.sources.token_store import TokenStore, write_store
from tokenlake.workspace import Workspace


def next_token_pairs(encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """(keep, pos, context, target): each token of ``ids_col`` with the one after it, of a document or a window.

    The last token has no target. Read from the array of the row, so nothing is
    shuffled or sorted.
    """
    n = F.size(ids_col)
    pairs = F.arrays_zip(
        F.slice(ids_col, F.lit(1), n - 1).alias("context"), F.slice(ids_col, F.lit(2), n - 1).alias("target")
    )
    return encoded.filter(n > 1).select(*keep, F.posexplode(pairs).alias("pos", "p")).select(
        *keep, "pos", "p.context", "p.target"
    )


def token_stream(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(pos, key, token): all documents in key order as one numbered stream.

    The tokens are shuffled once, into a store whose rows know their places; the stream is a projection of it.
    """
    return _stored(encoded, key).stream()


def sample_windows(encoded: DataFrame, n: int, length: int, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """(sample_id, start, tokens): ``n`` windows of ``length`` tokens.

    Starts are uniform with replacement in [0, total - length - 1). To sample one corpus several times, write its store
    once and call its ``sample_windows``, which reads only the blocks that are hit.
    """
    return _stored(encoded, key).sample_windows(n, length, seed)


def _stored(encoded: DataFrame, key: str) -> TokenStore:
    return write_store(encoded, Workspace(encoded.sparkSession, "tokens").path, key, width_bits=32)
