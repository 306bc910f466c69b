"""Corpus measurements."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenlake.operators.codec import encode
from tokenlake.operators.tokenizer import Tokenizer

# Fixed value: the corpus size that throughput is projected to, in bytes.
PROJECTED_BYTES = 825 * 10**9


def sample_docs(df: DataFrame, n: int, order_col: str = "doc_id") -> DataFrame:
    """The first ``n`` documents in order; each task passes on at most ``n``."""
    return df.orderBy(order_col).limit(n)


def compression_ratio(
    df: DataFrame, tokenizer: Tokenizer, groups: Sequence[str] = (), text_col: str = "text", method: str = "auto"
) -> DataFrame:
    """(groups, n_bytes, n_tokens, ratio): bytes per token as a ratio of sums."""
    sized = df.withColumn("_bytes", F.octet_length(text_col))
    coded = encode(sized, tokenizer, text_col, (*groups, "_bytes"), method)
    sums = coded.groupBy(*groups).agg(
        F.sum("_bytes").cast("bigint").alias("n_bytes"), F.sum("n_tokens").cast("bigint").alias("n_tokens")
    )
    return sums.withColumn("ratio", F.col("n_bytes") / F.greatest(F.lit(1), F.col("n_tokens")))


def throughput_report(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text", method: str = "auto") -> DataFrame:
    """(n_bytes, seconds, bytes_per_sec, projected_hours) of encoding ``df`` once."""
    n_bytes = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    started = time.perf_counter()
    encode(df, tokenizer, text_col, (), method).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    rate = n_bytes / seconds
    hours = PROJECTED_BYTES / rate / 3600 if rate else None
    return df.sparkSession.createDataFrame(
        [(n_bytes, seconds, rate, hours)], "n_bytes long, seconds double, bytes_per_sec double, projected_hours double"
    )
