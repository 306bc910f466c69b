"""Corpus scans and record-level preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.functions import hashing
from tokenlake.functions.text import END_OF_TEXT
from tokenlake.operators.prefix import locate_total


def scan_corpus(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, spread_by: str | None = None
) -> DataFrame:
    """Read a Parquet corpus.

    ``spread_by`` names a unique key. When the files give fewer splits than
    there are cores (one row group cannot be split), rows are hashed on it so
    that the text work behind the scan is not left to a few tasks. A corpus
    with enough splits is never shuffled here.
    """
    docs = spark.read.parquet(path)
    if columns is not None:
        docs = docs.select(*columns)
    if spread_by is not None:
        cores = spark.sparkContext.defaultParallelism
        if docs.rdd.getNumPartitions() < cores:
            docs = docs.repartition(cores, spread_by)
    return docs


def read_marked_text(spark: SparkSession, path: str, marker: str = END_OF_TEXT) -> DataFrame:
    """Text files whose documents are separated by ``marker``, one row each.

    The marker is the record separator of the text source, so large files are
    split among tasks without reading them whole.
    """
    return spark.read.option("lineSep", marker).text(path).select(F.col("value").alias("text"))


def split_documents(
    df: DataFrame, text_col: str = "text", marker: str = END_OF_TEXT, keep: Sequence[str] = ()
) -> DataFrame:
    """Cut each text at the marker; empty pieces are kept. Adds ``doc_pos``."""
    literal = "".join("\\" + c if not c.isalnum() else c for c in marker)
    pieces = F.split(F.col(text_col), literal, -1)
    return df.select(*keep, F.posexplode(pieces).alias("doc_pos", "text"))


def train_valid_split(df: DataFrame, key: str = "doc_id", valid_percent: int = 10) -> DataFrame:
    """Adds ``bucket`` (0..99, from the md5 of the key) and ``split``."""
    bucket = (hashing.md5_number(F.col(key)) % 100).cast("int")
    return df.withColumn("bucket", bucket).withColumn(
        "split", F.when(F.col("bucket") < valid_percent, "valid").otherwise("train")
    )


def _whole_characters(text: Column, n_bytes: Column) -> Column:
    """The longest prefix of at most ``n_bytes`` bytes that ends on a character."""
    raw = F.encode(text, "UTF-8")
    cuts = []
    for dropped in range(4):
        piece = F.substring(raw, F.lit(1), F.greatest(n_bytes - dropped, F.lit(0)).cast("int")).cast("string")
        cuts.append(F.when(F.is_valid_utf8(piece), piece))
    return F.coalesce(*cuts)


def byte_budget(
    documents: DataFrame, max_bytes: int, order_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first ``max_bytes`` bytes of the corpus in ``order_col`` order.

    Only (key, byte length) is sorted to find the record that crosses the limit;
    the text itself is then filtered in place by key, without a shuffle. Adds
    ``kept_bytes``; the crossing record is cut back to a whole character.
    """
    if max_bytes <= 0:
        return documents.filter(F.lit(False)).withColumn("kept_bytes", F.lit(0))
    sizes = documents.select(
        F.col(order_col), F.octet_length(text_col).cast("bigint").alias("n_bytes")
    )
    crossing = locate_total(sizes, order_col, "n_bytes", max_bytes)
    if crossing is None:
        return documents.withColumn("kept_bytes", F.octet_length(text_col))
    last_key, before = crossing
    cut = _whole_characters(F.col(text_col), F.lit(max_bytes - before))
    return (
        documents.filter(F.col(order_col) <= F.lit(last_key))
        .withColumn(text_col, F.when(F.col(order_col) == F.lit(last_key), cut).otherwise(F.col(text_col)))
        .withColumn("kept_bytes", F.octet_length(text_col))
    )


def pack_token_ids(encoded: DataFrame, width_bits: int | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Token table with the narrowest width that holds every id of the row.

    With a declared ``width_bits`` an id that does not fit fails the job.
    """
    top = F.coalesce(F.array_max("ids"), F.lit(0))
    packed = encoded.select(*keep, "ids", F.size("ids").alias("n_tokens"), top.alias("max_id"))
    if width_bits is None:
        return packed.withColumn("width_bits", F.when(F.col("max_id") < (1 << 16), 16).otherwise(32))
    fits = F.col("max_id") < F.lit(1 << width_bits)
    message = F.concat(F.lit("token id "), F.col("max_id").cast("string"), F.lit(f" exceeds {width_bits} bits"))
    return packed.withColumn("width_bits", F.when(fits, F.lit(width_bits)).otherwise(F.raise_error(message).cast("int")))
