"""Encoding and counting while a corpus arrives in pieces.

Results go to tables. Counts are written per micro-batch under its number, so a
batch that runs again after a failure replaces its own rows. Every few batches the
counts so far are merged into a snapshot; it counts from the moment its mark is
written, and readers take the newest one and the batches after it.

A stream processes what is there and stops, or with ``every`` goes on, looking for
new files at that interval until its query is stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenlake.functions.text import pretokens, without_specials
from tokenlake.operators.codec import encode
from tokenlake.operators.tokenizer import Tokenizer
from tokenlake.workspace import hadoop_path

# Micro-batches after which counts are merged into a snapshot.
COMPACT_EVERY = 20


def stream_corpus(
    spark: SparkSession,
    path: str,
    schema: str,
    files: str = "*.parquet",
    max_files_per_batch: int = 1000,
    spread_by: str | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream, new files as they appear.

    ``files`` may name one table under ``path`` that is itself a folder; then the files in it are the stream.
    ``spread_by`` works as in a batch scan: rows are hashed on it only if the
    files present give fewer splits than there are cores.
    """
    fs, table = hadoop_path(spark, f"{path}/{files}")
    if fs.exists(table) and fs.getFileStatus(table).isDirectory():
        path, files = f"{path}/{files}", "*"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    docs = reader.option("maxFilesPerTrigger", max_files_per_batch).parquet(path)
    if spread_by is not None:
        present = spark.read.schema(schema).option("pathGlobFilter", files).parquet(path)
        cores = spark.sparkContext.defaultParallelism
        if present.rdd.getNumPartitions() < cores:
            docs = docs.repartition(cores, spread_by)
    return docs


def _run(writer, every: str | None = None) -> StreamingQuery:
    """Process all that is there and stop, or start a query that goes on."""
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_encode(
    docs: DataFrame,
    tokenizer: Tokenizer,
    target: str,
    state: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    method: str = "auto",
    every: str | None = None,
) -> StreamingQuery:
    """Append (keep, ids, n_tokens) of every arriving row to ``target``.

    Encoding is row-local, so the stream keeps no state beyond its progress.
    """
    coded = encode(docs, tokenizer, text_col, keep, method)
    return _run(coded.writeStream.format("parquet").option("path", target).option("checkpointLocation", state), every)


def _per_batch(target: str, reduce: Callable[[DataFrame], DataFrame] = lambda df: df):
    def write(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def stream_pretoken_freq(
    docs: DataFrame,
    target: str,
    state: str,
    text_col: str = "text",
    specials: Sequence[str] = (),
    every: str | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Running word counts: each micro-batch writes the words it changed."""
    counts = (
        docs.select(F.explode(pretokens(without_specials(F.col(text_col), specials))).alias("pretoken"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    write = _per_batch(target)

    def write_and_compact(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if (batch_id + 1) % compact_every == 0:
            compact_freq(batch.sparkSession, target, batch_id)

    writer = counts.writeStream.outputMode("update").foreachBatch(write_and_compact)
    return _run(writer.option("checkpointLocation", state), every)


_FREQ = "pretoken string, freq bigint"


def _numbers(spark: SparkSession, target: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``kind=N`` under ``target``, in order."""
    fs, root = hadoop_path(spark, target)
    found = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        done, marker = hadoop_path(spark, f"{target}/{name}/_SUCCESS")
        if name.startswith(f"{kind}=") and done.exists(marker):
            found.append(int(name[len(kind) + 1 :]))
    return sorted(found)


def _freq_parts(spark: SparkSession, target: str, upto: int | None = None) -> tuple[int, list[int]]:
    """(the newest snapshot's last batch, -1 without one; the batches after it)."""
    fits = [n for n in _numbers(spark, target, "snapshot") if upto is None or n <= upto]
    last = fits[-1] if fits else -1
    return last, [n for n in _numbers(spark, target, "batch") if n > last and (upto is None or n <= upto)]


def _read_freq(spark: SparkSession, target: str, last: int, batches: Sequence[int]) -> DataFrame:
    def part(folder: str, number: int) -> DataFrame:
        return spark.read.schema(_FREQ).parquet(f"{target}/{folder}").withColumn("batch", F.lit(number).cast("bigint"))

    rows = spark.createDataFrame([], _FREQ + ", batch bigint") if last < 0 else part(f"snapshot={last}", last)
    for n in batches:
        rows = rows.unionByName(part(f"batch={n}", n))
    return rows.groupBy("pretoken").agg(F.max_by("freq", "batch").alias("freq"))


def compact_freq(spark: SparkSession, target: str, upto: int) -> None:
    """Merge the counts up to batch ``upto`` into a snapshot and delete older snapshots and batches that it holds.

    Spark's mark of a finished write makes the snapshot count; until then readers use the one before. A batch in it that
    runs again writes its own folder, which no reader takes any more, so it changes nothing.
    """
    last, batches = _freq_parts(spark, target, upto)
    if last == upto:
        return
    _read_freq(spark, target, last, batches).write.mode("overwrite").parquet(f"{target}/snapshot={upto}")
    # The snapshot before and the batches since stay for readers that have just looked.
    old = [f"snapshot={n}" for n in _numbers(spark, target, "snapshot") if n < last]
    for folder in old + [f"batch={n}" for n in _numbers(spark, target, "batch") if n <= last]:
        fs, path = hadoop_path(spark, f"{target}/{folder}")
        fs.delete(path, True)


def latest_freq(spark: SparkSession, target: str) -> DataFrame:
    """(pretoken, freq) of :func:`stream_pretoken_freq`: its newest snapshot and the batches after it."""
    return _read_freq(spark, target, *_freq_parts(spark, target))


def stream_corpus_stats(
    docs: DataFrame, tokenizer: Tokenizer, target: str, state: str, text_col: str = "text", every: str | None = None
) -> StreamingQuery:
    """One row (n_docs, n_bytes, n_tokens, written_at) per micro-batch."""

    def reduce(batch: DataFrame) -> DataFrame:
        sized = encode(batch.withColumn("_bytes", F.octet_length(text_col)), tokenizer, text_col, ("_bytes",))
        return sized.agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.coalesce(F.sum("_bytes"), F.lit(0)).cast("bigint").alias("n_bytes"),
            F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"),
        ).withColumn("written_at", F.current_timestamp())

    return _run(docs.writeStream.foreachBatch(_per_batch(target, reduce)).option("checkpointLocation", state), every)


def batch_stats(spark: SparkSession, target: str) -> DataFrame:
    """The rows that :func:`stream_corpus_stats` wrote, one per micro-batch, with
    the tokens per second since the batch before."""
    schema = "n_docs bigint, n_bytes bigint, n_tokens bigint, written_at timestamp, batch bigint"
    batches = spark.read.schema(schema).parquet(target)
    seconds = F.col("written_at").cast("double") - F.lag("written_at").over(Window.orderBy("batch")).cast("double")
    return batches.withColumn("tokens_per_sec", F.try_divide(F.col("n_tokens").cast("double"), seconds))


def running_stats(spark: SparkSession, target: str) -> DataFrame:
    """(n_docs, n_bytes, n_tokens, ratio) over all batches so far."""
    totals = batch_stats(spark, target).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")
    )
    return totals.withColumn("ratio", F.col("n_bytes") / F.greatest(F.lit(1), F.col("n_tokens")))
