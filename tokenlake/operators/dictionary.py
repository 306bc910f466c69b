"""Encoding by a dictionary of words: every distinct word is encoded once, for all documents and all runs.

The dictionary is a folder of Parquet tables (word, ids), words in their char-coded form. New documents add the words that
it lacks. Documents are taken in chunks of bounded size: the distinct words of a chunk are joined with the dictionary, and its
documents look their words up in what was found. So a word is shuffled once for a chunk and not at each of its places. The
join broadcasts a dictionary of proven size and otherwise spreads the rows of words that most chunks have over tasks.

This pays where words repeat much and are long to encode, as documents are shuffled once to meet their words;
:func:`best_method` measures the share of distinct words to choose. Ids are those of :func:`tokenlake.operators.codec.encode`.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenlake.functions import chars
from tokenlake.operators.codec import arrow_encoder, encode, marked_words, slices
from tokenlake.operators.skew import join_groups
from tokenlake.operators.tokenizer import Tokenizer
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace, hadoop_path

SCHEMA = "word string, ids array<int>"
# Distinct words among all words up to which a dictionary is used.
DISTINCT_SHARE = 0.02
# Bytes of marked text whose words are looked up together; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
# Rows of a partition fit so many bits of a chunk's number.
CHUNK_BITS = 33


class OtherTokenizerError(ValueError):
    """A dictionary was made with other merges or specials."""


def tokenizer_mark(tokenizer: Tokenizer) -> str:
    """A digest of what decides the ids of a word."""
    return hashlib.sha256(json.dumps([tokenizer.encode_rules(), [[s, tokenizer.special_id(s)] for s in tokenizer.specials]]).encode()).hexdigest()


@dataclass(frozen=True)
class WordDictionary:
    """The words encoded so far, in folders ``part=N`` under ``path``."""

    spark: SparkSession
    path: str
    tokenizer: Tokenizer

    def parts(self) -> list[int]:
        """Numbers of the complete parts. Fails for a folder of another tokenizer."""
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        mark = self.spark.read.text(f"{self.path}/tokenizer").first()["value"]
        if mark != tokenizer_mark(self.tokenizer):
            raise OtherTokenizerError(f"{self.path} belongs to another tokenizer")
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            done, marker = hadoop_path(self.spark, f"{self.path}/{name}/_SUCCESS")
            if name.startswith("part=") and done.exists(marker):
                found.append(int(name[len("part=") :]))
        return sorted(found)

    def table(self) -> DataFrame:
        """(word, ids): every word once."""
        parts = self.parts()
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/part={n}" for n in parts])

    def cover(self, words: DataFrame) -> int:
        """Add the words of (word) that are missing; returns how many. A part that was broken off is written again."""
        parts = self.parts()
        if not parts:
            mark = self.spark.createDataFrame([(tokenizer_mark(self.tokenizer),)], "value string")
            mark.coalesce(1).write.mode("overwrite").text(f"{self.path}/tokenizer")
        # Distinct words combine on the map side, however frequent one is.
        new = words.groupBy("word").count().select("word")
        if parts:
            new = new.join(self.table().select("word"), "word", "left_anti")
        target = f"{self.path}/part={parts[-1] + 1 if parts else 0}"
        encoded = new.select("word", arrow_encoder(new, self.tokenizer)(F.col("word")).alias("ids"))
        encoded.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(SCHEMA).parquet(target).count()


def encode_by_dictionary(
    df: DataFrame, dictionary: WordDictionary, text_col: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """(keep, ids, n_tokens) as by ``encode``, one row per input row; NULL texts have NULL ids. Adds missing words first."""
    ship_package(df.sparkSession)
    work = Workspace(df.sparkSession, "dictionary")
    marked = marked_words(F.col(text_col), dictionary.tokenizer)
    rows = df.select(F.struct(*keep).alias("keep"), marked.alias("marked"))
    cut = rows.mapInArrow(_chunked, T.StructType([*rows.schema.fields, T.StructField("chunk", T.LongType())]))
    number = F.shiftleft(F.spark_partition_id().cast("bigint"), CHUNK_BITS) + F.col("chunk")
    # Written, so that the numbers of chunks hold and words are cut once.
    rows = work.save(cut.withColumn("chunk", number), "rows")
    pairs = work.save(rows.select("chunk", "marked").mapInArrow(_words_of_chunks, "chunk long, word string"), "pairs")
    dictionary.cover(pairs.select("word"))
    found = join_groups(pairs, dictionary.table(), ["word"]).select("chunk", "word", "ids")
    schema = T.StructType().add("keep", rows.schema["keep"].dataType).add("ids", T.ArrayType(T.IntegerType()))
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def look_up(texts: pa.Table, known: pa.Table) -> pa.Table:
        return _looked_up(texts.select(["keep", "marked"]), known, arrow)

    joined = rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(look_up, schema)
    return joined.select(*[F.col("keep")[k].alias(k) for k in keep], "ids").withColumn("n_tokens", F.size("ids"))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their chunk in the partition."""
    chunk = 0
    for batch in batches:
        at = 0
        for part in slices(batch.column("marked"), CHUNK_BYTES):
            numbers = pa.array(np.full(len(part), chunk, np.int64))
            some = batch.slice(at, len(part))
            yield pa.RecordBatch.from_arrays([*some.columns, numbers], [*some.schema.names, "chunk"])
            at, chunk = at + len(part), chunk + 1


def _words_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, word): the distinct words of each chunk, once for each run of its rows."""

    def rows(chunk: int, words: set[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), chunk, np.int64)), pa.array(list(words), pa.string())], ["chunk", "word"])

    now, words = None, set()
    for batch in batches:
        for chunk, marked in zip(batch.column("chunk").to_pylist(), batch.column("marked")):
            if chunk != now:
                if words:
                    yield rows(now, words)
                now, words = chunk, set()
            if marked.is_valid:
                words.update(marked.as_py().split(chars.BOUNDARY))
    if words:
        yield rows(now, words)


def _looked_up(texts: pa.Table, known: pa.Table, schema: pa.Schema) -> pa.Table:
    """(keep, ids) of the rows of a chunk, by the ids of all its words."""
    place = {word: i for i, word in enumerate(known.column("word").to_pylist())}
    # A word may have come from two runs of rows; any of its places does.
    ids = known.column("ids").combine_chunks()
    sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    out = []
    for marked in texts.column("marked").combine_chunks():
        if not marked.is_valid:
            out.append(pa.array([None], schema.field("ids").type))
            continue
        places = np.fromiter(map(place.__getitem__, marked.as_py().split(chars.BOUNDARY)), np.int64)
        ends = pa.array(np.array([0, sizes[places].sum()], np.int32))
        out.append(pa.ListArray.from_arrays(ends, ids.take(pa.array(places)).flatten().cast(pa.int32())))
    columns = [texts.column("keep").combine_chunks().cast(schema.field("keep").type), pa.chunked_array(out, schema.field("ids").type)]
    return pa.Table.from_arrays(columns, schema=schema)


def distinct_share(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> float:
    """Distinct words over all words of a corpus, within a few percent; 1 without words."""
    words = df.select(F.explode(F.split(marked_words(F.col(text_col), tokenizer), chars.BOUNDARY)).alias("word"))
    row = words.agg(F.approx_count_distinct("word").alias("kinds"), F.count("word").alias("n")).first()
    return row["kinds"] / row["n"] if row["n"] else 1.0


def best_method(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text", most: float = DISTINCT_SHARE) -> str:
    """``dictionary`` where words repeat enough, else ``row``. Both give the same ids."""
    return "dictionary" if distinct_share(df, tokenizer, text_col) <= most else "row"


def encode_measured(
    df: DataFrame,
    tokenizer: Tokenizer,
    path: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    most: float = DISTINCT_SHARE,
) -> DataFrame:
    """Encode in the way that the measured share of distinct words suggests, with the dictionary at ``path``."""
    if best_method(df, tokenizer, text_col, most) == "row":
        return encode(df, tokenizer, text_col, keep)
    return encode_by_dictionary(df, WordDictionary(df.sparkSession, path, tokenizer), text_col, keep)
