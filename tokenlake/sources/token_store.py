"""A corpus of token ids as one packed, numbered stream on disk.

Documents are range-partitioned and sorted by key once; a partition is a stretch of the stream. In that order a task packs
ids as little-endian 16- or 32-bit integers into blocks of fixed length and writes each block with the pieces of documents
it holds. A manifest of one row per stretch gives the number of tokens and the place of its first in the whole stream. The
place of a token is therefore known from its row and the manifest: reading needs no join on the key and no second shuffle,
and a window is found by its stretch, which is a folder, and its block, on which files are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenlake.functions import hashing
from tokenlake.shipping import ship_package

BLOCK = 1 << 14
WIDTHS = {16: "<u2", 32: "<u4"}
# Blocks that a Python worker unpacks at a time.
UNPACKED_AT_ONCE = 64
# Up to so many blocks are named in the filter of the scan; more are found by the join alone.
NAMED_BLOCKS = 1024


def _blocks_schema(key: T.DataType) -> T.StructType:
    piece = T.StructType().add("key", key).add("first", T.IntegerType()).add("n", T.IntegerType()).add("of", T.LongType())
    return T.StructType().add("block", T.LongType()).add("n_tokens", T.IntegerType()).add("tokens", T.BinaryType()).add("pieces", T.ArrayType(piece))


class _Packer:
    """Cuts the documents of a stretch, given in order, into blocks."""

    def __init__(self, block: int, width: int, schema: pa.Schema):
        self.size, self.width, self.schema = block, width, schema
        self.block, self.held, self.parts, self.pieces = 0, 0, [], []

    def add(self, key, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(ids) and (ids.min() < 0 or int(ids.max()) >= 1 << self.width):
            wrong = int(ids.max()) if ids.min() >= 0 else int(ids.min())
            raise ValueError(f"token id {wrong} does not fit {self.width} bits")
        at = 0
        # A document without tokens is a piece of none.
        while at < len(ids) or not len(ids):
            taken = ids[at : at + self.size - self.held]
            self.pieces.append({"key": key, "first": self.held, "n": len(taken), "of": at})
            self.parts.append(taken.astype(WIDTHS[self.width]).tobytes())
            self.held += len(taken)
            at += len(taken)
            if self.held == self.size:
                yield from self.flush()
            if not len(ids):
                break

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.pieces:
            row = ([self.block], [self.held], [b"".join(self.parts)], [self.pieces])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, self.schema)], schema=self.schema)
            self.block, self.held, self.parts, self.pieces = self.block + 1, 0, [], []


def write_store(
    encoded: DataFrame,
    path: str,
    key: str = "doc_id",
    ids_col: str = "ids",
    width_bits: int = 16,
    block: int = BLOCK,
    stretches: int | None = None,
) -> TokenStore:
    """Write (key, ids) as a store. An id that does not fit ``width_bits`` fails the job.

    The stream is in order of ``key``, NULL first; rows with one key stand in an order of their ids. NULL ids count as none.
    The one shuffle is the range partitioning, into ``stretches`` (as many as the session's shuffle partitions unless given);
    equal rows stay together, so keys should be unique.
    """
    if width_bits not in WIDTHS:
        raise ValueError(f"width_bits must be one of {sorted(WIDTHS)}")
    spark = encoded.sparkSession
    ship_package(spark)
    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>")).cast("array<int>")
    rows = encoded.select(F.col(key).alias("key"), ids.alias("ids"))
    order = [F.asc_nulls_first("key"), F.xxhash64("ids")]
    stretches = stretches or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(stretches, *order).sortWithinPartitions(*order)
    schema = _blocks_schema(rows.schema["key"].dataType)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(block, width_bits, arrow)
        for batch in batches:
            for key_value, row in zip(batch.column("key").to_pylist(), batch.column("ids")):
                yield from packer.add(key_value, row.values.to_numpy(zero_copy_only=False))
        yield from packer.flush()

    # The number of a partition is written with its rows, since bounds of ranges come from samples.
    blocks = ordered.mapInArrow(pack, schema).withColumn("stretch", F.spark_partition_id())
    blocks.write.mode("overwrite").partitionBy("stretch").parquet(f"{path}/blocks")
    full = schema.add("stretch", T.IntegerType())
    written = spark.read.schema(full).parquet(f"{path}/blocks")
    sizes = written.groupBy("stretch").agg(
        F.sum(F.col("n_tokens").cast("long")).alias("n_tokens"), F.count(F.lit(1)).alias("n_blocks")
    )
    # One row per partition of the writer.
    first, manifest = 0, []
    for row in sizes.orderBy("stretch").collect():
        manifest.append((row["stretch"], first, row["n_tokens"], row["n_blocks"], width_bits, block))
        first += row["n_tokens"]
    table = spark.createDataFrame(manifest, MANIFEST)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return TokenStore(spark, path, key, full)


MANIFEST = "stretch int, first long, n_tokens long, n_blocks long, width_bits int, block int"


def open_store(spark: SparkSession, path: str, key: str = "doc_id") -> TokenStore:
    ship_package(spark)
    return TokenStore(spark, path, key, spark.read.parquet(f"{path}/blocks").schema)


@dataclass(frozen=True)
class TokenStore:
    """A written store; ``key`` is the name that the documents' key gets in results."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType

    def manifest(self) -> DataFrame:
        """(stretch, first, n_tokens, n_blocks, width_bits, block), a row per stretch of the stream."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def blocks(self) -> DataFrame:
        """Blocks with ``ids`` unpacked and ``start``, the place of the first one in the stream."""
        return self._unpacked(self._packed())

    def _packed(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/blocks")

    def _unpacked(self, blocks: DataFrame) -> DataFrame:
        # The manifest has one row per stretch, so it is small.
        placed = blocks.join(F.broadcast(self.manifest().select("stretch", "first", "width_bits", F.col("block").alias("size"))), "stretch")
        start = F.col("first") + F.col("block") * F.col("size")
        return placed.withColumn("ids", _unpack("tokens", "width_bits")).withColumn("start", start).drop("tokens", "first", "size", "width_bits")

    @property
    def n_tokens(self) -> int:
        return self.manifest().agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]

    def stream(self) -> DataFrame:
        """(pos, key, token): every token with its place. A projection of the blocks."""
        pieces = self.blocks().select("start", "ids", F.explode("pieces").alias("p")).filter("p.n > 0")
        tokens = F.posexplode(F.slice("ids", F.col("p.first") + 1, F.col("p.n"))).alias("i", "token")
        return pieces.select((F.col("start") + F.col("p.first")).alias("at"), F.col("p.key").alias(self.key), tokens).select(
            (F.col("at") + F.col("i")).alias("pos"), self.key, "token"
        )

    def documents(self) -> DataFrame:
        """(key, ids, n_tokens) as they were written. Only documents that lie in more than one block are shuffled."""
        pieces = self.blocks().select("stretch", "block", "n_tokens", F.posexplode("pieces").alias("i", "p"), F.size("pieces").alias("m"), "ids")
        ids = F.slice("ids", F.col("p.first") + 1, F.col("p.n"))
        # The first piece of a block may go on from the block before, the last into the next one if it has tokens.
        cut = (F.col("p.of") > 0) | ((F.col("i") == F.col("m") - 1) & (F.col("p.n") > 0))
        parts = pieces.select("stretch", "block", "i", F.col("p.key").alias(self.key), F.col("p.of").alias("of"), ids.alias("part"), cut.alias("cut"))
        whole = parts.filter("NOT cut").select(self.key, F.col("part").alias("ids"))
        # A piece names the block its document began in.
        size = F.lit(self.manifest().agg(F.max("block")).first()[0] or BLOCK)
        began = F.when(F.col("of") > 0, F.col("block") - F.ceil((F.col("of")) / size)).otherwise(F.col("block"))
        rest = parts.filter("cut").withColumn("began", began.cast("long"))
        joined = rest.groupBy("stretch", "began", self.key).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "i", "part"))), lambda p: p["part"]).alias("parts")
        )
        return whole.unionByName(joined.select(self.key, F.flatten("parts").alias("ids"))).withColumn("n_tokens", F.size("ids"))

    def sample_windows(self, n: int, length: int, seed: int = 0) -> DataFrame:
        """(sample_id, start, tokens): ``n`` windows of ``length`` tokens, starts uniform with replacement in
        [0, total - length - 1). Reads the stretches and blocks that the windows touch, not the corpus."""
        total = self.n_tokens
        n_starts = total - length - 1
        if n_starts <= 0:
            raise ValueError(f"a stream of {total} tokens has no window of {length}")
        start = hashing.md5_number(hashing.keyed(seed, F.col("id")), 15) % n_starts
        return self.windows(self.spark.range(n).select(F.col("id").alias("sample_id"), start.alias("start")), length)

    def windows(self, starts: DataFrame, length: int) -> DataFrame:
        """(sample_id, start, tokens) for (sample_id, start); a window that leaves the stream is cut off."""
        wanted = _touched(starts, self.manifest(), length)
        packed = self._packed()
        few = wanted.select("stretch", "block").distinct().limit(NAMED_BLOCKS + 1).collect()
        if len(few) <= NAMED_BLOCKS:
            packed = packed.filter(F.col("stretch").isin(sorted({r["stretch"] for r in few})) & F.col("block").isin(sorted({r["block"] for r in few})))
        # Windows are a sample, so only their blocks meet them; each window takes a slice of a block.
        hit = self._unpacked(packed.drop("pieces")).join(wanted, ["stretch", "block"])
        begin = F.greatest(F.col("at") - F.col("start"), F.lit(0))
        end = F.least(F.col("at") + length - F.col("start"), F.col("n_tokens").cast("long"))
        cut = F.slice("ids", (begin + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
        ordered = F.array_sort(F.collect_list(F.struct(F.col("start").alias("from"), cut.alias("part"))))
        found = hit.groupBy("sample_id", "at").agg(ordered.alias("parts"))
        return found.select("sample_id", F.col("at").alias("start"), F.flatten(F.col("parts.part")).alias("tokens"))


def _touched(starts: DataFrame, manifest: DataFrame, length: int) -> DataFrame:
    """(sample_id, at, stretch, block): the blocks that windows of ``length`` from ``at`` on touch.

    Stretches are looked up in their sorted bounds, one small array, so nothing is compared with every stretch.
    """
    rows = manifest.filter("n_tokens > 0").orderBy("first").collect()
    firsts = np.array([r["first"] for r in rows], np.int64)
    sizes = np.array([r["n_tokens"] for r in rows], np.int64)
    names = np.array([r["stretch"] for r in rows], np.int64)
    block = rows[0]["block"] if rows else BLOCK
    fields = T.StructType().add("stretch", T.IntegerType()).add("block", T.LongType())

    @F.arrow_udf(T.ArrayType(fields))
    def blocks_of(at: pa.Array) -> pa.Array:
        out = []
        for begin in at.to_pylist():
            found = []
            stretch = int(np.searchsorted(firsts, begin, "right")) - 1
            while 0 <= stretch < len(firsts) and firsts[stretch] < begin + length:
                low = max(begin, int(firsts[stretch])) - int(firsts[stretch])
                high = min(begin + length - int(firsts[stretch]), int(sizes[stretch])) - 1
                found += [{"stretch": int(names[stretch]), "block": b} for b in range(low // block, high // block + 1)]
                stretch += 1
            out.append(found)
        return pa.array(out, to_arrow_type(T.ArrayType(fields)))

    found = starts.select("sample_id", F.col("start").alias("at"), F.explode(blocks_of("start")).alias("b"))
    return found.select("sample_id", "at", "b.stretch", "b.block")


def _unpack(tokens: str, width: str) -> Column:
    return _unpacker()(F.col(tokens), F.col(width))


def _unpacker():
    @F.arrow_udf("array<int>")
    def unpack(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for data, bits in batches:
            if not len(data):
                yield pa.array([], pa.list_(pa.int32()))
            # A batch may hold thousands of blocks; a few of them are unpacked and handed on at a time.
            for at in range(0, len(data), UNPACKED_AT_ONCE):
                some = zip(data.slice(at, UNPACKED_AT_ONCE), bits.slice(at, UNPACKED_AT_ONCE))
                parts = [np.frombuffer(d.as_buffer(), WIDTHS[b.as_py()]).astype(np.int32) for d, b in some]
                offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))

    return unpack
