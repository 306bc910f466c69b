"""Removal of long byte strings that start at more than one place of the corpus.

Every 400-byte string holds an anchor: the 64-byte string of least hash among those inside it. Equal strings have the
same anchors, and hold the 168 bytes before or behind one of them in full, so places are grouped by the hash of an
anchor with those bytes. A group compares the strings around its anchors: prefix polynomial hashes give the hash of each
400-byte suffix prefix in constant time, hashes are sorted, and neighbours in that order are compared. Only prefixes of one
length matter, so the sort needs no search for the common extension, and two independent 64-bit hashes replace
the comparison of bytes. Equal surroundings are one class with a count, found by a digest; where a group has one class, all its strings
are repeated and no bytes move. Otherwise one place of each class brings its bytes. Groups of many classes are
compared by Spark, string by string, instead of in one task; first by what all strings of a few neighbouring places have
in common, so that only places where that is found twice give their strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import chunks, per_text, table, without
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

LENGTH = 400
ANCHOR = 64
# Bytes before or behind an anchor that its group shares, and the bytes around it that hold the strings in question.
SIDE = (LENGTH - ANCHOR) // 2
FRAME = LENGTH + SIDE
# Different surroundings that a task compares at a time; larger groups are compared by Spark.
GROUP = 1024
# Neighbouring places in a frame whose strings are looked up together by what they have in common.
NEIGHBOURS = 16
# Places that a task hands to Spark at a time.
PLACES = 1 << 16
# The same for surroundings of places, which are longer.
FRAMES = 1 << 12
# Bytes of short texts or of surroundings that are hashed in one go, so that the arrays stay in the processor's cache.
TOGETHER = 1 << 16


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


@lru_cache(maxsize=4)
def _hasher(seed: int):
    """Hashes of all strings of a length in some bytes, by prefix sums of a polynomial modulo 2**64."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
    inverse = np.uint64(pow(base, -1, 1 << 64))
    base = np.uint64(base % (1 << 64))

    def powers_of(factor: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, factor, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    # Most texts are shorter than this, so their powers are computed once.
    most = 2 * TOGETHER
    ready = {factor: powers_of(factor, most) for factor in (base, inverse)}

    def powers(factor: np.uint64, n: int) -> np.ndarray:
        return ready[factor][:n] if n <= most else powers_of(factor, n)

    def hashes(data: bytes, length: int) -> np.ndarray:
        n = len(data)
        if n < length:
            return np.empty(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[np.frombuffer(data, np.uint8)] * powers(base, n), out=sums[1:])
        found = (sums[length:] - sums[:-length]) * powers(inverse, n - length + 1)
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(32))

    return hashes


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each window of ``width``, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def anchors(data: bytes | None) -> tuple[np.ndarray, bytes]:
    """(pos, side, size, key) of anchors, a row each, with the bytes before (side 0) and the bytes behind (side 1).

    ``size`` is the number of bytes around the anchor; their digests, 16 bytes each, come joined.
    """
    if data is None or len(data) < LENGTH:
        return np.empty((4, 0), np.int64), b""
    found, digests = anchors_of_all([data])
    return found[1:], digests


def anchors_of_all(texts: list[bytes]) -> tuple[np.ndarray, bytes]:
    """The same for several texts of ``LENGTH`` bytes or more, hashed as one; the first row is the number of the text."""
    data, sizes = b"".join(texts), np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    hashed = _hasher(1)(data, ANCHOR)
    width = LENGTH - ANCHOR + 1
    least = _sliding(hashed, width, np.minimum)
    # No window crosses from one text to the next.
    for end in ends[:-1].tolist():
        least[end - LENGTH + 1 : end] = 0
    # A place is an anchor if it has the least hash of some window around it.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(_sliding(padded, width, np.maximum) == hashed)
    text = np.searchsorted(ends, places, side="right")
    text, places = (x[places + ANCHOR <= ends[text]] for x in (text, places))
    keys = _hasher(2)(data, ANCHOR + SIDE).view(np.int64)
    found, digests = [], []
    before, behind = places - SIDE >= begins[text], places + ANCHOR + SIDE <= ends[text]
    for side, of, pos in ((0, text[before], places[before]), (1, text[behind], places[behind])):
        start = pos - (SIDE if side else 2 * SIDE)
        first, last = np.maximum(start, begins[of]), np.minimum(start + FRAME, ends[of])
        whole = last - first >= LENGTH
        of, pos, start, first, last = (x[whole] for x in (of, pos, start, first, last))
        found.append(np.stack([of, pos - begins[of], np.full(len(pos), side), last - first, keys[pos if side else pos - SIDE]]))
        for at, end, short in zip(first.tolist(), last.tolist(), (start - first).tolist()):
            digest = hashlib.md5(data[at:end])
            if short:
                digest.update(b"%d" % short)
            digests.append(digest.digest())
    return np.concatenate(found, axis=1), b"".join(digests)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, pos, side, size, key, cid) of all anchors of the texts, a bounded number at a time."""
    kinds = {"_row": pa.int64(), "pos": pa.int32(), "side": pa.int32(), "size": pa.int32(), "key": pa.int64()}
    texts, numbers, size = [], [], 0
    rows, found, digests, held = [], [], [], 0

    def out() -> pa.RecordBatch:
        values = np.concatenate([np.concatenate(rows)[None], np.concatenate(found, axis=1)])
        cids = pa.Array.from_buffers(pa.binary(16), held, [None, pa.py_buffer(b"".join(digests))]).cast(pa.binary())
        return pa.record_batch([*[pa.array(v).cast(k) for v, k in zip(values, kinds.values())], cids], [*kinds, "cid"])

    def find() -> None:
        nonlocal held
        places, cids = anchors_of_all(texts)
        rows.append(np.array(numbers)[places[0]]), found.append(places[1:]), digests.append(cids)
        held += places.shape[1]

    for batch in batches:
        at = 0
        for part in chunks(batch.column(1)):
            for row, text in zip(batch.column(0).slice(at).to_pylist(), part.cast(pa.binary())):
                data = text.as_py()
                if data is None or len(data) < LENGTH:
                    continue
                texts.append(data), numbers.append(row)
                size += len(data)
                if size >= TOGETHER:
                    find()
                    texts, numbers, size = [], [], 0
                if held >= PLACES:
                    yield out()
                    rows, found, digests, held = [], [], [], 0
            at += len(part)
    if texts:
        find()
    if held:
        yield out()


def _frame(data: bytes, pos: int, side: int) -> tuple[int, bytes]:
    """Where the surroundings of an anchor begin (before the text, if negative) and their bytes."""
    begin = pos - (SIDE if side else 2 * SIDE)
    return begin, data[max(begin, 0) : begin + FRAME]


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each wanted place; ``off`` is where they begin in the frame."""
    held = []
    for batch in batches:
        for text, places in zip(batch.column(0), batch.column(1)):
            data = text.as_py().encode("utf-8", "surrogatepass")
            for place in places.as_py():
                begin, cut = _frame(data, place["pos"], place["side"])
                held.append((place["key"], place["side"], place["cid"], place["n"], place["large"], max(-begin, 0), cut))
                if len(held) >= FRAMES:
                    yield _frame_rows(held)
                    held = []
    if held:
        yield _frame_rows(held)


def _frame_rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "side": pa.int32(), "cid": pa.binary(), "n": pa.int64(), "large": pa.bool_(), "off": pa.int32(), "bytes": pa.binary()}
    return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*held), kinds.values())], list(kinds))


def _strings(member: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places in the frame and 128-bit hashes of the strings of a member."""
    one, two = _hasher(3)(member["bytes"], LENGTH), _hasher(4)(member["bytes"], LENGTH)
    return np.arange(len(one)) + member["off"], np.stack([one, two], axis=1)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, key, cid, start, end): the span of each member of a group, in the frame, that its strings with several places cover.

    Several small groups are compared in one go. Any two strings of a frame overlap, so the first and the last one bound what they cover.
    """
    for batch in batches:
        sizes = pc.list_value_length(batch.column("g")).to_numpy()
        # Slices of groups that hold a bounded number of members, or one larger group.
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + TOGETHER // FRAME, side="right")), start + 1)
            yield _compare(batch.slice(start, stop - start), sizes[start:stop])
            start = stop


def _compare(groups: pa.RecordBatch, sizes: np.ndarray) -> pa.RecordBatch:
    cids, offs, data, copies = groups.column("g").flatten().flatten()
    group, offs, data = np.repeat(np.arange(len(sizes)), sizes), offs.to_numpy(), data.to_pylist()
    lengths = np.array([len(x) for x in data])
    counts = lengths - LENGTH + 1
    firsts = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(firsts, counts)
    inside, joined = at + np.repeat(np.cumsum(lengths) - lengths, counts), b"".join(data)
    one, two = _hasher(3)(joined, LENGTH)[inside], _hasher(4)(joined, LENGTH)[inside]
    place, owner = at + np.repeat(offs, counts), np.repeat(group, counts)
    # One sort key of group, place and first hash; neighbours are compared in full.
    mixed = (owner * FRAME + place).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(one ^ mixed)
    same = np.ones(len(order) - 1, bool)
    for values in (one, two, place, owner):
        values = values[order]
        same &= values[1:] == values[:-1]
    # A member of several places needs no other to be repeated.
    hit = np.repeat(copies.to_numpy() > 1, counts)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    start = np.minimum.reduceat(np.where(hit, place, FRAME), firsts)
    end = np.maximum.reduceat(np.where(hit, place + LENGTH, 0), firsts)
    members = np.flatnonzero(end)
    of = pa.array(group[members])
    columns = [groups.column("side").take(of), groups.column("key").take(of), cids.take(pa.array(members))]
    spans = [pa.array(x[members]).cast(pa.int32()) for x in (start, end)]
    return pa.record_batch([*columns, *spans], ["side", "key", "cid", "start", "end"])


def _mixed(hashes: np.ndarray, key: int, side: int, at: np.ndarray) -> np.ndarray:
    """Hashes of strings that also tell the group and the place in the frame."""
    group = np.uint64(((key * 2 + side) * 0xD6E8FEB86659FD93 + 1) % 2**64)
    return hashes ^ group ^ (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, key, cid, part, core): for each part of neighbouring places with a string, the hash of the bytes in all of them."""
    names, step, length = ["side", "key", "cid"], PLACES // (FRAME // NEIGHBOURS), LENGTH - NEIGHBOURS + 1
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            rows, found = batch.slice(start, step), []
            for m in rows.to_pylist():
                parts = np.arange(m["off"] // NEIGHBOURS, (m["off"] + len(m["bytes"]) - LENGTH) // NEIGHBOURS + 1)
                hashes = _hasher(5)(m["bytes"], length)[(parts + 1) * NEIGHBOURS - 1 - m["off"]]
                found.append((parts, _mixed(hashes, m["key"], m["side"], parts)))
            out = rows.select(names).take(pa.array(np.repeat(np.arange(len(found)), [len(p) for p, _ in found])))
            parts, cores = (np.concatenate(x) for x in zip(*found))
            yield pa.record_batch([*out.columns, pa.array(parts).cast(pa.int32()), pa.array(cores.view(np.int64))], [*names, "part", "core"])


def _each_string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, key, cid, n, at, one, two) of the strings in the wanted parts of each frame, a bounded number at a time."""
    names, step = ["side", "key", "cid", "n"], PLACES // (FRAME - LENGTH + 1)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            rows, found = batch.slice(start, step), []
            for m in rows.to_pylist():
                places, hashed = _strings(m)
                wanted = np.isin(places // NEIGHBOURS, m["parts"])
                places, hashed = places[wanted], hashed[wanted]
                found.append((places, _mixed(hashed[:, 0], m["key"], m["side"], places), hashed[:, 1]))
            out = rows.select(names).take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
            at, one, two = (np.concatenate(x) for x in zip(*found))
            columns = [pa.array(at).cast(pa.int32()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
            yield pa.record_batch([*out.columns, *columns], [*names, "at", "one", "two"])


def _kept(pair: dict) -> dict:
    """Lengths and the remaining bytes of a text."""
    data = pair["text"].encode("utf-8", "surrogatepass") if pair["text"] is not None else b""
    runs: list[list[int]] = []
    for span in sorted(pair["spans"] or [], key=lambda s: s["start"]):
        if runs and span["start"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], span["end"])
        else:
            runs.append([span["start"], span["end"]])
    pieces, at = [], 0
    for start, end in runs:
        pieces.append(data[at:start])
        at = end
    kept = b"".join([*pieces, data[at:]])
    return {"n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": len(runs), "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()}


def dedup_strings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (BIGINT), kept_bytes and kept_sha256.

    Bytes inside a 400-byte string that also starts elsewhere are removed, all occurrences alike. NULL and empty texts have no
    bytes. Repeated rows are different places, so long enough ones lose all bytes. Every input row gives one row; columns with
    the names of added ones are replaced.
    """
    spark = docs.sparkSession
    added = ("n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_sha256")
    clean, work = without(docs, added), Workspace(spark, "suffix-dedup", tidy=True)
    # Written down, so that a row keeps its number.
    numbered = work.save(clean.withColumn("_row", F.monotonically_increasing_id()), "rows")
    long, integer = T.LongType(), T.IntegerType()
    binary = T.BinaryType()
    ship_package(spark)
    place = _struct(_row=long, pos=integer, side=integer, size=integer, key=long, cid=binary)
    keys = work.save(numbered.select("_row", text_col).mapInArrow(_places, place), "keys")
    repeated = keys.groupBy("side", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    # Written first, so that Spark can split hot keys in the join.
    repeated = work.save(repeated, "repeated")
    shared = work.save(keys.join(repeated, ["side", "key"]), "shared")
    work.drop("keys")
    begin = F.col("pos") - F.when(F.col("side") == 1, SIDE).otherwise(2 * SIDE)
    classes = shared.groupBy("side", "key", "cid").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_row", "pos", "size")).alias("p"))
    classes = work.save(classes.select("side", "key", "cid", "n", "p.*"), "classes")
    sizes = work.save(classes.groupBy("side", "key").agg(F.count(F.lit(1)).alias("c")), "sizes")
    # All strings of a class that is alone in its group occur as often as the class.
    alone = classes.join(sizes.filter("c = 1").select("side", "key"), ["side", "key"])
    off = F.greatest(-begin, F.lit(0))
    alone = alone.select("side", "key", "cid", off.alias("start"), (off + F.col("size")).alias("end"))
    mixed = classes.join(sizes.filter("c > 1"), ["side", "key"]).withColumn("large", F.col("c") > GROUP)
    wanted = mixed.groupBy("_row").agg(F.collect_list(F.struct("pos", "side", "key", "cid", "n", "large")).alias("places"))
    frame = _struct(key=long, side=integer, cid=binary, n=long, large=T.BooleanType(), off=integer, bytes=binary)
    pairs = numbered.select("_row", F.col(text_col).alias("text")).join(wanted, "_row")
    members = work.save(pairs.select("text", "places").mapInArrow(_frames, frame), "members")
    small = members.filter("NOT large").groupBy("side", "key").agg(F.collect_list(F.struct("cid", "off", "bytes", "n")).alias("g"))
    done = small.mapInArrow(_compared, _struct(side=integer, key=long, cid=binary, start=integer, end=integer))
    large, group = members.filter("large").drop("large"), ["side", "key", "cid"]
    cores = _struct(side=integer, key=long, cid=binary, part=integer, core=long)
    cores = work.save(large.select(*group, "off", "bytes").mapInArrow(_cores, cores), "cores")
    common = work.save(cores.groupBy("core").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("core"), "common")
    parts = cores.join(common, "core").groupBy(*group).agg(F.collect_list("part").alias("parts"))
    each = _struct(side=integer, key=long, cid=binary, n=long, at=integer, one=long, two=long)
    strings = large.join(parts, group).select(*group, "n", "off", "bytes", "parts").mapInArrow(_each_string, each)
    strings = work.save(strings, "strings")
    twice = strings.groupBy("one", "two").agg(F.sum("n").alias("t")).filter("t > 1").drop("t")
    # A class of several places needs no other to be repeated.
    spread = strings.filter("n = 1").drop("n").join(twice, ["one", "two"]).groupBy(*group)
    spread = spread.agg(F.min("at").alias("start"), (F.max("at") + LENGTH).alias("end"))
    copied = large.filter("n > 1").select(*group, F.col("off").alias("start"), (F.col("off") + F.octet_length("bytes")).alias("end"))
    spans = work.save(alone.unionByName(done).unionByName(copied).unionByName(spread), "spans")
    work.drop("members")
    work.drop("strings")
    placed = shared.select("_row", "side", "key", "cid", begin.alias("begin")).join(spans, ["side", "key", "cid"])
    moved = F.struct((F.col("start") + F.col("begin")).alias("start"), (F.col("end") + F.col("begin")).alias("end"))
    gone = placed.groupBy("_row").agg(F.collect_list(moved).alias("spans"))
    kept = per_text(spark, _struct(n_bytes=long, n_removed=long, n_spans=long, kept=T.BinaryType(), kept_sha256=T.StringType()), lambda: _kept)
    out = numbered.join(gone, "_row", "left").withColumn("_k", kept(F.struct(F.col(text_col).alias("text"), "spans")))
    names = {"kept_bytes": "kept"}
    return out.select(*clean.columns, *[F.col(f"_k.{names.get(a, a)}").alias(a) for a in added])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, removed bytes and runs, digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_strings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
