"""Near duplicates by MinHash signatures and a multi-index join under Hamming distance.

A text is the set of its distinct five-word shingles. Rows of equal word sequences form a class, so copies cost
one row. The signature of a class has ``CHUNKS`` chunks of ``WIDTH`` 16-bit MinHash values. By the pigeonhole principle, two
signatures that differ in fewer than ``2 * CHUNKS`` values have a chunk with at most one error; so each chunk is indexed
once with each value left out, and a lookup finds every pair under that distance, most others near it, and few of those
far away. Found pairs whose signatures differ in ``FAR`` values or more are dropped before any text moves, and so are
pairs whose sketches (a byte of the least hash in each of ``BINS`` parts of the hash range; a bit for each of ``BITS`` parts,
looked at first) show a similarity too low by ``DEVIATIONS`` standard deviations. The rest are confirmed on full shingle
sets. By arithmetic a pair of similarity 0.75 is in no common bucket with a chance of 6e-6 (0.367 ** 12), its signatures are
too far with one of 1e-6 and its sketches with one of 1e-8; all fall quickly for higher similarities.

Buckets of many classes are not expanded into pairs. In each round the members of a bucket are compared with a few pivots,
which are then done with; confirmed links merge components, and buckets whose members are all in one component are
done. The others go on with further pivots (more in each round, up to a bound), so no link between components is lost.

After the first round, buckets that are still open hold classes that mostly share a passage or a template and are not linked.
Their members are put into other buckets: linked sets share one of the rarest shingles of each, of which a set needs its size
less what a link must share, plus one. What it must share grows with the size of the other, so there are buckets for each two
bands of sizes. A class whose own shingles outnumber these leaves at once; no linked pair is lost by that. Pivots are the
classes with the most common shingles, as those reach most others; at first, a few of each bucket join most of the others.

Joins that an exchange or a write follows leave hot keys to Spark's own splitting of skewed partitions; the others are salted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import per_text, row_key, table, unused, without
from tokenlake.llm.phrase_mining import bitmap, bits_for, has_bits
from tokenlake.operators.skew import join_groups, salted_join
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

# What separates words, A-Z in lower case.
BLANKS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = bytes(range(65)) + b"abcdefghijklmnopqrstuvwxyz" + bytes(range(91, 256))
TO_BLANK = bytes(0x20 if b in BLANKS else LOWER[b] for b in range(256))
SHINGLE = 5
PERCENT = 75
# Chunks of a signature and values in each; pairs that differ in FAR values are not confirmed.
CHUNKS, WIDTH = 12, 5
FAR = 33
# Bins of a sketch, a byte each; bins of which it holds a bit; how far below the bound the estimate of a linked pair may be.
BINS, BITS, DEVIATIONS = 1024, 256, 6.0
# Pairs of one pivot that a single task confirms.
PAIRS_PER_SALT = 64
# Pivots of the first round among rare shingles, from all of a bucket.
HUBS = 4
# Pivots that one bucket uses in one round grow by this factor up to the bound; the rest follow in later rounds.
PIVOT_GROWTH = 16
MAX_PIVOTS = 1024
# Sets of which the larger has at most this many times the size of the smaller are in one band, if they are not in two.
BAND = 1.08
# How many classes have a shingle at least, by rarity.
RARITY = (2, 8, 64, 1024)
# Shingles that are hashed for all signature values at a time.
BLOCK = 4096

SIGNED = T.StructType(
    [
        T.StructField("class", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("signature", T.ArrayType(T.ShortType())),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("bits", T.ArrayType(T.LongType())),
    ]
)


def shingles(data: bytes | None) -> set[bytes]:
    """Distinct five-word shingles; the whole sequence where there are fewer words."""
    words = data.translate(TO_BLANK).split(b" ") if data else []
    words = [w for w in words if w]
    if not words:
        return set()
    if len(words) < SHINGLE:
        return {b" ".join(words)}
    a, b, c, d = (words[i:] for i in range(1, SHINGLE))
    return set(map(b" ".join, zip(words, a, b, c, d)))


def _hashed(found: set[bytes]) -> np.ndarray:
    """64 well-mixed bits per shingle, the same in every process."""
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def sketch_of(hashes: np.ndarray, n_bins: int) -> np.ndarray:
    """A byte of the least hash in each bin of sorted hashes, from 1; 0 for an empty bin."""
    bins = (hashes >> np.uint64(65 - n_bins.bit_length())).astype(np.intp)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    sketch = np.zeros(n_bins, np.uint8)
    sketch[bins[first]] = hashes[first] % np.uint64(255) + np.uint64(1)
    return sketch


def bits_of(hashes: np.ndarray) -> list[int]:
    """One bit per bin, which is zero for an empty one."""
    return np.packbits(sketch_of(hashes, BITS) & 1).view(np.int64).tolist()


def sketches_allow(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the share of bins with equal least hashes, of those that are not empty in both, allows a link.

    The least hashes of the used bins are a sample, without replacement, of the union of both sets, whose size follows
    from the sum of ``sizes`` at the bound; small sets are nearly in full in their sketches.
    """
    used, wanted = np.maximum(((a | b) != 0).sum(axis=1), 1), PERCENT / 100
    share = ((a == b) & (a != 0)).sum(axis=1) / used
    unseen = np.clip(1 - used / np.maximum(sizes / (1 + wanted), 1), 0, 1)
    return share >= wanted - DEVIATIONS * np.sqrt(wanted * (1 - wanted) / used * unseen) - 2 / used


@F.arrow_udf(T.BooleanType())
def _alike(left: pa.Array, right: pa.Array, sizes: pa.Array) -> pa.Array:
    if not len(left):
        return pa.array([], pa.bool_())
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, BINS) for x in (left, right))
    return pa.array(sketches_allow(a, b, sizes.to_numpy()))


def _bits_allow() -> str:
    """SQL: sets of ``n`` and ``pn`` shingles with bits ``bits`` and ``pbits`` may be linked.

    Of the bins in use, at most as many as the union has elements, one in eight has another bit at the bound.
    """
    share = (100 - PERCENT) / 200
    used = f"least({BITS}, greatest(n, pn) * {100 / PERCENT})"
    errors = " + ".join(f"bit_count(bits[{i}] ^ pbits[{i}])" for i in range(BITS // 64))
    sizes = f"100 * least(n, pn) >= {PERCENT} * greatest(n, pn)"
    # Of a linked pair the first common shingle has as many behind it as must be common.
    behind = f"{100 + PERCENT} * least(n - at, pn - pat) >= {PERCENT} * (n + pn)"
    return f"{sizes} AND {behind} AND {errors} <= {share} * {used} + {DEVIATIONS} * sqrt({share * (1 - share)} * {used})"


def _band_starts(most: int = 1 << 40) -> np.ndarray:
    starts = [1]
    while starts[-1] < most:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    return np.array(starts, np.int64)


def _prefixes(n: int, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(lower band, upper band, shingles) for a set of ``n`` and each band of sizes that linked sets may have.

    One of so many first shingles, in an order that is the same for all, is among those of the other set.
    """
    least, most = -(-PERCENT * n // 100), 100 * n // PERCENT
    own, low, high = (int(np.searchsorted(starts, x, "right")) - 1 for x in (n, least, most))
    out = []
    for band in range(low, high + 1):
        common = -(-PERCENT * (n + max(least, int(starts[band]))) // (100 + PERCENT))
        out.append((min(own, band), max(own, band), n - common + 1))
    return out


def _signer():
    rng = np.random.default_rng(20_24)
    odd = rng.integers(0, 1 << 63, WIDTH * CHUNKS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, WIDTH * CHUNKS, dtype=np.uint64)[:, None]

    def sign(data: bytes | None) -> dict:
        words = data.translate(TO_BLANK).split() if data else []
        found = shingles(data)
        if not found:
            return {"class": None, "n": 0, "signature": None, "sketch": None, "bits": None}
        hashes, least = _hashed(found), None
        hashes.sort()
        for at in range(0, len(hashes), BLOCK):
            mixed = ((hashes[at : at + BLOCK] * odd + plus) >> np.uint64(32)).min(axis=1)
            least = mixed if least is None else np.minimum(least, mixed)
        # The low bits of the least value, as the high ones are near zero.
        bits = (least & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
        return {"class": hashlib.md5(b" ".join(words)).digest(), "n": len(found), "signature": bits.tolist(), "sketch": sketch_of(hashes, BINS).tobytes(), "bits": bits_of(hashes)}

    return sign


def _confirmer(spark: SparkSession):
    """Whether two texts (UTF-8) are linked, on full sets."""
    ship_package(spark)

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, kept = None, set()
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                a, b = a.as_py(), b.as_py()
                if a != last:
                    last, kept = a, shingles(a.encode())
                other = shingles(b.encode())
                both = len(kept & other)
                out.append(100 * both >= PERCENT * (len(kept) + len(other) - both))
            yield pa.array(out, pa.bool_())

    return linked


def _settled(work: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node that links reach, for every node of a link.

    Labels move along links and then jump to the label of the label, so long chains need few rounds.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = work.save(both, f"{name}-links")
    labels = work.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("node").alias("a"), "label"), "a")
        best = near.groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(best, "node").select("node", "label", F.least("label", "near").alias("new"))
        moved = work.save(moved, f"{name}-m{step}")
        ends = moved.select(F.col("node").alias("new"), F.col("new").alias("end"))
        jumped = moved.join(ends, "new")
        after = work.save(jumped.select("node", F.col("end").alias("label"), (F.col("end") != F.col("label")).alias("changed")), f"{name}-{step}")
        labels = after.select("node", "label")
        if not after.filter("changed").limit(1).count():
            return labels


def _buckets(signature: str) -> list:
    """A key per chunk and value left out of it."""
    slots = []
    for chunk in range(CHUNKS):
        for left_out in range(WIDTH):
            rest = [WIDTH * chunk + i for i in range(WIDTH) if i != left_out]
            slots.append(F.xxhash64(F.lit(WIDTH * chunk + left_out), *[F.get(signature, F.lit(i)) for i in rest]))
    return slots


def _among(keys: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is in ``keys``, and a few more: a bitmap of bounded size tells, so that no row moves."""
    ship_package(rows.sparkSession)
    size = bits_for(keys.count())
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(keys.select(F.col(column).bitwiseAND(F.lit(size - 1)).alias("slot")), size))

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(column).to_numpy().view(np.uint64) & np.uint64(size - 1)
            yield batch.filter(pa.array(has_bits(shared.value, slots)))

    return rows.mapInArrow(stay, rows.schema)


def _rare_buckets(work: Workspace, texts: DataFrame) -> DataFrame:
    """(bucket, node, at, odd): classes (node, text) by the shingles that they must share with a linked one.

    ``at`` shingles of the class come before that of the bucket; ``odd`` is high for many rare shingles. Shingles are ordered by how many classes have them, in steps, then by hash. Bitmaps of bounded size tell the steps; a
    false positive is one for all classes, so the order stays the same for all.
    """
    ship_package(work.spark)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                found = _hashed(shingles(text.as_py().encode())).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["h"])

    counts = texts.select("text").mapInArrow(each, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c"))
    counts = work.save(counts.filter(F.col("c") >= RARITY[0]), "shingles")
    steps = []
    for least in RARITY:
        common = counts.filter(F.col("c") >= least)
        size = bits_for(common.count())
        steps.append((size, bitmap(common.select(F.col("h").bitwiseAND(F.lit(size - 1)).alias("slot")), size)))
    shared = work.spark.sparkContext.broadcast(steps)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, mixer = _band_starts(), 0x9E3779B97F4A7C15
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text")):
                found = _hashed(shingles(text.as_py().encode()))
                step = sum(has_bits(bits, found & np.uint64(size - 1)).astype(np.int8) for size, bits in shared.value)
                own, odd, ordered = int((step == 0).sum()), int((len(RARITY) - step).sum()), found[np.lexsort((found, step))]
                # A bucket is a shingle and two bands.
                spans = [(np.uint64(((low << 32 | high) + 1) * mixer % 2**64), own, n) for low, high, n in _prefixes(len(found), starts) if n > own]
                if spans:
                    kept = np.concatenate([ordered[start:end] ^ key for key, start, end in spans]).view(np.int64)
                    at = np.concatenate([np.arange(start, end) for _, start, end in spans])
                    columns = [kept, np.full(len(kept), node, np.int64), at, np.full(len(kept), odd, np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "node", "at", "odd"])

    return texts.select("node", "text").mapInArrow(rarest, "bucket long, node long, at long, odd long")


def link_classes(work: Workspace, classes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(node, label) of classes (node long, n, signature) that are linked with another; None without links.

    ``texts`` has (node, text, sketch, bits) for all classes; only those of candidates leave their place.
    """
    rows = classes.select("node", F.explode(F.array(*_buckets("signature"))).alias("bucket"))
    # A class is in a bucket once, so a count tells those of several; counts combine on the map side.
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # Written first, so that Spark can split hot buckets in the join.
    shared = work.save(shared.select("bucket"), "shared")
    buckets = work.save(_among(shared, rows, "bucket").join(shared, "bucket"), "buckets")
    sketches = join_groups(texts.select("node", "sketch", "bits"), buckets.select("node").distinct(), ["node"])
    members = work.save(sketches.join(classes, "node"), "members")
    buckets = buckets.withColumns({"at": F.lit(0).cast("long"), "odd": F.lit(0).cast("long")})
    buckets = work.save(buckets.join(members.select("node", "n", "bits"), "node"), "places")
    ship_package(work.spark)
    linked, links, tried, labels, rare, step = _confirmer(work.spark), None, None, None, False, 0
    fields = ["bucket", "node", "n", "bits", "at", "odd"]
    while True:
        # Open buckets hold members of more than one component.
        placed = buckets.withColumn("label", F.col("node"))
        if labels is not None:
            placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        if tried is not None:
            placed = placed.join(tried, ["bucket", "node"], "left_anti")
        placed = work.save(placed.select(*fields, "label"), f"placed-{step}")
        # The largest component of a bucket needs no pivots: each other member meets it as a pivot of its own.
        counts = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("c"))
        several = counts.groupBy("bucket").agg(F.max_by("label", F.struct("c", "label")).alias("major"), F.count(F.lit(1)).alias("k"))
        several = work.save(several.filter("k > 1").select("bucket", "major"), f"open-{step}")
        if not several.limit(1).count():
            return labels
        if step == 1 and not rare:
            crowd = placed.join(several.select("bucket"), "bucket").select("node").distinct()
            crowd = work.save(join_groups(texts.select("node", "text"), crowd, ["node"]), "crowd")
            again = work.save(_rare_buckets(work, crowd), "rare")
            alone = again.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("bucket")
            again = again.join(work.save(alone, "rare-shared"), "bucket")
            buckets = work.save(again.join(members.select("node", "n", "bits"), "node"), "rare-places")
            rare, tried = True, None
            continue
        # A bucket that is done stays so, and the next rounds go without it.
        buckets = work.save(placed.join(several, "bucket"), f"met-{step}")
        part = F.pmod(F.xxhash64("node", F.lit(step)), F.lit(HUBS if step == 1 else min(PIVOT_GROWTH ** max(step - 1, 0), MAX_PIVOTS)))
        pivots = (buckets if step == 1 else buckets.filter("label != major")).groupBy("bucket", part.alias("part"))
        pivots = pivots.agg(F.min(F.struct("odd", "node", "label", "n", "bits", "at")).alias("p"))
        columns = [F.col(f"p.{c}").alias(x) for c, x in (("node", "pivot"), ("label", "plabel"), ("n", "pn"), ("bits", "pbits"), ("at", "pat"))]
        pivots = work.save(pivots.select("bucket", *columns), f"pivots-{step}")
        met = salted_join(buckets.drop("major"), pivots, ["bucket"], rows_per_salt=20_000).filter(f"label != plabel AND {_bits_allow()}")
        buckets = buckets.select(*fields)
        pairs = met.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        # Sets of unequal sizes cannot be linked, and far signatures hardly ever are.
        near = pairs
        for side in "ab":
            columns = [F.col(c).alias(x + side) for c, x in (("n", "n"), ("signature", "s"), ("sketch", "k"))]
            near = near.join(members.select(F.col("node").alias(side), *columns), side)
        errors = F.expr("aggregate(zip_with(sa, sb, (x, y) -> if(x = y, 0, 1)), 0, (s, x) -> s + x)")
        alike = (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")) & (errors < FAR)
        near = work.save(near.filter(alike).filter(_alike("ka", "kb", F.col("na") + F.col("nb"))).select("a", "b"), f"near-{step}")
        # Texts of pairs alone are copied, once per class.
        paired = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
        moved = work.save(join_groups(texts.select("node", "text"), paired, ["node"]), f"texts-{step}")
        second = near.join(moved.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        whole = salted_join(second, moved.select(F.col("node").alias("a"), F.col("text").alias("ta")), ["a"], rows_per_salt=PAIRS_PER_SALT)
        new = work.save(whole.filter(linked(F.col("ta"), F.col("tb"))).select("a", "b"), f"links-{step}")
        links = new if links is None else links.unionByName(new)
        if new.limit(1).count():
            labels = _settled(work, links, f"labels-{step}")
        tried = pivots.select("bucket", F.col("pivot").alias("node"))
        step += 1


def _with_components(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """:func:`near_duplicates` and the name of one more column, which names the component also where ids are NULL or repeat; it
    is NULL without shingles."""
    spark = docs.sparkSession
    added = ("n_shingles", "component_id", "kept")
    clean = without(docs, added)
    work = Workspace(spark, "near-dedup")
    sign = per_text(spark, SIGNED, _signer, as_bytes=True)
    signed = clean.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("_text"), sign(F.col(text_col)).alias("_s"))
    rows = work.save(signed.select("_id", "_key", "_text", "_s.*", F.monotonically_increasing_id().alias("node")), "rows")
    worded = rows.filter("class is not null")
    # A class is named by one of its rows, which gives its text; rows carry no text in this shuffle.
    firsts = worded.groupBy("class").agg(
        F.min("_id").alias("low"), F.min("node").alias("node"), F.first("n").alias("n"), F.first("signature").alias("signature")
    )
    firsts = work.save(firsts, "firsts")
    labels = link_classes(work, firsts.select("node", "n", "signature"), worded.select("node", F.col("_text").alias("text"), "sketch", "bits"))
    if labels is None:
        ids = firsts.select("class", F.col("node").alias("_component"), F.col("low").alias("component_id"))
    else:
        named = firsts.join(labels, "node", "left").select("class", "low", F.coalesce("label", "node").alias("label"))
        named = work.save(named, "named")
        least = named.groupBy("label").agg(F.min("low").alias("component_id"))
        ids = named.select("class", "label").join(least, "label").select("class", F.col("label").alias("_component"), "component_id")
    found = worded.select("_key", "class", "n").distinct().join(ids, "class")
    names = unused(clean, "_key", "_n", "_component", "_least")
    key, n, component, least = names
    found = found.select(F.col("_key").alias(key), F.col("n").alias(n), F.col("_component").alias(component), F.col("component_id").alias(least))
    out = clean.withColumn(key, row_key(id_col, text_col)).join(found, key, "left")
    reached = F.when(F.col(component).isNotNull(), F.col(least)).otherwise(F.col(id_col))
    results = (F.coalesce(F.col(n), F.lit(0)).cast("long"), reached, F.col(id_col).eqNullSafe(reached))
    return out.select(*clean.columns, *[value.alias(name) for value, name in zip(results, added)], component), component


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_shingles, component_id (the smallest id reachable over links, its own included) and kept.

    NULL, empty and wordless texts have no shingles and are linked with nothing. Rows of equal id and text are one
    document, so all of them get the same result. A NULL id comes after all others as component_id; its row is kept only if
    its component has no other id. Every input row gives one row, an empty table none; texts of any length are compared whole.
    Added columns replace columns of the same name, other columns keep their values.
    """
    found, component = _with_components(docs, id_col, text_col)
    return found.drop(component)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a single row of each component: that of the smallest id, NULL after all others, and then by content.

    Of repeated rows one stays. Rows without shingles are linked with nothing and all stay.
    """
    work = Workspace(docs.sparkSession, "near-dedup")
    # Written first, so that the numbers of equal rows hold.
    (row,) = unused(docs, "_row")
    rows = work.save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found, component = _with_components(rows, id_col, text_col)
    # Columns that the components replace come back from the rows themselves.
    place = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), row_key(*docs.columns).alias("key"), F.col(row).alias("row"))
    keyed = work.save(found.select(F.col(row), F.col(component)).join(rows.select(row, place.alias("place")), row), "components")
    first = keyed.filter(F.col(component).isNotNull()).groupBy(component).agg(F.min("place")["row"].alias(row))
    stays = keyed.filter(F.col(component).isNull()).select(row).unionByName(first.select(row))
    return join_groups(rows, stays, [row]).select(*docs.columns)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its set, its component and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id", "kept")
