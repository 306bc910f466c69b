"""Merkle manifest of a dataset: a digest per row, a tree per group, proofs for single rows.

Where a row stands in the tree of its group follows from bitmaps and not from a sort. The ids of a group set bits in words
of 64 ids; only words with a bit exist, so sparse ids cost one word each, and words of different tasks merge by OR. A
popcount directory holds the bits before each word, in two levels: words within a block of 64 words, blocks within the
group. The place of a row is the entry of its word plus the bits below its own, a rank query in the JVM. Ids that occur
more than once leave their words crowded; rows of such words are numbered by a range-partitioned running total instead,
by id, then digest.

Places then key slot arrays of 1,024 neighbours. A task reduces one array by ten levels, so a tree of n rows takes
log1024(n) rounds; proofs come back down the same arrays. No group, however large, is in one task, and the driver holds
one root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.llm.common import table
from tokenlake.operators.prefix import running_total
from tokenlake.operators.skew import join_groups, salted_join
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

# Levels that one slot array is reduced by; it has 2**HEIGHT slots.
HEIGHT = 10
# The word that rows without an id share; no 64-bit id has it.
NO_ID = -(1 << 57) - 1
# The fields of a leaf, in order, and the divisor that picks rows to tamper with.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
# How a proof step goes on: no sibling, sibling to the right, sibling to the left.
ALONE, RIGHT, LEFT = 0, 1, 2


def leaf_digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and value."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def digest_of(*children: bytes) -> bytes:
    return sha256(b"".join(c.hex().encode() for c in children)).digest()


def reduce_slots(slots: list[bytes], n: int, height: int) -> list[list[bytes]]:
    """All levels of a slot array, leaves first: up to one node if it holds all ``n`` nodes of its tree, else ``height`` levels."""
    levels = [slots]
    while len(levels[-1]) > 1 if n <= 1 << height else len(levels) <= height:
        last = levels[-1]
        levels.append([digest_of(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings(levels: list[list[bytes]], slot: int) -> bytes:
    """The steps from a slot to the top of its array: a byte each, and the sibling's digest if there is one."""
    steps = []
    for level in levels[:-1]:
        other = slot ^ 1
        if other < len(level):
            steps.append((b"\x02" if slot & 1 else b"\x01") + level[other])
        else:
            steps.append(b"\x00")
        slot >>= 1
    return b"".join(steps)


def fold(leaf: bytes, proof: bytes) -> tuple[bytes, bytes]:
    """(root, digest of the siblings) that a leaf and its proof lead to."""
    node, at, others = leaf, 0, []
    while at < len(proof):
        step = proof[at]
        if step == ALONE:
            node, at = digest_of(node), at + 1
            continue
        other = proof[at + 1 : at + 33]
        others.append(other)
        node, at = digest_of(node, other) if step == RIGHT else digest_of(other, node), at + 33
    return node, digest_of(*others)


def place_leaves(leaves: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``place`` from 0 in their tree, one row (tree, n) per tree).

    ``leaves`` is a written table (tree, id long, row unique, digest, other).
    """
    low = F.coalesce(F.col("id").bitwiseAND(63), F.lit(0)).cast("int")
    placed = leaves.withColumn("word", F.coalesce(F.shiftright("id", 6), F.lit(NO_ID))).withColumn("bit", low)
    # Partial words of the tasks meet by OR; counts tell words with repeated ids.
    bits = F.expr("bit_or(shiftleft(1L, bit))")
    words = work.save(placed.groupBy("tree", "word").agg(bits.alias("bits"), F.count(F.lit(1)).alias("n")), "words")
    words = words.withColumn("block", F.shiftright("word", 6))
    blocks = words.groupBy("tree", "block").agg(F.sum("n").alias("n"))
    before_block = running_total(blocks, "block", "n", "before", ["tree"])
    # A block has at most 64 words, which Spark numbers by one sum over them.
    held = F.array_sort(F.collect_list(F.struct("word", "bits", "n")))
    in_block = words.groupBy("tree", "block").agg(held.alias("held")).join(before_block, ["tree", "block"])
    so_far = F.expr("aggregate(slice(held, 1, at), before, (s, x) -> s + x.n)")
    directory = in_block.select("tree", "before", "held", F.posexplode("held").alias("at", "w")).select(
        "tree", "w.word", "w.bits", "w.n", so_far.alias("first")
    )
    directory = work.save(directory, "directory")
    counts = work.save(directory.groupBy("tree").agg(F.sum("n").alias("n")), "counts")
    crowded = F.col("n") > F.bit_count("bits")
    known = salted_join(placed, directory.withColumn("crowded", crowded).drop("n"), ["tree", "word"])
    rank = F.expr("first + bit_count(bits & ~shiftleft(-1L, bit))")
    columns = ("tree", "id", "digest", "other")
    if directory.filter(crowded).isEmpty():
        return known.select(*columns, rank.alias("place")), counts
    known = work.save(known, "known")
    alone = known.filter("NOT crowded").select(*columns, rank.alias("place"))
    order = F.struct("id", "digest", "row", "other").alias("row")
    together = known.filter("crowded").select("tree", "word", "first", order, F.lit(1).alias("one"))
    # The first place of its word travels with a row's group.
    numbered = running_total(together, "row", "one", "before", ["tree", "word", "first"])
    rest = numbered.select("tree", "row.id", "row.digest", "row.other", (F.col("first") + F.col("before")).alias("place"))
    return alone.unionByName(rest), counts


_PROOFS = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("proof", pa.binary()), ("top", pa.binary())])
_VERIFIED = pa.schema(
    [("id", pa.int64())]
    + [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    + [("verified", pa.bool_())]
)


def _each_row(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time, since each holds a slot array."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrays(nodes: DataFrame, counts: DataFrame, height: int, payload: list[str]) -> DataFrame:
    """Slot arrays of nodes (tree, place, digest, payload), with the number of nodes of their tree."""
    slots = F.array_sort(F.collect_list(F.struct("place", "digest", *payload)))
    grouped = nodes.withColumn("block", F.shiftright("place", height)).groupBy("tree", "block").agg(slots.alias("slots"))
    return join_groups(grouped, counts, ["tree"])


def _tops(arrays: DataFrame, height: int) -> DataFrame:
    """(tree, place, digest, n): the node above each slot array."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for slots, n in zip(batch.column("slots"), batch.column("n").to_pylist()):
                leaves = slots.values.field("digest").to_pylist()
                tops.append(reduce_slots(leaves, n, height)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("block"), pa.array(tops, pa.binary()), batch.column("n")],
                ["tree", "place", "digest", "n"],
            )

    return arrays.mapInArrow(reduce, "tree string, place long, digest binary, n long")


def build_rounds(nodes: DataFrame, counts: DataFrame, work: Workspace, height: int, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """(slot arrays of each round (tree, block, slots, n), ``n`` the nodes of the tree at that height; top nodes (tree, digest,
    last), ``last`` the round in which a tree ended)."""
    most = counts.agg(F.max("n")).first()[0] or 0
    rounds, tops, at, slots = [], None, 0, 1 << height
    while True:
        arrays = work.save(_arrays(nodes, counts, height, payload), f"arrays-{at}")
        rounds.append(arrays)
        above = work.save(_tops(arrays, height), f"nodes-{at}")
        ended = above.filter(F.col("n") <= slots).select("tree", "digest", F.lit(at).alias("last"))
        tops = ended if tops is None else tops.unionByName(ended)
        if most <= slots:
            return rounds, tops
        nodes = above.filter(F.col("n") > slots).select("tree", "place", "digest")
        counts = counts.filter(F.col("n") > slots).withColumn("n", F.expr(f"(n + {slots - 1}) div {slots}"))
        most, payload, at = -(-most // slots), [], at + 1


def _node_proofs(arrays: DataFrame, height: int) -> DataFrame:
    """(tree, place, proof, top) of the nodes in slot arrays that carry the proof of what is above them."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _each_row(batch):
                levels = reduce_slots([s["digest"] for s in row["slots"]], row["n"], height)
                out = [(row["tree"], s["place"], siblings(levels, i) + row["proof"], row["top"]) for i, s in enumerate(row["slots"])]
                yield _as_batch(out, _PROOFS)

    return arrays.mapInArrow(steps, "tree string, place long, proof binary, top binary")


def _with_upper(rounds: list[DataFrame], trees: DataFrame, height: int) -> DataFrame:
    """The first round's slot arrays, each with ``proof``, the steps from its top to the root, and ``top``, its tree's.

    ``trees`` has (tree, last, proof, top): the steps from the top of a tree on.
    """
    above = None
    for at in range(len(rounds) - 1, -1, -1):
        ended = trees.filter(F.col("last") == at).select("tree", F.lit(0).cast("long").alias("block"), "proof", "top")
        upper = ended if above is None else ended.unionByName(above)
        arrays = join_groups(rounds[at], upper, ["tree", "block"])
        if at == 0:
            return arrays
        above = _node_proofs(arrays, height).select("tree", F.col("place").alias("block"), "proof", "top")
    raise AssertionError("a manifest has a round")


@dataclass(frozen=True)
class Manifest:
    """A tree over a table. ``subroots`` has (tree, digest), trees named ``-`` for NULL and ``=value`` else;
    ``arrays`` the slot arrays of the leaves with their upper proofs; ``root`` is None for an empty table."""

    subroots: DataFrame
    arrays: DataFrame
    root: bytes | None
    height: int

    def verify(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified): every leaf folded along its proof.

        A leaf with ``other`` is folded from that digest instead of its own. Digests are lowercase hex.
        """
        root, height = self.root, self.height

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _each_row(batch):
                    levels = reduce_slots([s["digest"] for s in row["slots"]], row["n"], height)
                    out = []
                    for i, slot in enumerate(row["slots"]):
                        given = slot["digest"] if slot["other"] is None else slot["other"]
                        folded, proof = fold(given, siblings(levels, i) + row["proof"])
                        digests = (slot["digest"], row["top"], root, proof, folded)
                        out.append((slot["id"], *(d.hex() for d in digests), folded == root))
                    yield _as_batch(out, _VERIFIED)

        return self.arrays.mapInArrow(
            check, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )


def build_manifest(rows: DataFrame, id_col: str, leaf: Column, group: Column, other: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``: a leaf (hex) per row, a tree per ``group`` in order of the integer ``id_col``.

    NULL ids come first in their tree and NULL groups are a tree of their own, the first. Rows that share an id are
    ordered by leaf; equal rows have equal leaves and take neighbouring places. ``other``, if given and not NULL, is a
    digest to verify in place of the leaf. An empty table has no rows and no root. Texts of any length are hashed whole;
    columns that the expressions don't name are not read, whatever their names.
    """
    spark = rows.sparkSession
    ship_package(spark)
    work = Workspace(spark, "manifest")
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))
    leaves = work.save(
        rows.select(
            tree.alias("tree"),
            F.col(id_col).cast("long").alias("id"),
            F.unhex(leaf).alias("digest"),
            (F.lit(None).cast("binary") if other is None else F.unhex(other)).alias("other"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "leaves",
    )
    placed, counts = place_leaves(leaves, work)
    rounds, tops = build_rounds(placed, counts, work, height, ["id", "other"])
    tops = work.save(tops, "tops")
    # The trees, in order of their names, are the leaves of the last tree.
    order = running_total(tops.select("tree", F.lit(1).alias("one")), "tree", "one", "place")
    named = work.save(tops.join(order, "tree").select(F.lit("").alias("tree"), "place", "digest", F.col("tree").alias("name")), "trees")
    if named.isEmpty():
        empty = rounds[0].withColumns({"proof": F.lit(b""), "top": F.lit(b"")})
        return Manifest(tops.select("tree", "digest"), empty, None, height)
    total = named.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    upper_rounds, root_row = build_rounds(named, total, Workspace(spark, "manifest-trees"), height, [])
    root_row = root_row.select("tree", "last", "digest").first()
    start = spark.createDataFrame([("", root_row["last"], bytearray(), bytearray(root_row["digest"]))], "tree string, last int, proof binary, top binary")
    proofs = _node_proofs(_with_upper(upper_rounds, start, height), height).select("place", "proof")
    trees = named.join(proofs, "place").select(F.col("name").alias("tree"), "proof", F.col("digest").alias("top"))
    trees = work.save(trees.join(tops.select("tree", "last"), "tree"), "tree-proofs")
    return Manifest(tops.select("tree", "digest"), _with_upper(rounds, trees, height), bytes(root_row["digest"]), height)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: leaf, subroot of its language, root, digest of its proof, and what a tampered row folds to."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    fields = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(*fields.values())
    # An unsigned checksum of the decimal id picks the rows whose n_chars is one too high.
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    changed = leaf_digest(*(fields | {"n_chars": F.col("n_chars") + 1}).values())
    manifest = build_manifest(docs, "doc_id", leaf, F.col("lang"), F.when(picked, changed))
    return manifest.verify().withColumnRenamed("id", "doc_id")


def _sql_fold(zero: str) -> str:
    """CRC-32 of the digits of doc_id, as a fold over its characters."""
    step = "list_reduce([xor(c, x::bigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    codes = "list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)"
    return f"xor(list_reduce(list_prepend({zero}::bigint, {codes}), lambda c, x: {step}), {zero}::bigint)"


def _sql_leaf(n_chars: str) -> str:
    parts = [
        f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")
    ]
    return f"sha256({' || '.join(parts)})"


ORACLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_sql_leaf("n_chars")}) - 1 AS pos,
           {_sql_leaf("n_chars")} AS leaf,
           CASE WHEN {_sql_fold("4294967295")} % {TAMPER_EVERY} = 0 THEN {_sql_leaf("(n_chars + 1)")} END AS other
    FROM documents
), nodes(lang, level, pos, h, n) AS (
    SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
    UNION ALL
    SELECT lang, min(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY lang, pos // 2
), subroots AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper_nodes(level, pos, h, n) AS (
    SELECT 0, pos, h, n FROM subroots
    UNION ALL
    SELECT min(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (min(n) + 1) // 2 FROM upper_nodes WHERE n > 1 GROUP BY pos // 2
), paths AS (
    SELECT l.doc_id, l.lang, l.pos, n.level AS step, (l.pos >> n.level) & 1 AS is_right, s.h AS other
    FROM leaves l JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang AND n.pos = l.pos >> n.level AND n.n > 1
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM n.lang AND s.level = n.level AND s.pos = xor(n.pos, 1)
    UNION ALL
    SELECT l.doc_id, l.lang, l.pos, 1000 + u.level, (r.pos >> u.level) & 1, s.h
    FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
    JOIN upper_nodes u ON u.pos = r.pos >> u.level AND u.n > 1
    LEFT JOIN upper_nodes s ON s.level = u.level AND s.pos = xor(u.pos, 1)
), proofs AS (
    SELECT lang, pos, list(struct_pack(r := is_right, o := coalesce(other, '')) ORDER BY step) AS steps FROM paths GROUP BY lang, pos
), folded AS (
    SELECT l.*, coalesce(array_to_string(list_transform(steps, lambda s: s.o), ''), '') AS others,
           list_reduce(list_prepend(struct_pack(r := 0::bigint, o := coalesce(l.other, l.leaf)), coalesce(steps, [])),
               lambda a, s: struct_pack(r := 0::bigint, o := sha256(CASE WHEN s.r = 1 THEN s.o || a.o ELSE a.o || s.o END))).o AS folded_root
    FROM leaves l LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
)
SELECT f.doc_id, f.leaf, s.h AS subroot, u.h AS root, sha256(f.others) AS proof_sha256, f.folded_root, f.folded_root = u.h AS verified
FROM folded f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang CROSS JOIN (SELECT h FROM upper_nodes WHERE n = 1) u
"""
