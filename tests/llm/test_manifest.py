"""The manifest against a plain tree over sorted rows."""

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tokenlake.llm.merkle_manifest import FIELDS, build_manifest, leaf_digest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, digest string, slots string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = (row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4])
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else ""))
        at >>= 1
    return out


def plain(rows):
    """One tuple per row, as the operator returns them, by sorting and walking whole trees."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built[name] = grow([leaf_of(r) for r in trees[name]])
    upper = grow([built[n][-1][0] for n in names])
    out = []
    for i, name in enumerate(names):
        for j, row in enumerate(trees[name]):
            steps = path(built[name], j) + path(upper, i)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1) if tampered else leaf_of(row)
            for right, other in steps:
                node = h(other, node) if right else h(node, other)
            root = upper[-1][0]
            out.append((row[0], leaf_of(row), built[name][-1][0], root, h(*[o for _, o in steps]), node, node == root))
    return Counter(out)


def manifest_of(df, **settings):
    fields = {name: F.col(name) for name in FIELDS}
    changed = leaf_digest(*(fields | {"n_chars": F.col("n_chars") + 1}).values())
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return build_manifest(df, "doc_id", leaf_digest(*fields.values()), F.col("lang"), F.when(picked, changed), **settings)


def found(manifest):
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[n] for n in names) for r in manifest.verify().collect())


def rows_of(n):
    langs = ["en", "en", "en", "de", None, "é"]
    rows = [(i * 37 % 5000 - 40, f"s{i % 3}", langs[i % 6], None if i % 11 == 0 else i, "x" * (i % 5)) for i in range(n)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, "a"), (2**63 - 1, "s", "en", 1, ""), (-(2**63), "s", "en", 1, None)]
    # Repeated rows and an id with several texts.
    return rows + [(7, "s", "en", 1, "same")] * 5 + [(7, "s", "en", 1, "other"), (7, "s", "zz", 1, "alone"), (9, "s", "en", 2, "y" * 1_000_000)]


@pytest.mark.parametrize("height", [10, 2])
def test_every_proof_as_by_a_plain_tree(spark, height):
    # Arrays of four slots need several rounds for these few rows.
    rows = rows_of(150)
    df = spark.createDataFrame([(*r, "t", 5, "d", "s") for r in rows], SCHEMA).repartition(5)
    got = found(manifest_of(df, height=height))
    assert got == plain(rows) and got.total() == len(rows)
    assert {r[-1] for r in got} == {True, False}


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(3, "s", "en", 1, "a", "t", 5, "d", "s")], SCHEMA)
    manifest = manifest_of(one)
    row = manifest.verify().first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf_of((3, "s", "en", 1, "a")) and row["proof_sha256"] == h()
    none = manifest_of(one.limit(0))
    assert none.root is None and none.verify().count() == 0 and none.subroots.count() == 0


def test_places_need_no_sort_of_the_group_and_words_of_bits_are_few(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "a", "t", 5, "d", "s") for i in range(1000)], SCHEMA)
    plan = manifest_of(df).verify()._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
