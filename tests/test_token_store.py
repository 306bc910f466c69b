"""The packed token store: what is written is read, and windows read only what they touch."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenlake.functions import hashing
from tokenlake.operators import dataset
from tokenlake.sources import token_store
from tokenlake.sources.token_store import open_store, write_store

DOCS = [
    (5, [1, 2, 3]),
    (1, list(range(100, 130))),
    (2, []),
    (3, None),
    (4, [7] * 8),
    (None, [9, 9]),
    (6, list(range(8))),
    (6, list(range(8))),
    (6, [65535]),
    (7, []),
    (8, list(range(1000, 1100))),
    (9, []),
]
SCHEMA = "doc_id long, ids array<int>, block long, n_tokens string, stretch string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, v, 1, "x", "y") for k, v in DOCS], SCHEMA).repartition(3)


def in_order():
    return sorted(((k, v or []) for k, v in DOCS), key=lambda d: (d[0] is not None, d[0] or 0))


@pytest.mark.parametrize("block", [8, 3, 1 << 14])
@pytest.mark.parametrize("width", [16, 32])
def test_documents_and_stream_come_back(spark, docs, tmp_path, block, width):
    store = write_store(docs, str(tmp_path / "s"), width_bits=width, block=block)
    for held in (store, open_store(spark, str(tmp_path / "s"))):
        back = Counter((r["doc_id"], tuple(r["ids"]), r["n_tokens"]) for r in held.documents().collect())
        assert back == Counter((k, tuple(v or []), len(v or [])) for k, v in DOCS)
        stream = sorted(map(tuple, held.stream().collect()))
        assert [p for p, _, _ in stream] == list(range(held.n_tokens))
        flat = [(k, t) for k, v in in_order() if k != 6 for t in v]
        assert [(k, t) for _, k, t in stream if k != 6] == flat
        assert sorted(t for _, k, t in stream if k == 6) == sorted(t for k, v in DOCS if k == 6 for t in v)
    row = store.blocks().filter("n_tokens > 0").first()
    assert len(row["ids"]) == row["n_tokens"] <= block
    manifest = store.manifest().collect()
    assert sum(m["n_tokens"] for m in manifest) == sum(len(v or []) for _, v in DOCS)
    assert {(m["width_bits"], m["block"]) for m in manifest} == {(width, block)}


def test_ids_are_little_endian_and_of_the_declared_width(spark, docs, tmp_path):
    store = write_store(docs.filter("doc_id = 5"), str(tmp_path / "s"))
    packed = spark.read.parquet(f"{store.path}/blocks").filter("n_tokens > 0").first()
    assert bytes(packed["tokens"]) == b"\x01\x00\x02\x00\x03\x00"
    for wrong in (65_536, -1):
        bad = spark.createDataFrame([(1, [wrong])], "doc_id long, ids array<int>")
        with pytest.raises(Exception, match="does not fit 16 bits"):
            write_store(bad, str(tmp_path / f"bad{wrong}"))
    wide = write_store(spark.createDataFrame([(1, [65_536, 2**31 - 1])], "doc_id long, ids array<int>"), str(tmp_path / "w"), width_bits=32)
    assert wide.documents().first()["ids"] == [65_536, 2**31 - 1]
    with pytest.raises(ValueError):
        write_store(docs, str(tmp_path / "n"), width_bits=12)


@pytest.mark.parametrize("named", [0, 1024])
def test_windows_are_slices_of_the_stream(spark, docs, tmp_path, named, monkeypatch):
    from tokenlake.sources import token_store

    monkeypatch.setattr(token_store, "NAMED_BLOCKS", named)
    store = write_store(docs, str(tmp_path / "s"), block=8)
    flat = [r["token"] for r in store.stream().orderBy("pos").collect()]
    starts = spark.createDataFrame([(i, i) for i in range(len(flat))], "sample_id long, start long")
    got = {r["sample_id"]: r["tokens"] for r in store.windows(starts, 20).collect()}
    assert got == {i: flat[i : i + 20] for i in range(len(flat))}


def test_a_sample_reads_few_stretches_and_a_stream_has_no_join_on_the_key(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id as doc_id", "transform(sequence(1, 50), i -> cast((id * 50 + i) % 60000 as int)) as ids")
    store = write_store(docs.repartition(7), str(tmp_path / "s"), block=64, stretches=6)
    assert store.manifest().count() > 1
    few = store.sample_windows(1, 10, 3)
    plan = few._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], Read", plan)
    assert re.search(r"stretch#\d+ (=|IN|INSET)", filters[1]) and "block" in filters[2], filters[0]
    assert "CartesianProduct" not in plan
    start = few.first()["start"]
    assert few.first()["tokens"] == [(i + 1) % 60000 for i in range(start, start + 10)]
    stream = store.stream()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in stream and "hashpartitioning" not in stream and "rangepartitioning" not in stream
    drawn = spark.range(1).select((hashing.md5_number(hashing.keyed(3, F.col("id")), 15) % (store.n_tokens - 11)).alias("s")).first()["s"]
    assert start == drawn


def test_an_empty_corpus(spark, docs, tmp_path):
    store = write_store(docs.limit(0), str(tmp_path / "s"))
    assert store.n_tokens == 0 and store.stream().count() == 0 and store.documents().count() == 0
    with pytest.raises(ValueError):
        store.sample_windows(1, 4)


def test_pairs_of_windows(docs):
    windows = dataset.sample_windows(docs.filter("doc_id = 8").select("doc_id", "ids"), 5, 10, 1)
    pairs = dataset.next_token_pairs(windows, ("sample_id",), "tokens").collect()
    assert len(pairs) == 5 * 9 and all(p["target"] == p["context"] + 1 for p in pairs)


def test_blocks_are_unpacked_a_few_at_a_time(spark):
    block = np.arange(1000, dtype="<u2").tobytes()
    n = 5 * token_store.UNPACKED_AT_ONCE + 1
    unpack = token_store._unpacker()
    parts = list(unpack.func(iter([(pa.array([block] * n), pa.array([16] * n, pa.int32()))])))
    assert [len(p) for p in parts] == [token_store.UNPACKED_AT_ONCE] * 5 + [1]
    assert all(ids == list(range(1000)) for p in parts for ids in p.to_pylist())
