import pytest
from pyspark.sql import functions as F

from tokenlake.operators.prefix import running_total
from tokenlake.sources import corpus
from tokenlake.workspace import Workspace, shared_root

EOT = "<|endoftext|>"


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").cache()


def cut(raw, n):
    piece = raw[:n]
    while True:
        try:
            return piece.decode()
        except UnicodeDecodeError:
            piece = piece[:-1]


@pytest.mark.parametrize("limit", [1, 5_000, 12_345, 100_001, 250_002, 10**9])
def test_byte_budget(docs, limit):
    wanted, used = {}, 0
    for r in docs.orderBy("doc_id").collect():
        raw = r["text"].encode()
        if used < limit:
            wanted[r["doc_id"]] = cut(raw, limit - used)
        used += len(raw)
    kept = corpus.byte_budget(docs, limit).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == wanted
    assert all(r["kept_bytes"] == len(r["text"].encode()) for r in kept)


def test_byte_budget_cuts_whole_characters(spark):
    df = spark.createDataFrame([(1, "aé"), (2, ""), (3, "€\U0001f600x"), (4, "z")], "doc_id long, text string")
    for limit in range(0, 14):
        got = {r["doc_id"]: r["text"] for r in corpus.byte_budget(df, limit).collect()}
        wanted, used = {}, 0
        for i, t in ((1, "aé"), (2, ""), (3, "€\U0001f600x"), (4, "z")):
            if used < limit:
                wanted[i] = cut(t.encode(), limit - used)
            used += len(t.encode())
        assert got == wanted, limit


def test_byte_budget_does_not_shuffle_text(docs):
    plan = corpus.byte_budget(docs, 100_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_split_documents_keeps_empty_pieces(spark):
    text = f"a{EOT}{EOT}b c{EOT}"
    df = spark.createDataFrame([(1, text), (2, ""), (3, "x|y")], "doc_id long, text string")
    rows = corpus.split_documents(df, keep=("doc_id",)).orderBy("doc_id", "doc_pos").collect()
    assert [(r["doc_id"], r["doc_pos"], r["text"]) for r in rows] == [
        (i, p, t) for i, s in ((1, text), (2, ""), (3, "x|y")) for p, t in enumerate(s.split(EOT))
    ]


def test_marked_text_files(spark, tmp_path):
    pieces = ["one\ntwo", " three", "four é"]
    (tmp_path / "corpus.txt").write_text(EOT.join(pieces), encoding="utf-8")
    rows = corpus.read_marked_text(spark, str(tmp_path / "corpus.txt")).collect()
    assert [r["text"] for r in rows] == pieces


def test_train_valid_split_is_stable(docs):
    a = corpus.train_valid_split(docs).select("doc_id", "split")
    b = corpus.train_valid_split(docs.repartition(7)).select("doc_id", "split")
    assert a.exceptAll(b).count() == 0
    assert {r["split"] for r in a.collect()} == {"train", "valid"}


def test_pack_token_ids(spark):
    df = spark.createDataFrame([(1, [1, 65535]), (2, [65536]), (3, [])], "doc_id long, ids array<int>")
    rows = {r["doc_id"]: (r["n_tokens"], r["max_id"], r["width_bits"]) for r in corpus.pack_token_ids(df).collect()}
    assert rows == {1: (2, 65535, 16), 2: (1, 65536, 32), 3: (0, 0, 16)}
    with pytest.raises(Exception, match="token id 65536 exceeds 16 bits"):
        corpus.pack_token_ids(df, 16).collect()


def test_running_totals_over_all_and_over_one_huge_group(spark):
    n = 5_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("g"), "id", (F.col("id") % 7).alias("v")
    )
    rows = sorted(df.collect(), key=lambda r: r["id"])
    total, per_group = 0, {}
    want_all, want_group = {}, {}
    for r in rows:
        want_all[r["id"]] = total
        want_group[r["id"]] = per_group.get(r["g"], 0)
        total += r["v"]
        per_group[r["g"]] = per_group.get(r["g"], 0) + r["v"]
    assert {r["id"]: r["offset"] for r in running_total(df, "id", "v").collect()} == want_all
    grouped = running_total(df, "id", "v", groups=["g"])
    assert {r["id"]: r["offset"] for r in grouped.collect()} == want_group
    for frame in (running_total(df, "id", "v"), grouped):
        assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark, data):
    df = corpus.scan_corpus(spark, f"{data}/documents.parquet", ["doc_id", "lang"]).filter("lang = 'en'").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in plan and "text" not in plan


def test_workspace_is_in_the_shared_folder(spark):
    workspace = Workspace(spark, "w")
    assert workspace.path.startswith(shared_root(spark))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    table = workspace.save(spark.range(3).toDF("x"), "t")
    assert table.count() == 3
    workspace.drop("t")
    with pytest.raises(Exception):
        spark.read.parquet(f"{workspace.path}/t")
