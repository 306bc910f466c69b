"""The text operators against brute force on small tables with NULLs, empty texts, ties and repeated rows."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tokenlake.llm import decontaminate, lm_score, near_dedup, suffix_dedup, toxicity
from tokenlake.llm.line_dedup import dedup_units
from tokenlake.llm.quality_rules import apply_rules
from tokenlake.llm.secret_scan import redact
from tokenlake.workspace import Workspace

SCHEMA = "doc_id long, text string, kept string, label string"


def words(seed, n):
    return " ".join(f"w{(seed * 7919 + i * 104729) % 100003}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    long = words(3, 300)
    passage = words(9, 120)
    rows = [
        (1, None, None, "a"),
        (2, "", "x", None),
        (3, " \n\t", None, None),
        (4, long, None, "a"),
        (5, long, "y", "a"),
        (6, long.replace("w", "W", 1) + " end", None, "a"),
        (7, words(1, 60) + "\n" + passage + "\n" + words(2, 60), None, "a"),
        (8, words(5, 30) + " " + passage, None, "a"),
        (9, "two words", None, "a"),
        (10, "Two  words", None, "a"),
        (11, "aé" * 600, None, None),
        (None, words(8, 40), None, None),
        (12, words(6, 50), None, None),
        (12, words(6, 50), None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def covered(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = {j for i in range(len(d) - length + 1) if seen[d[i : i + length]] > 1 for j in range(i, i + length)}
        out.append((len(d), len(gone), bytes(b for i, b in enumerate(d) if i not in gone)))
    return out


@pytest.mark.parametrize("group", [1, 256])
def test_strings_removed_as_by_brute_force(docs, monkeypatch, group):
    # A bound of 1 sends every group of different surroundings to the comparison by Spark.
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = suffix_dedup.dedup_strings(docs).collect()
    assert len(rows) == docs.count()
    want = Counter(covered([r["text"] for r in docs.collect()], 400))
    assert Counter((r["n_bytes"], r["n_removed"], bytes(r["kept_bytes"])) for r in rows) == want
    assert sum(r["n_removed"] for r in rows) > 4000


def test_strings_leave_python_in_parts_of_bounded_size(monkeypatch):
    text = words(4, 3000)
    texts = pa.record_batch([pa.array([7, 8, 9]), pa.array([text, None, text])], ["_row", "text"])
    monkeypatch.setattr(suffix_dedup, "PLACES", 1000)
    monkeypatch.setattr(suffix_dedup, "FRAMES", 3)
    many = suffix_dedup.anchors(text.encode())[0].shape[1]
    found = list(suffix_dedup._places([texts, texts.slice(0, 0)]))
    assert sum(b.num_rows for b in found) == 2 * many and all(b.num_rows < 1000 + many for b in found)
    few = pa.table({"text": [text], "places": [[{**p, "n": 1, "large": True} for p in found[0].slice(0, 10).to_pylist()]]})
    frames = list(suffix_dedup._frames(few.to_batches()))
    assert [b.num_rows for b in frames] == [3, 3, 3, 1]
    cores = pa.Table.from_batches(suffix_dedup._cores(frames))
    width = suffix_dedup.FRAME - suffix_dedup.LENGTH + 1
    assert len(frames) and cores.num_rows <= 10 * (width // suffix_dedup.NEIGHBOURS + 1)
    wanted = [b.append_column("parts", pa.array([list(range(11))] * b.num_rows)) for b in frames]
    strings = list(suffix_dedup._each_string(wanted))
    assert all(b.num_rows <= 1000 + width for b in strings) and sum(b.num_rows for b in strings) > 9 * 100
    none = [b.append_column("parts", pa.array([[]] * b.num_rows, pa.list_(pa.int32()))) for b in frames]
    assert sum(b.num_rows for b in suffix_dedup._each_string(none)) == 0
    assert {tuple(r.values()) for b in strings for r in b.select(["side", "key"]).to_pylist()} <= {(r["side"], r["key"]) for r in found[0].to_pylist()}


def test_texts_and_groups_hashed_together_as_one_by_one():
    shared = words(5, 200)
    texts = [t.encode() for t in (words(1, 300) + shared, shared + words(2, 90), words(3, 60)[:400], "aé" * 900, shared)]
    found, digests = suffix_dedup.anchors_of_all(texts)
    alone = [suffix_dedup.anchors(t) for t in texts]
    want = Counter((i, *row, cids[16 * k : 16 * k + 16]) for i, (rows, cids) in enumerate(alone) for k, row in enumerate(rows.T.tolist()))
    assert Counter((*row, digests[16 * k : 16 * k + 16]) for k, row in enumerate(found.T.tolist())) == want and len(want) > 20
    rng = np.random.default_rng(1)
    data = [bytes(rng.integers(0, 256, 568, dtype=np.uint8)) for _ in range(3)]
    pairs = [(data[0], data[0][:500] + data[1][500:]), (data[1], data[2]), (data[0], data[0][9:])]
    member = pa.struct({"cid": pa.binary(), "off": pa.int32(), "bytes": pa.binary(), "n": pa.int64()})
    groups = [[{"cid": b"%d%d" % (i, j), "off": 568 - len(m), "bytes": m, "n": 1 + (i == 1 and j)} for j, m in enumerate(p)] for i, p in enumerate(pairs)]
    batch = pa.record_batch([pa.array([0, 1, 0], pa.int32()), pa.array([4, 5, 6]), pa.array(groups, pa.list_(member))], ["side", "key", "g"])
    got = [tuple(r.values()) for b in suffix_dedup._compared([batch]) for r in b.to_pylist()]
    assert got == [(0, 4, b"00", 0, 500), (0, 4, b"01", 0, 500), (1, 5, b"11", 0, 568), (0, 6, b"20", 9, 568), (0, 6, b"21", 9, 568)]
    assert got == [tuple(r.values()) for i in range(3) for b in suffix_dedup._compared([batch.slice(i, 1)]) for r in b.to_pylist()]


def test_tidy_workspace_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "shuffle_" in f}

    before, counts = files(), spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    assert Workspace(spark, "test", tidy=True).save(counts, "counts").count() == 7 and spark.conf.get(name) == setting
    spark.range(5).repartition(3).collect()
    plain = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    deadline = time.time() + 20
    Workspace(spark, "test").save(plain, "counts")
    assert files() - before, "without it they stay"
    before = files()
    Workspace(spark, "test", tidy=True).save(counts, "counts")
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before


def test_scores_of_texts_that_share_steps_and_tables():
    rng = np.random.default_rng(4)
    shapes = ((len(lm_score.OFFSETS), lm_score.CLASSES, lm_score.WIDTH), (lm_score.CLASSES, lm_score.WIDTH), (lm_score.CLASSES,))
    inputs, outputs, bias = (rng.normal(0, 0.5, shape).astype(np.float32) for shape in shapes)
    net = lm_score.Network({f"w{i}": i for i in range(1, 100)}, inputs, outputs, bias)
    frequent = {"w5": 900, "some": 40, "more": 7}
    totals = rng.random(lm_score.CLASSES)
    texts = [" ".join(rng.choice(["w5", "w70", "some", "more", "rare", "Rarer"], n)) for n in (3000, 1, 2, 3000, 50)]
    texts[2:2] = [None, "", " "]
    scorer = lm_score._Scorer(net, frequent, totals)
    got = scorer.scores(texts)
    assert [g["n"] for g in got] == [3000, 1, 0, 0, 0, 2, 3000, 50] and got == lm_score._Scorer(net, frequent, totals).scores(texts)
    for text, row in zip(texts, got):
        words = lm_score.words_of(text)
        ids = lm_score.classes_of(words, net.own)
        within = sum(math.log(frequent[w] + lm_score.PLUS) for w in words if w in frequent and w not in net.own) - totals[ids].sum()
        assert row["sum"] == pytest.approx(lm_score.pseudo_likelihood(net, ids) + within, rel=1e-5, abs=1e-5)
        assert row["others"] == [w for w in words if w.startswith("rare")]
    wide = lm_score.Network(net.own, inputs * 100, outputs, bias)
    assert lm_score._Scorer(wide, frequent, totals).scratch is None


@pytest.mark.parametrize("scale", [0.3, 300.0])
def test_network_steps_as_by_the_plain_formula(scale):
    rng, n = np.random.default_rng(2), 2 * lm_score.PART + 50
    shapes = ((len(lm_score.OFFSETS), lm_score.CLASSES, lm_score.WIDTH), (lm_score.CLASSES, lm_score.WIDTH), (lm_score.CLASSES,))
    inputs, outputs, bias = (rng.normal(0, scale**0.5, shape).astype(np.float32) for shape in shapes)
    ids = rng.integers(1, lm_score.CLASSES, n).astype(np.int32)
    near = lm_score._neighbours(ids)
    hidden = sum(inputs[d][near[d]].astype(float) for d in range(len(lm_score.OFFSETS)))
    logits = hidden @ outputs.T.astype(float) + bias
    logits -= logits.max(axis=1, keepdims=True)
    logs = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    probabilities = np.exp(logs)
    net = lm_score.Network({}, inputs.copy(), outputs.copy(), bias.copy())
    assert np.allclose(lm_score.log_likelihoods(net, ids, near), logs[np.arange(n), ids], rtol=1e-3, atol=1e-3)
    assert abs(lm_score.pseudo_likelihood(net, ids) - lm_score.log_likelihoods(net, ids, near).sum()) < 1e-6
    error = probabilities.copy()
    error[np.arange(n), ids] -= 1
    error /= n
    back = error @ outputs.astype(float)
    lm_score.gradient_step(net, ids, near, 0.5)
    assert np.allclose(net.outputs, outputs - 0.5 * error.T @ hidden, rtol=1e-3, atol=1e-3 * scale)
    assert np.allclose(net.bias, bias - 0.5 * error.sum(axis=0), rtol=1e-3, atol=1e-3)
    for d in range(len(lm_score.OFFSETS)):
        grown = np.zeros(shapes[0][1:])
        np.add.at(grown, near[d], back)
        assert np.allclose(net.inputs[d], inputs[d] - 0.5 * grown, rtol=1e-3, atol=1e-3 * scale)


def test_near_duplicates_as_by_all_pairs(docs):
    rows = near_dedup.near_duplicates(docs).collect()
    sets = {r["doc_id"]: near_dedup.shingles(r["text"].encode() if r["text"] else None) for r in docs.collect() if r["doc_id"]}
    label = {d: d for d in sets}
    for _ in sets:
        for a, s in sets.items():
            for b, t in sets.items():
                if s and t and 100 * len(s & t) >= 75 * len(s | t):
                    label[a] = min(label[a], label[b])
    found = {r["doc_id"]: r["component_id"] for r in rows}
    assert len(rows) == docs.count() and found.pop(None) is None and found == label
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert {d: c for d, c in found.items() if d != c} == {5: 4, 6: 4, 10: 9}


def test_found_pairs_are_confirmed_unless_their_signatures_are_far(spark):
    text, size = words(1, 60), near_dedup.CHUNKS * near_dedup.WIDTH
    one = list(range(1, size + 1))

    def differing(n):
        # The first chunk has one error, so it is always found.
        return [one[0], one[1], one[2], one[3], 1000, *[x + 1000 for x in one[5 : 4 + n]], *one[4 + n :]]

    near, far = differing(near_dedup.FAR - 1), differing(near_dedup.FAR)
    assert sum(x != y for x, y in zip(one, near)) == near_dedup.FAR - 1 == sum(x != y for x, y in zip(one, far)) - 1
    other = words(2, 60)
    same, bits = bytearray(b"\x07" * near_dedup.BINS), [1, 2, 3, 4]
    rows = [(0, text, 56, one), (1, text + " end", 57, near), (2, text + " END", 57, far), (3, other, 56, near)]
    table = spark.createDataFrame([(*r, same, bits) for r in rows], "node long, text string, n long, signature array<short>, sketch binary, bits array<long>")
    classes, texts = table.select("node", "n", "signature"), table.select("node", "text", "sketch", "bits")
    labels = near_dedup.link_classes(near_dedup.Workspace(spark, "near-dedup"), classes, texts)
    assert {r["node"]: r["label"] for r in labels.collect()} == {0: 0, 1: 0, 2: 0}
    assert near_dedup.link_classes(near_dedup.Workspace(spark, "near-dedup"), classes.filter("node <> 1"), texts) is None


def test_links_among_many_texts_with_a_common_passage(spark, monkeypatch):
    passage = words(1, 130).split()
    rows = []
    for i in range(90):
        own = words(100 + i, 60).split()
        rows.append((2 * i, " ".join(passage + own)))
        if i % 9 == 0:
            # Linked with the one before, by a set that is just similar enough.
            rows.append((2 * i + 1, " ".join(passage[:125] + own[:55] + words(1000 + i, 16).split())))
    rows += [(500, " ".join(passage)), (501, " ".join(passage[3:])), (502, "tiny"), (503, "tiny"), (504, " ".join(passage * 3))]
    sets = {d: near_dedup.shingles(t.encode()) for d, t in rows}
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    tables, save = {}, near_dedup.Workspace.save

    def watch(self, df, name, *rest):
        tables[name] = save(self, df, name, *rest)
        return tables[name]

    monkeypatch.setattr(near_dedup.Workspace, "save", watch)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == label and len(links) >= 12
    # The common passage fills buckets of the first round, but no bucket of rare shingles.
    assert tables["crowd"].count() > 60 > tables["rare-places"].select("node").distinct().count()


def test_copies_of_a_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    base, rng, rows = words(1, 150).split(), np.random.default_rng(5), []
    for i in range(400):
        text = list(base)
        for at in rng.integers(0, len(base), i % 12):
            text[at] = f"v{rng.integers(0, 4)}"
        rows.append((i + 1, " ".join(text[i % 3 :])))
    sets = {d: near_dedup.shingles(t.encode()) for d, t in rows}
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(12):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    tables, save = {}, near_dedup.Workspace.save

    def watch(self, df, name, *rest):
        tables[name] = save(self, df, name, *rest)
        return tables[name]

    monkeypatch.setattr(near_dedup.Workspace, "save", watch)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == label and len(set(label.values())) > 10
    compared = sum(t.count() for name, t in tables.items() if name.startswith("near-"))
    assert compared < 2 * len(rows) < len(links) / 4, compared


def test_prefixes_of_linked_sets_meet():
    rng, starts = np.random.default_rng(3), near_dedup._band_starts()
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        m = int(rng.integers(-(-3 * n // 4), 4 * n // 3 + 1))
        common = -(-75 * (n + m) // 175)
        if common > min(n, m):
            continue
        # The worst order: shingles of one set alone come first.
        one, other = (dict(((a, b), size) for a, b, size in near_dedup._prefixes(x, starts)) for x in (n, m))
        bands = tuple(sorted(int(np.searchsorted(starts, x, "right")) - 1 for x in (n, m)))
        assert one[bands] > n - common and other[bands] > m - common


def test_sketches_estimate_the_similarity():
    sign, rng = near_dedup._signer(), 17
    for n, changed in ((40, 1), (60, 2), (400, 8), (5000, 100), (5000, 1400), (3, 0)):
        one = words(rng, n).split()
        other = [f"x{i}" if i % max(1, n // max(1, changed)) == 5 else w for i, w in enumerate(one)]
        a, b = (" ".join(x).encode() for x in (one, other))
        s, t = near_dedup.shingles(a), near_dedup.shingles(b)
        exact = len(s & t) / len(s | t)
        x, y = (np.frombuffer(sign(d)["sketch"], np.uint8) for d in (a, b))
        used = ((x | y) != 0).sum()
        share = ((x == y) & (x != 0)).sum() / used
        assert abs(share - exact) <= near_dedup.DEVIATIONS * (0.25 / used) ** 0.5
        allowed = near_dedup.sketches_allow(x[None], y[None], np.array([len(s) + len(t)]))[0]
        assert allowed if exact >= 0.75 else not allowed or exact > 0.6
        errors = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(sign(a)["bits"], sign(b)["bits"]))
        used = min(near_dedup.BITS, max(len(s), len(t)) / 0.75)
        assert exact < 0.75 or errors <= 0.125 * used + near_dedup.DEVIATIONS * (0.109375 * used) ** 0.5
    assert sign(None)["sketch"] is None and sign(b"")["n"] == 0


def test_near_duplicates_leave_columns_of_any_name_alone(spark, docs):
    names = ("n", "class", "_key", "_component", "node", "low", "_row", "_first", "place", "row", "_n", "bucket")
    wide = docs.select("doc_id", "text", *[F.lit(f"{i}").alias(n) for i, n in enumerate(names)], F.lit("own").alias("kept"))
    found = near_dedup.near_duplicates(wide).collect()
    assert len(found) == docs.count() and {tuple(r[n] for n in names) for r in found} == {tuple(map(str, range(len(names))))}
    assert {r["doc_id"]: r["component_id"] for r in found}[5] == 4
    left = near_dedup.one_of_each(wide)
    assert left.columns == wide.columns and {r["kept"] for r in left.collect()} == {"own"}
    assert Counter(r["doc_id"] for r in left.collect())[5] == 0


def test_many_near_copies_are_one_component(spark):
    base = words(1, 400).split()
    rows = [(i, " ".join([*base[:i], f"v{i}", *base[i + 1 :]])) for i in range(120)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found} == {0}


def test_pipeline_keeps_one_row_of_each_component(spark):
    a, b, c, d = (words(i, 60) for i in (1, 2, 3, 4))
    rows = [
        (1, a, "x"), (1, a, "x"), (1, a, "w"), (1, a + " end", "x"), (2, a, "x"),
        (None, b, "x"), (None, b, "x"), (None, b + " end", "x"),
        (None, c, "x"), (4, c, "x"), (4, d, "x"),
        (5, None, "x"), (5, "", "x"),
    ]
    left = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "").collect()
    by_text = Counter((r["text"] or "").removesuffix(" end") for r in left)
    assert by_text == {a: 1, b: 1, c: 1, d: 1, "": 2}
    assert {r["doc_id"] for r in left if r["text"] in (c, d)} == {4} and len(left) == 6
    assert len({r["doc_id"] for r in left if r["text"] and r["text"].startswith(a)} ^ {1}) == 0


def test_quality_rules_on_odd_rows(docs):
    rows = apply_rules(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[d]["base_failed"] and not by_id[d]["kept"] and by_id[d]["n_words"] == 0 for d in (1, 2, 3))
    assert by_id[4]["n_words"] == 300
    assert apply_rules(docs).filter("kept").count() == sum(r["kept"] for r in rows)


def test_lines_keep_their_first_place(docs):
    rows = {r["doc_id"]: r for r in dedup_units(docs).collect()}
    assert rows[1]["kept_text"] is None and rows[1]["n_units"] == rows[2]["n_units"] == rows[3]["n_units"] == 0
    assert rows[4]["n_removed"] == 0 and rows[5]["n_removed"] == 1 and rows[5]["kept_text"] == ""


def test_short_lines_and_lines_without_blanks_are_deduplicated(spark):
    verse, han = "oh\nmy love\n\n}", "\u6587" * 500
    rows = [(1, verse), (2, verse), (3, han), (4, "new\n" + han)]
    got = {r["doc_id"]: r for r in dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_removed"] == got[3]["n_removed"] == 0
    assert got[2]["kept_text"] == "" and got[2]["n_removed"] == 3 and got[4]["kept_text"] == "new\n"
    few = dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), min_words=5).collect()
    assert sum(r["n_removed"] for r in few) == 0


def test_benchmark_windows(spark, docs):
    items = spark.createDataFrame([(1, words(9, 12)), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, items).collect()}
    assert rows[7]["hit_items"] == ["1"] and rows[7]["n_hit"] == 12 and rows[8]["n_hit"] == 12
    assert rows[10]["hit_items"] == ["4"] and rows[10]["n_hit"] == 2
    assert not rows[1]["contaminated"] and not rows[4]["contaminated"]
    none = decontaminate.decontaminate(docs, items.limit(0)).collect()
    assert len(none) == docs.count() and not any(r["contaminated"] for r in none)


def test_benchmark_windows_by_shuffle_carry_only_their_words(spark, docs, monkeypatch):
    items = spark.createDataFrame([(1, words(9, 12)), (4, "two words")], "item_id long, text string")
    joined, hits = [], decontaminate._hits

    def watch(*args):
        frame = hits(*args)
        joined.append((args[-1], frame._jdf.queryExecution().optimizedPlan().toString()))
        return frame

    monkeypatch.setattr(decontaminate, "_hits", watch)
    want = Counter(map(str, decontaminate.decontaminate(docs, items).collect()))
    for bound in ("BROADCAST_WINDOWS", "BROADCAST_BYTES"):
        with monkeypatch.context() as patch:
            patch.setattr(decontaminate, bound, 0)
            assert Counter(map(str, decontaminate.decontaminate(docs, items).collect())) == want
    assert [small for small, _ in joined] == [True, False, False]
    for _, plan in joined[1:]:
        assert plan.count(" AS _here#") == 2 and "_here#" in next(x for x in plan.splitlines() if "Join Inner" in x)


def test_toxicity_learns_and_folds(spark, docs):
    bad = [(f"you are a m0rоn and {words(i, 9)}", 1) for i in range(20)]
    good = [(f"you are a friend and {words(i + 50, 9)}", 0) for i in range(20)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(bad + good, "text string, toxic int"))
    assert " moron " in lexicon.weights
    probe = spark.createDataFrame([(1, "what a MORON he is"), (2, "a friend"), (3, None), (4, "")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(probe, lexicon).collect()}
    assert score[1] >= 0.5 and score[2] < 0.5 and score[3] == score[4] == 0.0
    assert toxicity.learn_lexicon(spark.createDataFrame([], "text string, toxic int")).weights == {}


def test_language_model_prefers_the_order_it_has_seen(spark, docs):
    texts = [(i, "one two three four five six " * 40) for i in range(60)]
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    net = lm_score.train_network(corpus, rounds=3)
    probe = spark.createDataFrame([(1, "one two three four five six " * 3), (2, "six one four two five three " * 3), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score_texts(probe, net).collect()}
    assert got[1]["mean_log_likelihood"] > got[2]["mean_log_likelihood"]
    assert got[3]["n_words"] == 0 and got[3]["log_likelihood"] == 0 and got[3]["mean_log_likelihood"] is None
    assert lm_score.score_texts(docs, lm_score.train_network(docs.limit(0))).count() == docs.count()


def test_rare_words_are_predicted_and_not_only_their_class(spark, monkeypatch):
    # Shares of 1 leave no word but own ones to the tasks, so that counts come from the join.
    common = [(i, " ".join(f"c{j}" for j in range(300))) for i in range(30)]
    corpus = spark.createDataFrame([*common, (99, "once")], "doc_id long, text string")
    clean = [f"c{j}" for j in range(300)]
    names = {}
    for i in range(100_000):
        names.setdefault(lm_score.hashed_class(f"x{i}"), f"x{i}")
    got = []
    for shares in (lm_score.SHARES, 1):
        monkeypatch.setattr(lm_score, "SHARES", shares)
        model = lm_score.train_network(corpus)
        assert model.n_words == 301 and model.words.count() == 301 and (len(model.frequent) == 0) == (shares == 1)
        # Each word without an own class gives way to one of the same class that the corpus does not have.
        garbage = [w if w in model.net.own else names[lm_score.hashed_class(w)] for w in clean]
        assert garbage != clean
        probe = spark.createDataFrame([(1, " ".join(clean)), (2, " ".join(garbage)), (3, None)], "doc_id long, text string")
        got.append({r["doc_id"]: r["log_likelihood"] for r in lm_score.score_texts(probe, model).collect()})
        changed = sum(a != b for a, b in zip(clean, garbage))
        assert got[-1][2] < got[-1][1] - 8 * changed and got[-1][3] == 0
        shared = [w for w in clean if w not in model.net.own]
        totals = {c: sum(30 for w in shared if lm_score.hashed_class(w) == c) + (lm_score.hashed_class("once") == c) for c in range(256)}
        kinds = {c: sum(lm_score.hashed_class(w) == c for w in [*shared, "once"]) for c in range(256)}
        want = lm_score.pseudo_likelihood(model.net, lm_score.classes_of(clean, model.net.own))
        for w in shared:
            c = lm_score.hashed_class(w)
            want += math.log(30.5 / (totals[c] + 0.5 * (kinds[c] + 1)))
        assert got[-1][1] == pytest.approx(want, rel=1e-6)
    assert got[0][2] == pytest.approx(got[1][2], rel=1e-4)


def test_redaction_keeps_clean_texts(docs):
    rows = Counter((r["doc_id"], r["text"]) for r in redact(docs).collect())
    assert rows == Counter((r["doc_id"], r["text"]) for r in docs.collect())


def test_empty_tables(docs):
    none = docs.limit(0)
    for operator in (apply_rules, dedup_units, near_dedup.near_duplicates, suffix_dedup.dedup_strings):
        assert operator(none).count() == 0


def test_toxicity_learns_without_moving_texts(spark, tmp_path, monkeypatch):
    docs = [(i, f"text {i}") for i in range(40)] + [(3, "again 3"), (None, "no id")]
    labels = [(i, 0, i % 2) for i in range(40)] + [(3, 0, 1), (3, 0, 1), (4, 0, None), (None, 0, 1)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = []
    learn = toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda training: seen.append(training) or learn(training))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.op4_toxicity(spark, str(tmp_path)).collect()
        got = Counter((r["text"], r["toxic"]) for r in seen[0].collect())
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    held_out = {i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0}
    want = Counter((t, y) for i, t in docs for j, _, y in labels if i == j and y is not None and i is not None and i not in held_out)
    assert got == want and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
