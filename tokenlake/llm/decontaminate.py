"""Benchmark decontamination with a broadcast hash set of test n-grams.

The windows of the benchmark are hashed, and windows of the training texts are looked up by hash in a
broadcast table; a hit is verified word by word. An item of fewer words than a window is one
window of its own length, so there is one lookup for each window length that occurs.

Only DataFrame functions. Training texts are not shuffled: what leaves the lookup are verified hits, and
those are small against the corpus. The benchmark's table is measured; one that is too large for a broadcast is
joined by shuffle instead, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.llm.common import row_key, table, without
from tokenlake.workspace import Workspace

# Words of the normalised text (A-Z in lower case), and the window.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
# Benchmark windows that are broadcast, at most; beyond it the lookup is a shuffle join.
BROADCAST_WINDOWS = 2_000_000
# And so many bytes of them.
BROADCAST_BYTES = 512 << 20


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; other letters stay as they are."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    # lower() is fast but also changes other letters; where it changes a word, only A-Z may count.
    return F.transform(found, lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, UPPER, LOWER)))


def _joined_hashes(df: DataFrame, words: str, length: int, out: str) -> DataFrame:
    """Adds ``out``: a hash of each window of ``length`` words, made of hashes of shorter windows."""
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    have = 1
    while have < length:
        step = min(have, length - have)
        shorter = F.slice(out, F.lit(1), F.greatest(F.size(out) - step, F.lit(0)))
        df = df.withColumn(out, F.transform(shorter, lambda h, i: F.xxhash64(h, F.get(F.col(out), i + step))))
        have += step
    return df


def benchmark_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, length, hash, words): the distinct windows of each item."""
    words = items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("_w"))
    length = F.least(F.size("_w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("_w") - length + 1)
    cut = words.filter(F.size("_w") > 0).select(
        "item",
        length.alias("length"),
        F.explode(F.transform(starts, lambda i: F.slice("_w", i, length))).alias("words"),
    )
    return cut.distinct()


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """(_key, _at, length, window): verified places, word positions from 0."""
    found = None
    for length in lengths:
        hashed = _joined_hashes(docs, "_words", length, "_h")
        # The outer form, as the plain one would add a filter that evaluates the hashes again and again.
        placed = hashed.select("_key", "_words", F.posexplode_outer("_h").alias("_at", "hash"))
        known = windows.filter(F.col("length") == length)
        here = F.slice("_words", F.col("_at") + 1, F.lit(length))
        if small:
            known, same = F.broadcast(known), here == F.col("words")
        else:
            # Only the window of a place is shuffled, not all words of its text.
            placed, same = placed.select("_key", "_at", "hash", here.alias("_here")), F.col("_here") == F.col("words")
        part = placed.join(known, "hash").filter(same).select("_key", "_at", "length", "window")
        found = part if found is None else found.unionByName(part)
    return found


def _covered(starts_and_ends: Column) -> Column:
    """Words inside any of the (start, end) pairs, which are sorted."""
    return F.aggregate(
        starts_and_ends,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
    )["n"]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_items (sorted strings), hit_spans (word positions) and contaminated.

    A word is hit if it lies in an occurrence of a benchmark window. NULL, empty and wordless texts have no words; items
    without words have no windows, and an empty benchmark hits nothing. Repeated rows, and rows of equal id and
    text, get equal results; every input row gives one row. Added columns replace columns of the same name.
    """
    spark = docs.sparkSession
    added = ("n_words", "n_hit", "hit_items", "hit_spans", "contaminated")
    clean = without(docs, added)
    work = Workspace(spark, "decontaminate")
    by_item = work.save(benchmark_windows(items, item_col, item_text_col, window), "windows")
    # A window that many items share is looked up once; its items are joined to the hits.
    distinct = by_item.groupBy("length", "words").agg(F.min("item").alias("_any")).drop("_any")
    distinct = distinct.withColumn("window", F.unhex(F.md5(F.array_join("words", " "))))
    sizes = {r["length"]: r["n"] for r in distinct.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    added_words = clean.withColumn("_key", row_key(id_col, text_col)).withColumn("_words", words_of(F.col(text_col)))
    none = F.array().cast("array<struct<start:int,end:int>>")
    if not sizes:
        return added_words.select(
            *clean.columns,
            F.size("_words").cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("hit_items"),
            none.alias("hit_spans"),
            F.lit(False).alias("contaminated"),
        )
    lookup = work.save(_window_hashes(distinct, sorted(sizes)), "lookup")
    in_memory = F.octet_length(F.array_join("words", "")) + 16 * F.size("words") + 64
    small = sum(sizes.values()) <= BROADCAST_WINDOWS and lookup.agg(F.sum(in_memory)).first()[0] <= BROADCAST_BYTES
    hits = work.save(_hits(added_words.select("_key", "_words"), lookup, sorted(sizes), small), "hits")
    spans = hits.groupBy("_key").agg(
        F.array_sort(F.collect_set(F.struct(F.col("_at").alias("start"), (F.col("_at") + F.col("length")).alias("end")))).alias(
            "hit_spans"
        )
    )
    window_items = by_item.select(F.unhex(F.md5(F.array_join("words", " "))).alias("window"), "item")
    in_items = hits.select("_key", "window").distinct().join(window_items, "window")
    found_items = in_items.groupBy("_key").agg(F.array_sort(F.collect_set("item")).alias("hit_items"))
    counted = clean.withColumn("_key", row_key(id_col, text_col)).withColumn(
        "n_words", F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    )
    hit = spans.join(found_items, "_key")
    return (
        counted.join(hit, "_key", "left")
        .withColumn("hit_spans", F.coalesce("hit_spans", none))
        .withColumn("hit_items", F.coalesce("hit_items", F.array().cast("array<string>")))
        .withColumn("n_hit", _covered(F.col("hit_spans")).cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .select(*clean.columns, *added)
    )


def _window_hashes(distinct: DataFrame, lengths: list[int]) -> DataFrame:
    """(length, words, window, hash), hashed as the windows of the training texts are."""
    parts = []
    for length in lengths:
        hashed = _joined_hashes(distinct.filter(F.col("length") == length), "words", length, "_h")
        parts.append(hashed.select("length", "words", "window", F.get("_h", F.lit(0)).alias("hash")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, benchmark items that it contains windows of."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


# Every window of every text by position, joined to the distinct windows of the benchmark.
ORACLE = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id, w, least(len(w), {WINDOW}) AS k FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark)
    WHERE len(w) > 0
), bw AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM item)
), dw AS (
    SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM item) WHERE len(w) >= k)
), hits AS (
    SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw USING (s) WHERE dw.k = bw.k
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS joined
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS v FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
