"""Phrase collocation mining with counting quotient filters.

Words that occur often enough get dense ids, one per language and word, so an id also tells the language. The corpus is
rewritten once as ids, 0 where a phrase cannot go on. Phrases of 2, 3, ... words are then counted level by level: a task
packs the ids of each place, counts them in a quotient filter and hands on the filter's buckets; filters of a bucket are
merged. A place counts at a level only if both phrases one word shorter are frequent, which a bitmap of bounded size
answers; its false positives cost work but change no count.

Bucket names come from an invertible permutation of the key, so buckets are even however frequent a phrase is: a filter
holds it once. Counts, cuts and scores are exact. Only the most frequent words, a bounded number, are broadcast; rarer ones
are joined to the places that may hold them.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenlake.llm.common import table
from tokenlake.llm.quotient_filter import WORD, CountingFilter, Layout, mix
from tokenlake.operators.prefix import running_total
from tokenlake.operators.skew import join_groups, salted_join, table_bytes
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

LEAST, LONGEST, COVER, TOP = 100, 5, 100, 2000
NO_LANG = "und"
# Characters that end a piece; lower-cased A-Z and these as a break, other blanks as a space.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # no byte of UTF-8 text
_TABLE = bytes.maketrans(BREAKS + b"\t" + bytes(range(65, 91)), BREAK * len(BREAKS) + b" " + bytes(range(97, 123)))
# Words that are broadcast: at most so many, none longer than so many bytes.
SHARED_WORDS, SHARED_BYTES = 500_000, 64
# Distinct words that a task counts before it hands them on, ids in a row of the rewritten corpus, places in a filter.
WORDS_AT_ONCE, ROW_IDS, PLACES = 1 << 18, 1 << 18, 1 << 20
# Places of the corpus for one bucket.
BUCKET = 1 << 19
# Bits of the bitmaps of frequent phrases, per phrase and at most.
BITS_EACH, MOST_BITS = 16, 1 << 28
SLICE_BITS = 1 << 15  # Spark's bitmaps
_SLOT_SALT = 7


def words_of(data: bytes) -> list[bytes]:
    """Words with a BREAK between pieces."""
    return data.translate(_TABLE).replace(BREAK, b" " + BREAK + b" ").split()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    texts = batch.column("text").cast(pa.binary())
    for lang, text in zip(batch.column("lang").to_pylist(), texts):
        if text.is_valid:
            yield lang, text.as_py()


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of (lang, text): all occurrences. Tasks count their own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, seen in counts.items():
                seen.pop(BREAK, None)
                words = pa.array(list(seen), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(seen), pa.string()), words, pa.array(seen.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "f"])
            counts.clear()

        for batch in batches:
            for lang, text in _texts(batch):
                counts.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, counts.values())) > WORDS_AT_ONCE:
                    yield from flush()
        yield from flush()

    partial = docs.mapInArrow(count, "lang string, word string, f long")
    return partial.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def bitmap(slots: DataFrame, size: int) -> np.ndarray:
    """``size`` bits, set at the given slots; at most MOST_BITS come to the driver."""
    place = F.col("slot") + 1
    parts = slots.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(max(size, SLICE_BITS) // 8, np.uint8)
    for row in parts.toArrow().to_pylist():
        at = (row["part"] - 1) * (SLICE_BITS // 8)
        out[at : at + SLICE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def bits_for(n: int) -> int:
    return min(MOST_BITS, max(SLICE_BITS, 1 << (n * BITS_EACH).bit_length()))


def has_bits(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[(slots >> WORD(3)).astype(np.int64)] >> (slots & WORD(7)).astype(np.uint8)) & 1 == 1


def _slots(cells: list[np.ndarray], size: int) -> np.ndarray:
    return mix(cells, _SLOT_SALT) >> WORD(64 - (size.bit_length() - 1))


@dataclass(frozen=True)
class Dictionary:
    """Ids from 1 of frequent words, the most frequent first: a table (lang, word, f, id), the broadcast part of it,
    and a bitmap of the words of the rest if there are any."""

    words: DataFrame
    size: int
    shared: Broadcast
    rest: DataFrame | None
    rest_bits: Broadcast | None


def _word_slot(size: int) -> Column:
    return F.crc32(F.concat("lang", F.lit("\x00"), "word").cast("binary")).bitwiseAND(F.lit(size - 1))


def build_dictionary(counted: DataFrame, work: Workspace, least: int) -> Dictionary:
    """Numbers the words of a written table (lang, word, f) that occur ``least`` times."""
    spark = counted.sparkSession
    frequent = counted.filter(F.col("f") >= least)
    order = frequent.select(F.struct((-F.col("f")).alias("minus"), "lang", "word").alias("key"), F.lit(1).alias("one"))
    numbered = running_total(order, "key", "one", "before")
    words = numbered.select("key.lang", "key.word", (-F.col("key.minus")).alias("f"), (F.col("before") + 1).alias("id"))
    words = work.save(words, "dictionary")
    common = (F.col("id") <= SHARED_WORDS) & (F.octet_length("word") <= SHARED_BYTES) & (F.octet_length("lang") <= SHARED_BYTES)
    shared: dict[str, dict[bytes, int]] = {}
    for row in words.filter(common).select("lang", F.col("word").cast("binary").alias("word"), "id").toArrow().to_pylist():
        shared.setdefault(row["lang"], {})[row["word"]] = row["id"]
    rest = words.filter(~common)
    n_rest, bits = rest.count(), None
    if n_rest:
        size = bits_for(n_rest)
        bits = spark.sparkContext.broadcast((size, bitmap(rest.select(_word_slot(size).alias("slot")), size)))
    return Dictionary(words, words.count(), spark.sparkContext.broadcast(shared), rest if n_rest else None, bits)


_ENCODED = pa.schema(
    [("own", pa.int32()), ("ids", pa.binary())]
    + [("rest", pa.list_(pa.struct([("at", pa.int32()), ("lang", pa.string()), ("word", pa.string())])))]
)


class _Stream:
    """Ids of texts one after the other, cut into rows. A row holds some ids of the next, so that phrases that begin in
    its ``own`` part are whole."""

    def __init__(self, own: int, overlap: int):
        self.own, self.overlap, self.parts, self.held, self.rest = own, overlap, [], 0, []

    def add(self, ids: np.ndarray, rest: list[tuple[int, str, bytes]]) -> Iterator[pa.RecordBatch]:
        self.rest.extend((self.held + at, lang, word) for at, lang, word in rest)
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= 2 * self.own:
            yield from self.rows(self.own + self.overlap)

    def rows(self, least: int) -> Iterator[pa.RecordBatch]:
        ids, at = np.concatenate(self.parts or [np.zeros(0, np.int32)]), 0
        while len(ids) - at >= least and len(ids) > at:
            own = min(self.own, len(ids) - at)
            end = min(len(ids), at + own + self.overlap)
            low, high = bisect_left(self.rest, (at,)), bisect_left(self.rest, (end,))
            rest = [{"at": p - at, "lang": lang, "word": word.decode()} for p, lang, word in self.rest[low:high]]
            columns = ([own], [ids[at:end].astype("<i4").tobytes()], [rest])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENCODED)], schema=_ENCODED)
            at += own
        self.parts, self.held = [ids[at:]], len(ids) - at
        self.rest = [(p - at, lang, word) for p, lang, word in self.rest if p >= at]


def encode(docs: DataFrame, words: Dictionary, work: Workspace, longest: int) -> DataFrame:
    """(own, ids): the corpus as little-endian 32-bit ids in rows of bounded size, 0 for breaks and other words."""
    shared, rest_bits = words.shared, words.rest_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, known = _Stream(ROW_IDS, longest - 1), shared.value
        size, bits = rest_bits.value if rest_bits is not None else (0, None)
        for batch in batches:
            for lang, text in _texts(batch):
                found, names = known.get(lang, {}), words_of(text)
                ids = np.fromiter((found.get(w, 0) for w in names), np.int32, len(names))
                if bits is not None:
                    # Words of the rest, and few others, stand as -1 until they are joined.
                    for at in np.flatnonzero(ids == 0).tolist():
                        if names[at] != BREAK and _rest_has(bits, size, lang, names[at]):
                            ids[at] = -1
                # One 0 stands for a run of them, and one between texts.
                kept = np.flatnonzero((ids != 0) | (np.concatenate(([1], ids[:-1])) != 0))
                rest = [(i, lang, names[at]) for i, at in enumerate(kept.tolist()) if ids[at] == -1] if bits is not None else []
                yield from stream.add(np.append(ids[kept], np.int32(0)), rest)
        yield from stream.rows(1)

    encoded = docs.mapInArrow(run, "own int, ids binary, rest array<struct<at:int,lang:string,word:string>>")
    if words.rest is None:
        return work.save(encoded.select("own", "ids"), "encoded")
    marked = work.save(encoded.withColumn("row", F.monotonically_increasing_id()), "marked")
    places = marked.select("row", F.explode("rest").alias("r")).select("row", "r.at", "r.lang", "r.word")
    joined = salted_join(places, words.rest.select("lang", "word", "id"), ["lang", "word"])
    new = joined.groupBy("row").agg(F.collect_list(F.struct("at", "id")).alias("new"))
    patched = marked.select("own", "ids", "row").join(new, "row", "left").select("own", "ids", "new")

    def patch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, new in zip(batch.column("ids").to_pylist(), batch.column("new")):
                values = np.frombuffer(ids, "<i4").copy()
                values[values == -1] = 0
                for pair in new.as_py() or ():
                    values[pair["at"]] = pair["id"]
                out.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array(out, pa.binary())], ["own", "ids"])

    return work.save(patched.mapInArrow(patch, "own int, ids binary"), "encoded")


def _rest_has(bits: np.ndarray, size: int, lang: str, word: bytes) -> bool:
    slot = zlib.crc32(lang.encode() + b"\x00" + word) & (size - 1)
    return bool(bits[slot >> 3] >> (slot & 7) & 1)


def _places(own: int, ids: bytes, n: int, shorter: tuple[int, np.ndarray] | None) -> list[np.ndarray]:
    """Columns of ids of the phrases of ``n`` words that begin in the row's own part."""
    a = np.frombuffer(ids, "<i4").astype(WORD)
    m = min(own, len(a) - n + 1)
    if m <= 0:
        return []
    whole = np.logical_and.reduce([a[i : i + m] != 0 for i in range(n)])
    if shorter is not None:
        size, bits = shorter
        frequent = has_bits(bits, _slots([a[i : i + m + 1] for i in range(n - 1)], size))
        whole &= frequent[:-1] & frequent[1:]
    at = np.flatnonzero(whole)
    return [a[at + i] for i in range(n)]


def count_level(encoded: DataFrame, layout: Layout, shorter: Broadcast | None, least: int) -> DataFrame:
    """(ids, f) of the phrases of ``layout.n`` words that occur ``least`` times."""
    n = layout.n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        known = None if shorter is None else shorter.value

        def flush() -> Iterator[pa.RecordBatch]:
            cells = [np.concatenate(column) for column in zip(*held)]
            held.clear()
            names, filters, total = [], [], 0
            for bucket, data in CountingFilter.count(layout, cells).buckets():
                names.append(bucket)
                filters.append(data)
                total += len(data)
                if total >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(filters, pa.binary())], ["bucket", "filter"])
                    names, filters, total = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(filters, pa.binary())], ["bucket", "filter"])

        waiting = 0
        for batch in batches:
            for own, ids in zip(batch.column("own").to_pylist(), batch.column("ids")):
                cells = _places(own, ids.as_py(), n, known)
                if cells and len(cells[0]):
                    held.append(cells)
                    waiting += len(cells[0])
                if waiting >= PLACES:
                    yield from flush()
                    waiting = 0
        if held:
            yield from flush()

    def merge(key: tuple, filters: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        merged = CountingFilter.merge([CountingFilter.read(layout, bucket, f.as_py()) for f in filters.column("filter")])
        ids, counts = merged.at_least(least)
        flat = np.stack(ids, axis=1).astype(np.int32).ravel() if len(counts) else np.zeros(0, np.int32)
        offsets = np.arange(0, n * len(counts) + 1, n, dtype=np.int32)
        return pa.table({"ids": pa.ListArray.from_arrays(offsets, pa.array(flat)), "f": pa.array(counts, pa.int64())})

    filters = encoded.mapInArrow(count, "bucket long, filter binary")
    return filters.groupBy("bucket").applyInArrow(merge, "ids array<int>, f long")


def _phrase_bits(phrases: DataFrame, n: int) -> Broadcast:
    """The bitmap of the phrases of a level."""
    size = bits_for(n)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = batch.column("ids").flatten().to_numpy().astype(WORD).reshape(batch.num_rows, -1)
                found = _slots(list(rows.T), size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["slot"])

    bits = bitmap(phrases.select("ids").mapInArrow(slots, "slot long"), size)
    return phrases.sparkSession.sparkContext.broadcast((size, bits))


def frequent_phrases(encoded: DataFrame, words: Dictionary, n_words: int, work: Workspace, least: int, longest: int) -> DataFrame:
    """(ids, f) of all phrases of 1 to ``longest`` words that occur ``least`` times."""
    found, shorter = words.words.select(F.array(F.col("id").cast("int")).alias("ids"), "f"), None
    bits = max(1, words.size.bit_length())
    for n in range(2, longest + 1):
        if not words.size:
            break
        width = bits * min(n, 64 // bits)
        prefix = min(max(0, math.ceil(math.log2(max(1, n_words) / BUCKET))), width // 2)
        level = work.save(count_level(encoded, Layout(n, bits, prefix), shorter, least), f"phrases-{n}")
        found = found.unionByName(level)
        n_found = level.count()
        if not n_found:
            break
        if n < longest:
            shorter = _phrase_bits(level, n_found)
    return work.save(found, "phrases")


def _uncovered(phrases: DataFrame, cover: int) -> DataFrame:
    """Candidates (ids, a) that no candidate one word longer covers. Since counts fall with each word, this also holds for
    all longer ones: one that covers contains one of the next length that does."""
    longer = phrases.filter(F.size("ids") >= 3)
    inner = F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)")))
    most = longer.select(inner.alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("most"))
    candidates = phrases.filter(F.size("ids") >= 2).withColumnRenamed("f", "a")
    left = candidates.join(most, "ids", "left")
    return left.filter(F.col("most").isNull() | (100 * F.col("most") < cover * F.col("a"))).select("ids", "a")


def score_phrases(phrases: DataFrame, words: Dictionary, n_by_lang: DataFrame, work: Workspace, cover: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that stay."""
    left = work.save(_uncovered(phrases, cover), "candidates")
    parts = left.select("ids", "a", F.posexplode("ids").alias("at", "id"))
    named = join_groups(parts, words.words.select(F.col("id").cast("int").alias("id"), "lang", "word"), ["id"])
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda p: p["word"]), " ")
    texts = named.groupBy("ids", "a").agg(F.min("lang").alias("lang"), phrase.alias("phrase"))
    texts = work.save(join_groups(texts, n_by_lang, ["lang"]), "texts")
    cuts = texts.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    size = table_bytes(phrases)
    for name, part in (("l", "slice(ids, 1, k)"), ("r", "slice(ids, k + 1, size(ids) - k)")):
        counts = phrases.select(F.col("ids").alias("part"), F.col("f").alias(name))
        cuts = join_groups(cuts.withColumn("part", F.expr(part)), counts, ["part"], group_bytes=size).drop("part")
    # Products pass 64 bits; decimals of 38 digits hold them.
    score = F.expr(
        "(1000 * cast(a as decimal(19, 0)) * cast(n as decimal(14, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    )
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    cut = cuts.groupBy("lang", "phrase", "a", "n").agg(best.alias("c"))
    return work.save(cut.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score"), "scored")


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    cover: int = COVER,
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): phrases of 2 to ``longest`` words with at least ``least`` occurrences.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words of the language; the score is
    floor(1000 a n / (l r)), ties go to the earlier cut. A phrase within a longer one that has ``cover`` percent of its count is
    dropped. NULL and empty texts have no words, a NULL language is ``und``; repeated rows count each time. Texts of any
    length count whole, also across the rows they are cut into. An empty table gives no rows. Only the two named columns
    are read, whatever the others' names.
    """
    spark = docs.sparkSession
    ship_package(spark)
    work = Workspace(spark, "phrases")
    lang = F.lit(NO_LANG) if lang_col is None else F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    counted = work.save(count_words(texts), "words")
    n_by_lang = work.save(counted.groupBy("lang").agg(F.sum("f").alias("n")), "languages")
    n_words = n_by_lang.agg(F.sum("n")).first()[0] or 0
    words = build_dictionary(counted, work, least)
    encoded = encode(texts, words, work, longest)
    phrases = frequent_phrases(encoded, words, n_words, work, least, longest)
    return score_phrases(phrases, words, n_by_lang, work, cover)


def top_phrases(scored: DataFrame, top: int = TOP, parts: int = 64) -> DataFrame:
    """``scored`` with ``rank``, the first ``top`` of each language. Hashed parts of a language are ranked before the whole, so
    a task sees at most ``parts`` times ``top`` rows of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    whole = Window.partitionBy("lang").orderBy(*order)
    return some.filter(F.col("rank") <= top).drop("part").withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= top)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language its 2,000 strongest phrases, with counts of the phrase and of the parts of its weakest cut."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return top_phrases(mine_phrases(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH pieces AS (
    SELECT coalesce(lang, '{NO_LANG}') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::bigint AS n FROM split GROUP BY lang
), grams AS (
    {" UNION ALL ".join(f"SELECT lang, {m} AS m, w[i:i + {m - 1}] AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {m - 2})) AS i FROM split)" for m in range(1, LONGEST + 1))}
), counts AS (SELECT lang, m, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), longer AS (
    SELECT lang, p[1:m - 1] AS p, f FROM counts WHERE m > 2 UNION ALL SELECT lang, p[2:m] AS p, f FROM counts WHERE m > 2
), most AS (SELECT lang, p, max(f) AS f FROM longer GROUP BY ALL
), candidates AS (
    SELECT c.* FROM counts c LEFT JOIN most USING (lang, p) WHERE c.m > 1 AND (most.f IS NULL OR 100 * most.f < {COVER} * c.f)
), cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates
), scored AS (
    SELECT x.lang, x.p, x.k, x.f AS a, lf.f AS l, rf.f AS r, n, (1000::hugeint * x.f * n) // (lf.f::hugeint * rf.f) AS score
    FROM cuts x JOIN totals USING (lang)
    JOIN counts lf ON lf.lang = x.lang AND lf.p = x.p[1:k] JOIN counts rf ON rf.lang = x.lang AND rf.p = x.p[k + 1:x.m]
), best AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, n, min(struct_pack(s := score, k := k, l := l, r := r)) AS c
    FROM scored GROUP BY lang, p, a, n
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY c.s DESC, a DESC, phrase) AS rank, phrase, a, c.l AS l, c.r AS r, n,
           c.s::bigint AS score
    FROM best
) WHERE rank <= {TOP}
"""
