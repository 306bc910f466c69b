"""Substring dedup by hashing lines, sentences or paragraphs.

A text is cut into units: lines, cut further behind sentence ends, or paragraphs. A unit is normalised (lower case, runs of
blanks as one) and hashed with 128 bits. Digests are grouped over the whole corpus; the earliest occurrence by (rank,
position) stays. Later occurrences go if they stand in a run of such units with enough words, so that common short lines and
phrases stay where they are while passages go, also passages that begin and end inside a line. Offsets are those of the
original text.

Half of each digest is counted first, in rows of two numbers. The repeated halves become a bitmap of bounded size; only units
that it may hold and that stand in a run of such units long enough to go leave their task. For their digests, found by a
second bitmap, the first places are then looked for among all units. Texts are not shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenlake.llm.common import cut_spans, per_text, row_key, spans_text, table, without
from tokenlake.llm.phrase_mining import bitmap, bits_for, has_bits
from tokenlake.operators.skew import join_groups, salted_join
from tokenlake.workspace import Workspace

# What a unit of each kind is, and blanks between words.
UNITS_OF = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", "paragraph": r"(?s:.+?)(?:\n\n|\Z)"}
BLANKS = " \t\n\x0b\x0c\r"
# A run of repeated sentences is a passage from so many words on, or from so many code points where words have no blanks.
PASSAGE_WORDS, PASSAGE_CHARS = 30, 400
# Rows of one digest that a single task joins.
ROWS_PER_SALT = 200_000

CUT = T.StructType(
    [
        T.StructField("high", T.ArrayType(T.LongType())),
        T.StructField("low", T.ArrayType(T.LongType())),
        T.StructField("words", T.ArrayType(T.IntegerType())),
        T.StructField("start", T.ArrayType(T.IntegerType())),
        T.StructField("end", T.ArrayType(T.IntegerType())),
    ]
)
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ONE_BLANK = str.maketrans(dict.fromkeys(BLANKS, " "))


def _splitter(unit: str) -> Callable[[str | None], dict]:
    pattern = re.compile(UNITS_OF[unit])

    def split(text: str | None) -> dict:
        digests, words, starts, ends = [], [], [], []
        for match in pattern.finditer(text or ""):
            piece = match[0]
            held = [w for w in piece.translate(_ONE_BLANK).split(" ") if w]
            if not held:
                continue
            digests.append(hashlib.md5(" ".join(held).lower().encode("utf-8", "surrogatepass")).digest())
            words.append(len(held))
            bare = piece.strip(BLANKS)
            at = match.start() + piece.index(bare)
            starts.append(at)
            ends.append(at + len(bare))
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        return {"high": halves[:, 0], "low": halves[:, 1], "words": words, "start": starts, "end": ends}

    return split


def count_units(text: Column, unit: str) -> Column:
    """Units of a text that are not blank, counted where the text lies."""
    whole = F.coalesce(text, F.lit(""))
    pieces = F.split(whole, "\n\n", -1) if unit == "paragraph" else F.regexp_extract_all(whole, F.lit(UNITS_OF[unit]), F.lit(0))
    return F.size(F.filter(pieces, lambda p: p.rlike(r"[^\x20\x09-\x0D]"))).cast("long")


def runs_of(later: list[int], words: list[int], starts: list[int], ends: list[int], least_words: int, least_chars: int) -> tuple[list[dict], int]:
    """(spans, units in them) of the runs of consecutive units among ``later`` that are long enough."""
    spans, units, at = [], 0, 0
    while at < len(later):
        end = at + 1
        while end < len(later) and later[end] == later[end - 1] + 1:
            end += 1
        first, last = later[at], later[end - 1]
        span = {"start": starts[first], "end": ends[last]}
        if sum(words[first : last + 1]) >= least_words or span["end"] - span["start"] >= least_chars:
            spans.append(span)
            units += end - at
        at = end
    return spans, units


def _slot(size: int):
    return F.col("high").bitwiseAND(F.lit(size - 1))


def _long_runs(hits: np.ndarray, row: np.ndarray, units: pa.StructArray, least_words: int, least_chars: int) -> np.ndarray:
    """Those of the hit places, ascending over all texts of a batch, that stand in runs long enough to go."""
    if not len(hits):
        return hits
    new = np.append(True, (np.diff(hits) != 1) | (np.diff(row[hits]) != 0))
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    last = np.append(first[1:], len(hits)) - 1
    words, start, end = (units.field(name).flatten().to_numpy() for name in ("words", "start", "end"))
    counted = np.add.reduceat(words[hits].astype(np.int64), first)
    chars = end[hits[last]].astype(np.int64) - start[hits[first]]
    return hits[((counted >= least_words) | (chars >= least_chars))[run]]


def _units(cut: DataFrame, digests: DataFrame, least_words: int = 0, least_chars: int = 0) -> DataFrame:
    """(key, rank, at, high, low): units that may be among ``digests`` (high), in runs of such units that are long enough."""
    size = bits_for(digests.count())
    held = cut.sparkSession.sparkContext.broadcast(bitmap(digests.select(_slot(size).alias("slot")), size))
    rank = cut.schema["rank"].dataType
    schema = T.StructType().add("key", T.BinaryType()).add("rank", rank).add("at", T.IntegerType()).add("high", T.LongType()).add("low", T.LongType())
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("u")
            lengths = np.diff(units.field("high").offsets.to_numpy())
            row, flat = np.repeat(np.arange(len(lengths)), lengths), units.field("high").flatten().to_numpy()
            hits = np.flatnonzero(has_bits(held.value, (flat & (size - 1)).view(np.uint64)))
            kept = _long_runs(hits, row, units, least_words, least_chars)
            index, place = pa.array(row[kept]), kept - (np.cumsum(lengths) - lengths)[row[kept]]
            columns = [batch.column("key").take(index), batch.column("rank").take(index), pa.array(place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flat[kept]), units.field("low").flatten().take(pa.array(kept))], schema=arrow)

    return cut.select("key", "rank", "u").mapInArrow(possible, schema)


def _repeated_units(work: Workspace, cut: DataFrame, least_words: int, least_chars: int) -> DataFrame:
    """(key, at): the units of the written table ``cut`` that are not the first of their digest and may be in a run that goes."""
    halves = cut.select(F.explode("u.high").alias("high"))
    # Counts combine on the map side, also those of a digest that a third of all units has.
    shared = halves.groupBy("high").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("high")
    shared = work.save(shared, "shared")
    units = work.save(_units(cut, shared, least_words, least_chars), "units")
    wanted = work.save(units.select("high", "low").distinct(), "wanted")
    # The first of a digest may be anywhere; tasks pass on their own first ones.
    place = F.struct("rank", "key", "at")
    first = _units(cut, wanted.select("high")).groupBy("high", "low").agg(F.min(place).alias("first"))
    first = work.save(first.join(wanted, ["high", "low"], "left_semi"), "first")
    return salted_join(units, first, ["high", "low"], rows_per_salt=ROWS_PER_SALT).filter(F.col("first") != place).select("key", "at")


def dedup_units(
    docs: DataFrame,
    rank: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    min_words: int = 1,
    min_chars: int | None = None,
) -> DataFrame:
    """``docs`` with n_units, n_removed, removed_spans and kept_text.

    Units (``line``, ``sentence``: lines cut behind ``.!?``, or ``paragraph``) are those that are not blank. A unit whose
    normalised form occurs earlier, in a row of lower ``rank`` or before it in the same text, is removed if it stands in a
    run of such units with at least ``min_words`` words, or with ``min_chars`` code points if given. ``removed_spans`` are
    the runs, (start, end) in code points of the original text, in order, ends exclusive; blanks around them stay.

    NULL and empty texts have no units; a NULL ``kept_text`` for a NULL. A NULL rank comes before all others; rows of equal
    rank are ordered by content, and repeated rows all keep what one of them keeps. An empty table gives no rows. Texts of
    any length are read whole. Added columns replace columns of the same name; other columns stay as they are.
    """
    added = ("n_units", "n_removed", "removed_spans", "kept_text")
    work = Workspace(docs.sparkSession, "line-dedup")
    split = per_text(docs.sparkSession, CUT, lambda: _splitter(unit))
    key = row_key(rank, text_col)
    cut = work.save(docs.select(key.alias("key"), F.col(rank).alias("rank"), split(F.col(text_col)).alias("u")), "cut")
    chars = 1 << 62 if min_chars is None else min_chars
    later = _repeated_units(work, cut, min_words, chars).groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("later"))
    # Repeated rows have one cut.
    found = join_groups(cut.select("key", "u"), later, ["key"]).dropDuplicates(["key"])

    @F.arrow_udf(T.StructType().add("spans", SPANS).add("n", T.LongType()))
    def runs(later: pa.Array, units: pa.Array) -> pa.Array:
        out = []
        for at, u in zip(later, units):
            cut_at = [u[name].as_py() for name in ("words", "start", "end")]
            spans, n = runs_of(at.as_py(), *cut_at, min_words, chars)
            out.append({"spans": spans, "n": n})
        return pa.array(out, to_arrow_type(T.StructType().add("spans", SPANS).add("n", T.LongType())))

    gone = found.select("key", runs("later", "u").alias("r")).filter("r.n > 0").select("key", "r")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"), key.alias("key"))
    joined = join_groups(whole, gone, ["key"], "left")
    spans = F.coalesce("r.spans", F.array().cast(SPANS))
    kept = cut_spans(joined.withColumn("removed_spans", spans), "text", "removed_spans", "kept_text")
    names = [c for c in docs.columns if c.lower() not in added]
    return kept.select(
        *[F.col("row")[c].alias(c) for c in names], count_units(F.col("text"), unit).alias("n_units"), F.coalesce("r.n", F.lit(0)).cast("long").alias("n_removed"), "removed_spans", "kept_text"
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: sentences, removed ones and the offsets of their runs, digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_units(docs, unit="sentence", min_words=PASSAGE_WORDS, min_chars=PASSAGE_CHARS).select(
        "doc_id",
        "n_units",
        "n_removed",
        spans_text("removed_spans").alias("removed_spans"),
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


# Sentences with their offsets by running sums; runs of consecutive later occurrences that are long enough go.
ORACLE = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^.!?
]*[.!?
]+|[^.!?
]+') AS p FROM documents
), pieces AS (
    SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece FROM texts
), placed AS (
    SELECT doc_id, i, piece,
           coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
           lower(trim(regexp_replace(piece, '[ 	-
]+', ' ', 'g'))) AS form
    FROM pieces
), units AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS i, len(string_split(form, ' ')) AS words, form,
           (begins + length(piece) - length(ltrim(piece, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))))::bigint AS s,
           (begins + length(rtrim(piece, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))))::bigint AS e
    FROM placed WHERE form <> ''
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY form ORDER BY doc_id, i) > 1 AS later FROM units
), grouped AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM ranked WHERE later
), runs AS (
    SELECT doc_id, min(s) AS s, max(e) AS e, count(*) AS n FROM grouped GROUP BY doc_id, run
    HAVING sum(words) >= {PASSAGE_WORDS} OR max(e) - min(s) >= {PASSAGE_CHARS}
), gone AS (
    SELECT doc_id, list(struct_pack(s := s, e := e) ORDER BY s) AS spans, sum(n)::bigint AS n FROM runs GROUP BY doc_id
), cut AS (
    SELECT t.doc_id, t.t, coalesce(spans, []) AS spans, coalesce(g.n, 0) AS n FROM texts t LEFT JOIN gone g USING (doc_id)
)
SELECT c.doc_id, coalesce(u.n_units, 0) AS n_units, c.n AS n_removed,
       array_to_string(list_transform(spans, lambda x: x.s || ':' || x.e), ',') AS removed_spans,
       sha256(array_to_string(list_transform(range(1, len(spans) + 2), lambda k: substr(t,
           (CASE WHEN k = 1 THEN 1 ELSE spans[k - 1].e + 1 END)::bigint,
           (CASE WHEN k > len(spans) THEN length(t) ELSE spans[k].s END - CASE WHEN k = 1 THEN 0 ELSE spans[k - 1].e END)::bigint)), '')) AS kept_sha256
FROM cut c LEFT JOIN (SELECT doc_id, count(*) AS n_units FROM units GROUP BY doc_id) u USING (doc_id)
"""
