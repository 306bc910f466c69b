"""Toxicity by a weighted lexicon that is learned from labels and matched by Aho-Corasick.

Texts are folded first: compatibility forms, lower case, homoglyphs and digits that stand for letters; what is no letter
separates words. The lexicon holds words and word beginnings that are much more frequent in toxic than in other training
texts; its weights are log ratios of their rates. A score is the sum of weights of the hits, without hits inside an
exception phrase, divided by the square root of the number of words, and set against a threshold that is
fitted on the training texts. Labels serve training only.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import per_text, table, without
from tokenlake.shipping import ship_package

# Labelled rows that the lexicon is learned from, at most in expectation: a sample by hash of the id.
TRAIN_ROWS = 20_000
# Letters of the word beginnings that can be entries.
STEMS = range(4, 8)
# Entries occur in this share of the toxic training texts at least (and in 3), which bounds their number.
MIN_SHARE = 0.01
MIN_TEXTS = 3
MIN_WEIGHT = 1.5
# Feature counts that a task holds before it passes them on.
HELD = 300_000
BINS = 200

# Look-alike letters and digits or signs that stand for letters.
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһοαεικνρτυ" + "0134579@$", "aeopcyxijsdhoaeiknptu" + "oieastgas"))
FOLD = str.maketrans(LOOK_ALIKES)
# Phrases in which an entry means no offence.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum")


def folded(text: str | None) -> list[str]:
    """Words of the folded text."""
    if not text:
        return []
    plain = text if text.isascii() else unicodedata.normalize("NFKC", text)
    plain = plain.lower().translate(FOLD)
    return "".join(c if c.isalpha() else " " for c in plain).split()


def features(words: list[str]) -> set[str]:
    """Entries that a text could hold: " word " for whole words, " stem" for beginnings."""
    distinct = set(words)
    return {f" {w} " for w in distinct} | {" " + w[:n] for w in distinct for n in STEMS if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Weight by entry, exception phrases, and the raw score at which a text counts as toxic."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    threshold: float = 1.0


def _matcher(lexicon: Lexicon):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for entry, weight in lexicon.weights.items():
        automaton.add_word(entry, (len(entry), weight))
    for phrase in lexicon.exceptions:
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
    automaton.make_automaton()

    def raw(text: str | None) -> float:
        words = folded(text)
        if not words:
            return 0.0
        best, safe = {}, []
        for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
            start = end - length + 1
            if weight is None:
                safe.append((start, end))
            else:
                # A word counts once, by its strongest entry.
                best[start] = max(weight, best.get(start, 0.0))
        total = sum(w for at, w in best.items() if not any(a <= at < b for a, b in safe))
        return total / math.sqrt(len(words))

    return raw if lexicon.weights else lambda text: 0.0


def _feature_counts(training: DataFrame) -> DataFrame:
    """(feature, toxic, texts) with counts combined in each task; ``feature`` "" counts the texts."""
    ship_package(training.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            keys = list(held)
            return pa.record_batch(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(held.values(), pa.int64())],
                names=["feature", "toxic", "texts"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                label = toxic.as_py()
                held.update((f, label) for f in features(folded(text.as_py())))
                held["", label] += 1
                if len(held) > HELD:
                    yield out()
                    held = Counter()
        if held:
            yield out()

    counted = training.select("text", F.col("toxic").cast("int")).mapInArrow(count, "feature string, toxic int, texts long")
    return counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("texts")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("texts")).otherwise(0)).alias("good"),
    )


def learn_lexicon(training: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """The lexicon for rows of (text, toxic 0/1).

    NULL and empty texts count as texts without words. Without toxic texts the lexicon is empty, and every score 0.
    """
    totals = training.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))).first()
    n_bad, n_good = totals
    if not n_bad:
        return Lexicon({}, exceptions)
    weight = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    often = F.col("bad") >= max(MIN_TEXTS, math.ceil(MIN_SHARE * n_bad))
    chosen = _feature_counts(training).filter((F.col("feature") != "") & often).withColumn("weight", weight)
    found = chosen.filter(F.col("weight") >= MIN_WEIGHT).select("feature", "weight").collect()
    lexicon = Lexicon({r["feature"]: r["weight"] for r in sorted(found)}, exceptions)
    return Lexicon(lexicon.weights, exceptions, _threshold(training, lexicon))


def _threshold(training: DataFrame, lexicon: Lexicon) -> float:
    """The raw score that separates the training texts with the best F1."""
    raw = per_text(training.sparkSession, T.DoubleType(), lambda: _matcher(lexicon))
    binned = training.select(F.least(F.floor(raw("text") * 20), F.lit(BINS)).alias("bin"), "toxic")
    counts = {(r["bin"], r["toxic"]): r["count"] for r in binned.groupBy("bin", "toxic").count().collect()}
    positives = sum(n for (_, toxic), n in counts.items() if toxic == 1)
    best, at = -1.0, 1
    for cut in range(1, BINS + 1):
        hit = sum(n for (b, toxic), n in counts.items() if toxic == 1 and b >= cut)
        wrong = sum(n for (b, toxic), n in counts.items() if toxic == 0 and b >= cut)
        f1 = 2 * hit / (hit + wrong + positives)
        if f1 > best:
            best, at = f1, cut
    return at / 20


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, at least 0.5 for toxic texts.

    NULL, empty and wordless texts have score 0. Every input row gives one row; a column named ``out`` is replaced.
    """

    def make():
        raw, middle = _matcher(lexicon), lexicon.threshold

        def score(text: str | None) -> float:
            value = raw(text)
            return value / (value + middle)

        return score

    udf = per_text(docs.sparkSession, T.DoubleType(), make)
    return without(docs, [out] if out != text_col else []).withColumn(out, udf(F.col(text_col)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its score and verdict; rows of every fifth checksum of the id are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & ~held_out)
    labelled = labels.agg(F.countDistinct("doc_id")).first()[0]
    share = min(1_000_000, math.ceil(TRAIN_ROWS * 1_000_000 / max(labelled, 1)))
    chosen = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    # Few ids by TRAIN_ROWS, however often their labels are repeated, so texts stay where they lie.
    few = chosen.groupBy("doc_id", "toxic").agg(F.count(F.lit(1)).alias("n"))
    training = docs.join(F.broadcast(few), "doc_id").select("text", "toxic", F.explode(F.sequence(F.lit(1), F.col("n"))))
    lexicon = learn_lexicon(training.select("text", "toxic"))
    scored = score_toxicity(docs.withColumn("held_out", held_out), lexicon)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
