"""Quality rules: a table of thresholds compiled into one projection.

Measures of a text (length, symbols, stop words, lines, repetition) are built-in expressions;
a rule is a measure, a comparison and a threshold. All rules together are one projection, evaluated
row by row in the JVM without user functions and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.llm.common import table, without

# What separates words, and what counts as a symbol.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = tuple(
    (
        "the of and to in a is that it for was with as on be by at this are from or an have not had but which they "
        "le la les de des du et un une en est que qui dans pour pas sur au avec par ce plus "
        "der die das und ein eine zu den von mit sich des auf für ist im dem nicht auch als "
        "el los las que y en un una por con no se su para es al lo como más del"
    ).split()
)


@dataclass(frozen=True)
class Rule:
    """Kept texts satisfy ``low <= measure <= high``; texts with fewer words than ``from_words`` are not judged."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


# The production thresholds.
RULES = (
    Rule("mean_word_chars", "mean_word_chars", 1.5, 25.0),
    Rule("symbols_per_word", "symbols_per_word", None, 0.3),
    Rule("exclamations_per_word", "exclamations_per_word", None, 0.5),
    Rule("stop_word_share", "stop_word_share", 0.02, None, from_words=50),
    Rule("duplicate_line_share", "duplicate_line_share", None, 0.5),
    Rule("upper_case_word_share", "upper_case_word_share", None, 0.7),
)


def base_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (BIGINT) and ``_words``.

    A window of eight words counts as repeated by its text, never by a hash alone: hashes only say in which texts to
    look.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_words = docs.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    n = F.size("_words")
    # One hash per word, then per two, four and eight words; each step is a column, so it is computed once.
    hashed = with_words.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        shorter = F.slice("_h", F.lit(1), F.greatest(F.size("_h") - step, F.lit(0)))
        hashed = hashed.withColumn("_h", F.transform(shorter, lambda h, i: F.xxhash64(h, F.get(F.col("_h"), i + step))))
    suspect = F.size(F.array_distinct("_h")) < F.size("_h")
    starts = F.sequence(F.lit(0), n - WINDOW)
    windows = F.array_sort(
        F.transform(
            starts, lambda i: F.struct(F.array_join(F.slice("_words", i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i"))
        )
    )
    found = hashed.withColumn("_w", F.when(suspect & (n >= WINDOW), windows))
    twice = F.filter(
        "_w",
        lambda x, k: (x["w"] == F.get(F.col("_w"), k - 1)["w"]) | (x["w"] == F.get(F.col("_w"), k + 1)["w"]),
    )
    found = found.withColumn("_s", F.array_sort(F.transform(twice, lambda x: x["i"])))
    # Starts in order: each window adds the words that the one before it does not cover.
    covered = F.aggregate(
        "_s",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
    )["n"]
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(BLANK.replace("[", "[^", 1)))
    return found.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": (F.length(text) - F.regexp_count(text, F.lit(BLANK))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
            "_lines": lines,
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _measures(text_col: str) -> dict[str, Column]:
    """The measures that rules can name, over the columns of :func:`base_measures`."""
    n = F.col("n_words")

    def words_like(condition) -> Column:
        return F.size(F.filter("_words", condition))

    return {
        "n_words": n,
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbols_per_word": _ratio(F.col("n_symbols"), n),
        "exclamations_per_word": _ratio(F.regexp_count(F.col(text_col), F.lit("!")), n),
        "stop_word_share": _ratio(words_like(lambda w: F.lower(w).isin(*STOP_WORDS)), n),
        "duplicate_line_share": _ratio(F.col("n_dup_lines"), F.size("_lines")),
        "upper_case_word_share": _ratio(words_like(lambda w: (F.upper(w) == w) & (F.lower(w) != w)), n),
        "repeat_word_share": _ratio(F.col("n_repeat_words"), n),
    }


def _failed(rule: Rule, measures: dict[str, Column]) -> Column:
    value, tests = F.coalesce(measures[rule.measure], F.lit(0.0)), []
    if rule.low is not None:
        tests.append(value < rule.low)
    if rule.high is not None:
        tests.append(value > rule.high)
    failed = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return (F.col("n_words") >= rule.from_words) & failed


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules, kept.

    NULL and empty texts have no words, so they fail the base rule. Every input row gives one row, repeated rows
    too; columns with the names of added ones are replaced.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept")
    clean = without(docs, added)
    measured = base_measures(clean, text_col)
    measures = _measures(text_col)
    n = F.col("n_words")
    names = F.array(*[F.when(_failed(rule, measures), F.lit(rule.name)) for rule in rules])
    judged = measured.withColumns(
        {
            "base_failed": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n),
            "failed_rules": F.array_compact(names),
        }
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    # A generator stops filters on the verdict, which would otherwise be pushed below and evaluate every measure many times.
    verdict = F.explode_outer(F.array("kept")).alias("kept")
    return judged.select(*clean.columns, *added[:-1], verdict)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the base measures, the base verdict, the verdict of all rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def rule_sql(rule: Rule) -> str:
    """The same test as SQL over columns named as the measures, for the check against another engine."""
    tests = [f"{rule.measure} < {rule.low}"] if rule.low is not None else []
    tests += [f"{rule.measure} > {rule.high}"] if rule.high is not None else []
    return f"(n_words >= {rule.from_words} AND ({' OR '.join(tests)}))"


# Windows as text by position; the rules in the same words as above.
ORACLE = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM texts)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY doc_id
), counted AS (
    SELECT doc_id, t, w, len(w) AS n_words, length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars,
           length(regexp_replace(t, '{SYMBOL.replace("[", "[^", 1)}', '', 'g')) AS n_symbols,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{BLANK.replace("[", "[^", 1)}')) AS lines,
           coalesce(n, 0) AS n_repeat_words
    FROM texts LEFT JOIN repeated USING (doc_id)
), measured AS (
    SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
           coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word,
           coalesce((length(t) - length(replace(t, '!', ''))) / nullif(n_words, 0), 0) AS exclamations_per_word,
           coalesce(len(list_filter(w, lambda x: lower(x) IN {STOP_WORDS})) / nullif(n_words, 0), 0) AS stop_word_share,
           coalesce((len(lines) - len(list_distinct(lines))) / nullif(len(lines), 0), 0) AS duplicate_line_share,
           coalesce(len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) / nullif(n_words, 0), 0) AS upper_case_word_share
    FROM counted
), judged AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
           concat_ws(',', {", ".join(f"CASE WHEN {rule_sql(r)} THEN '{r.name}' END" for r in RULES)}) AS failed_rules
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""
