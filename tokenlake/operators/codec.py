"""Encoding documents to token ids and back.

Both directions are row-local: a document is encoded where it lies, so a corpus
of any size is encoded in one pass without a shuffle. The merges and the
vocabulary go along with the tasks; their size is that of the vocabulary, and it
is checked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenlake.functions import chars, text
from tokenlake.operators.tokenizer import Tokenizer
from tokenlake.shipping import ship_package
from tokenlake.workspace import Workspace

# Up to this many merges are replayed on whole documents by JVM expressions.
FOLD_MERGES = 24
# The vocabulary is sent to tasks as one literal up to this many bytes.
LOOKUP_BYTES = 32 << 20
# Bytes of words that one Python worker remembers between rows, with so many for each word itself.
REMEMBERED_BYTES, WORD_BYTES = 64 << 20, 200
# Bytes of text that a Python worker takes apart at a time; a longer text is taken by itself.
SLICE_BYTES = 2 << 20
# Up to this many merges, the new words of a batch are encoded together, merge by merge.
RULES_PER_PASS = 2_000


def _sql_strings(values: Sequence[str]) -> str:
    """SQL for an array of strings: one literal, cut at the boundary mark when
    the plan is made."""

    def literal(value: str) -> str:
        return f"decode(X'{value.encode('utf-8').hex()}', 'UTF-8')"

    return f"split({literal(chars.BOUNDARY.join(values))}, {literal(chars.BOUNDARY)})"


def _special_symbols(tokenizer: Tokenizer) -> Column:
    """MAP from special to its symbol."""
    entries = []
    for special in dict.fromkeys(tokenizer.specials):
        entries += [F.lit(special), F.lit(chars.symbol(tokenizer.special_id(special)))]
    return F.create_map(*entries)


def marked_words(column: Column, tokenizer: Tokenizer) -> Column:
    """Char-coded pre-tokens and specials of a text, joined by the boundary mark."""

    def words_of(piece: Column) -> Column:
        return F.transform(text.pretokens(piece), chars.byte_symbols)

    if not tokenizer.specials:
        words = words_of(column)
    else:
        known = _special_symbols(tokenizer)
        words = F.flatten(
            F.transform(
                text.special_parts(column, tokenizer.specials),
                lambda p: F.when(p["is_special"], F.array(F.element_at(known, p["text"]))).otherwise(words_of(p["text"])),
            )
        )
    return F.array_join(words, chars.BOUNDARY)


def folded(column: Column, tokenizer: Tokenizer) -> Column:
    """Char-coded tokens of a text, by replaying all merges in rank order.

    The boundary mark keeps merges inside words, so one ``replace`` per merge
    serves the whole document. Rank order is enough: a pair with a learned id
    always ranks after every merge that yields this id.
    """
    marked = marked_words(column, tokenizer)
    rules = tokenizer.encode_rules()
    if rules:
        olds = _sql_strings([chars.symbol(a) + chars.symbol(b) for a, b, _ in rules])
        news = _sql_strings([chars.symbol(c) for _, _, c in rules])
        steps = F.arrays_zip(F.expr(olds).alias("o"), F.expr(news).alias("n"))
        marked = F.aggregate(steps, marked, lambda acc, s: F.replace(acc, s["o"], s["n"]))
    return F.replace(marked, F.lit(chars.BOUNDARY), F.lit(""))


def in_learning_order(rules: Sequence[tuple[int, int, int]]) -> bool:
    """Whether no pair repeats and every pair ranks after all rules that emit one of its ids.

    Only then do a replay in list order and merging all occurrences at once equal merging the leftmost pair of lowest rank.
    """
    last = {emitted: rank for rank, (_, _, emitted) in enumerate(rules)}
    later = (rank <= max(last.get(a, -1), last.get(b, -1)) for rank, (a, b, _) in enumerate(rules))
    return len({(a, b) for a, b, _ in rules}) == len(rules) and not any(later)


def _words_encoder(rules: Sequence[tuple[int, int, int]]):
    """A function from char-coded words to their char-coded tokens."""
    ordered = in_learning_order(rules)
    # Occurrences of the best pair that are merged at a time: all, or the leftmost.
    at_once = -1 if ordered else 1
    olds = [chars.symbol(a) + chars.symbol(b) for a, b, _ in rules]
    news = [chars.symbol(c) for _, _, c in rules]
    ranks = {(old[0], old[1]): rank for rank, old in enumerate(olds)}
    none = len(rules)

    def by_rule(words: Sequence[str]) -> list[str]:
        joined = chars.BOUNDARY.join(words)
        for old, new in zip(olds, news):
            joined = joined.replace(old, new)
        return joined.split(chars.BOUNDARY)

    def by_word(words: Sequence[str]) -> list[str]:
        out = []
        for word in words:
            # In learning order, pairs made by the lowest-ranked pair rank later.
            while len(word) > 1:
                best = min(map(ranks.get, zip(word, word[1:]), repeat(none)))
                if best == none:
                    break
                word = word.replace(olds[best], news[best], at_once)
            out.append(word)
        return out

    return by_rule if ordered and len(rules) <= RULES_PER_PASS else by_word


def slices(texts: pa.Array, n_bytes: int) -> Iterator[pa.Array]:
    """An array of strings cut into runs of at most ``n_bytes``, or of one longer string."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(texts):
        before = ends[at] - sizes[at]
        end = max(at + 1, int(np.searchsorted(ends, before + n_bytes, "right")))
        yield texts.slice(at, end - at)
        at = end


def arrow_encoder(df: DataFrame, tokenizer: Tokenizer):
    """Arrow UDF from marked words to ids.

    A batch has a bounded number of rows, not of bytes, so it is taken apart by slices of bounded size, whose ids are handed
    on at once. A slice encodes its distinct new words once; each worker remembers words.
    """
    ship_package(df.sparkSession)
    rules = df.sparkSession.sparkContext.broadcast(tokenizer.encode_rules())

    @F.arrow_udf("array<int>")
    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode_words = _words_encoder(rules.value)
        remembered: dict[str, str] = {}
        held = 0

        def ids_of(coded: str) -> np.ndarray:
            points = np.frombuffer(coded.encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
            points[points >= chars.SURROGATE_START] -= chars.SURROGATE_SPAN
            return points

        for batch in batches:
            if not len(batch):
                yield pa.array([], pa.list_(pa.int32()))
            for part in slices(batch, SLICE_BYTES):
                texts = [None if marked is None else marked.split(chars.BOUNDARY) for marked in part.to_pylist()]
                if held > REMEMBERED_BYTES:
                    remembered.clear()
                    held = 0
                new = list({w for words in texts if words is not None for w in words}.difference(remembered))
                if new:
                    remembered.update(zip(new, encode_words(new)))
                    held += 2 * sum(map(len, new)) + WORD_BYTES * len(new)
                coded = ["" if words is None else "".join(map(remembered.__getitem__, words)) for words in texts]
                offsets = np.cumsum([0, *map(len, coded)], dtype=np.int32)
                lost = pa.array([words is None for words in texts])
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids_of("".join(coded))), mask=lost)

    return encode_batches


def encode(
    df: DataFrame,
    tokenizer: Tokenizer,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    method: str = "auto",
) -> DataFrame:
    """(keep, ids, n_tokens).

    ``fold`` replays the merges with JVM expressions and suits small
    vocabularies; ``arrow`` looks words up in Python workers and suits large ones.
    Merges out of learning order always go the second way.
    """
    if method in ("auto", "fold") and not in_learning_order(tokenizer.encode_rules()):
        method = "arrow"
    if method == "auto":
        method = "fold" if len(tokenizer.merges) <= FOLD_MERGES else "arrow"
    if method == "fold":
        coded = df.select(*keep, folded(F.col(text_col), tokenizer).alias("_tokens"))
        return coded.select(
            *keep, chars.ids(F.col("_tokens")).alias("ids"), F.length("_tokens").alias("n_tokens")
        )
    if method != "arrow":
        raise ValueError(f"unknown method {method!r}")
    marked = marked_words(F.col(text_col), tokenizer)
    coded = df.select(*keep, arrow_encoder(df, tokenizer)(marked).alias("ids"))
    return coded.withColumn("n_tokens", F.size("ids"))


def _readable(latin: Column) -> Column:
    """Bytes to text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(chars.symbols_to_bytes(latin).cast("string"))


def _unknown(token: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unknown token id "), F.coalesce(token.cast("string"), F.lit("NULL")))).cast("string")


def decode(
    encoded: DataFrame,
    tokenizer: Tokenizer,
    ids_col: str = "ids",
    keep: Sequence[str] = ("doc_id",),
    method: str = "auto",
) -> DataFrame:
    """(keep, text), one row per input row; NULL ids give a NULL text. An id outside the vocabulary fails the job.

    ``lookup`` indexes a literal array of the vocabulary inside the row; ``join``
    is for vocabularies too large for that.
    """
    pieces = [t.decode("latin-1") for t in tokenizer.token_bytes]
    if method == "auto":
        method = "lookup" if sum(map(len, pieces)) <= LOOKUP_BYTES else "join"
    if method == "lookup":
        table = F.expr(_sql_strings(pieces))
        piece = lambda i: F.coalesce(F.get(table, i), _unknown(i))
        return encoded.select(*keep, _readable(F.array_join(F.transform(ids_col, piece), "")).alias("text"))
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    vocab = tokenizer.vocab_table(encoded.sparkSession).select(
        "token_id", F.decode("token", "ISO-8859-1").alias("piece")
    )
    # Written first, so that the numbers of rows hold.
    rows = encoded.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_keep"), F.col(ids_col).alias("_ids"))
    rows = Workspace(encoded.sparkSession, "decode").save(rows, "rows")
    tokens = rows.select("_row", F.posexplode("_ids").alias("pos", "token_id"))
    found = tokens.join(vocab, "token_id", "left").withColumn("piece", F.coalesce("piece", _unknown(F.col("token_id"))))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    texts = found.groupBy("_row").agg(F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("_latin"))
    latin = F.when(F.col("_ids").isNotNull(), F.coalesce("_latin", F.lit("")))
    return rows.join(texts, "_row", "left").select(*[F.col("_keep")[k].alias(k) for k in keep], _readable(latin).alias("text"))


def roundtrip_check(
    df: DataFrame, tokenizer: Tokenizer, text_col: str = "text", key: str = "doc_id", method: str = "auto"
) -> DataFrame:
    """(n_docs, n_failed): documents that do not survive encoding and decoding."""
    original = df.withColumn("_original", F.col(text_col))
    coded = encode(original, tokenizer, text_col, (key, "_original"), method)
    back = decode(coded, tokenizer, keep=(key, "_original"))
    failed = F.when(F.col("text") == F.col("_original"), 0).otherwise(1)
    return back.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(failed), F.lit(0)).alias("n_failed"))
