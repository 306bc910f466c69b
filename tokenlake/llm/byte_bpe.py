"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

For every byte prefix of a word there is exactly one token that ends its BPE encoding. The
encoder keeps that token for each prefix: to extend by a byte it looks through the
tokens that end there, and takes the one that is compatible with the last token of
the prefix before it. The encoding is read off backwards. Since earlier prefixes never
change, appending costs only the new bytes, and an edit costs the bytes after it.

Words are the matches of the published split pattern, each encoded separately; a worker remembers
the words that it has seen. A word that is itself a token is that token.

The operators work row by row, without a shuffle; the vocabulary (its size is
checked) travels with the tasks.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenlake.llm.common import per_text, table, without

# A vocabulary beyond this is refused, as it would have to travel with every task.
MAX_VOCAB = 2_000_000
# Words that one Python worker remembers.
REMEMBERED_WORDS = 600_000
# Longer words are encoded each time, so that what is remembered stays small.
REMEMBERED_CHARS = 64
# Token pairs of which one Python worker remembers whether they are compatible.
REMEMBERED_PAIRS = 1_000_000


@dataclass(frozen=True)
class Ranks:
    """Token bytes to rank, which is also the id, and the pattern that splits a text."""

    tokens: dict[bytes, int]
    pattern: str


def load_ranks(path: str, pattern: str) -> Ranks:
    """A rank file: one token in base 64 and its rank per line. All 256 bytes must be tokens."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if len(tokens) > MAX_VOCAB:
        raise ValueError(f"{len(tokens)} tokens; at most {MAX_VOCAB} can travel with the tasks")
    if any(bytes([i]) not in tokens for i in range(256)):
        raise ValueError("every single byte must be a token")
    return Ranks(tokens, pattern)


def merge_parts(word: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Merge the adjacent parts with the lowest rank, leftmost first, while one ranks under ``below``."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PrefixEncoder:
    """Encodes single words; ``last_tokens`` is the table of the dynamic programme."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        # The two parts whose merge yields a token; a single byte has none. Tokens that merging
        # never produces from their own bytes stay out of the programme.
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.reachable: dict[bytes, int] = {}
        for token, rank in ranks.items():
            parts = merge_parts(token, ranks, rank)
            if len(parts) == 2:
                halves = (ranks[parts[0]], ranks[parts[1]])
                self.halves[rank] = halves
                self.pairs[halves] = rank
            elif len(parts) == 1 and len(token) == 1:
                self.halves[rank] = None
            else:
                continue
            self.reachable[token] = rank
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.known: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE of the bytes of ``left`` and ``right`` gives just these two tokens.

        Undoes merges next to the boundary, latest first. A pair across the boundary that
        would have been merged before the merge undone last means that the
        tokens could not both have been built.
        """
        key = left << 32 | right
        if (answer := self.known.get(key)) is None:
            if len(self.known) >= REMEMBERED_PAIRS:
                self.known.clear()
            answer = self.known[key] = self._compatible(left, right)
        return answer

    def _compatible(self, left: int, right: int) -> bool:
        pairs, halves, bound = self.pairs, self.halves, float("inf")
        while True:
            merged = pairs.get((left, right))
            if merged is not None and merged < bound:
                return False
            of_left, of_right = halves[left], halves[right]
            # Equal ranks merge from the left, so of two equal tokens the right one is the later.
            if of_left is not None and (of_right is None or left > right):
                bound, left = left, of_left[1]
            elif of_right is not None:
                # The right token was built after pairs of the same rank to its left.
                bound, right = right + 1, of_right[0]
            else:
                return True

    def last_tokens(self, word: bytes, table: list[int] | None = None) -> list[int]:
        """The last token of each prefix of ``word``, by prefix length from 1.

        ``table`` may hold the entries of a prefix that is known already; only the rest is computed.
        """
        table = table or []
        reachable, longest, known = self.reachable, self.longest, self.known
        for end in range(len(table) + 1, len(word) + 1):
            for start in range(max(0, end - longest), end):
                token = reachable.get(word[start:end])
                if token is None:
                    continue
                if start == 0:
                    break
                left = table[start - 1]
                fits = known.get(left << 32 | token)
                if fits is None:
                    fits = self.compatible(left, token)
                if fits:
                    break
            table.append(token)
        return table

    def read_back(self, table: Sequence[int]) -> list[int]:
        ids, end = [], len(table)
        while end:
            ids.append(table[end - 1])
            end -= self.length[ids[-1]]
        return ids[::-1]

    def encode(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        return [whole] if whole is not None else self.read_back(self.last_tokens(word))

    def reencode(self, old: bytes, table: Sequence[int], new: bytes) -> tuple[list[int], list[int]]:
        """(ids, table) of ``new``, given the table of ``old``: only bytes after the common
        prefix are computed."""
        same = 0
        for a, b in zip(old, new):
            if a != b:
                break
            same += 1
        fresh = self.last_tokens(new, list(table[:same]))
        whole = self.ranks.get(new)
        return ([whole] if whole is not None else self.read_back(fresh)), fresh


def pack(ids: Sequence[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Words(dict):
    """Packed ids by word; a word that is missing is encoded when it is asked for."""

    def __init__(self, encoder: PrefixEncoder):
        self.encoder = encoder
        self.long: list[str] = []

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        if len(word) > REMEMBERED_CHARS:
            self.long.append(word)
        packed = self[word] = pack(self.encoder.encode(word.encode("utf-8", "surrogatepass")))
        return packed

    def forget_long(self) -> None:
        """Drop words of any length, which are kept for the text at hand only."""
        for word in self.long:
            self.pop(word, None)
        self.long.clear()


# What a worker keeps between tasks: by vocabulary, the words it has met.
_WORKER: dict[str, _Words] = {}


def _share(spark: SparkSession, ranks: Ranks):
    """The prepared encoder, sent once to every executor; its size is that of the vocabulary."""
    name = hashlib.sha256(repr((ranks.pattern, sorted(ranks.tokens.items()))).encode()).hexdigest()
    return spark.sparkContext.broadcast((name, PrefixEncoder(ranks.tokens), ranks.pattern))


def _text_encoder(shared) -> Callable[[str | None], bytes]:
    import regex

    name, encoder, pattern = shared.value
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = _Words(encoder)
    known = _WORKER[name]
    split = regex.compile(pattern).findall

    def encode_text(text: str | None) -> bytes:
        if not text:
            return b""
        packed = b"".join(map(known.__getitem__, split(text)))
        if known.long:
            known.forget_long()
        return packed

    return encode_text


def _ids_decoder(shared) -> Callable[[bytes | None], bytes]:
    ranks = shared.value[1].ranks
    # A list by rank; ranks that no token has give None, which fails.
    names: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        names[rank] = token

    def decode_ids(packed: bytes | None) -> bytes:
        return b"".join(map(names.__getitem__, memoryview(packed or b"").cast("I")))

    return decode_ids


def encode(docs: DataFrame, ranks: Ranks, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as packed 32-bit integers (BINARY).

    NULL and empty texts have no ids (zero bytes). Special markers are ordinary text.
    Every input row gives one row, repeated rows too; a column named ``out`` is replaced.
    """
    shared = _share(docs.sparkSession, ranks)
    udf = per_text(docs.sparkSession, T.BinaryType(), lambda: _text_encoder(shared))
    return without(docs, [out] if out != text_col else []).withColumn(out, udf(F.col(text_col)))


def decode(encoded: DataFrame, ranks: Ranks, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that the packed ids spell (BINARY).

    NULL ids give zero bytes; an id outside the vocabulary fails the job.
    """
    shared = _share(encoded.sparkSession, ranks)
    udf = per_text(encoded.sparkSession, T.BinaryType(), lambda: _ids_decoder(shared), as_bytes=True)
    return without(encoded, [out] if out != ids_col else []).withColumn(out, udf(F.col(ids_col)))


def encode_and_decode(docs: DataFrame, ranks: Ranks, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` as by :func:`encode` and :func:`decode`, in one pass,
    and with ``n_tokens`` and the digests ``ids_sha256`` and ``decoded_sha256``.

    Columns of these names are replaced.
    """
    shared = _share(docs.sparkSession, ranks)
    both = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def make():
        to_ids, to_bytes = _text_encoder(shared), _ids_decoder(shared)

        def one(text: str | None) -> dict[str, bytes]:
            ids = to_ids(text)
            return {"ids": ids, "decoded": to_bytes(ids)}

        return one

    udf = per_text(docs.sparkSession, both, make)
    names = ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    coded = without(docs.withColumn("_coded", udf(F.col(text_col))), names)
    return coded.select(
        *[c for c in coded.columns if c != "_coded"],
        F.col("_coded.ids").alias("ids"),
        F.col("_coded.decoded").alias("decoded"),
        (F.octet_length("_coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("_coded.ids", 256).alias("ids_sha256"),
        F.sha2("_coded.decoded", 256).alias("decoded_sha256"),
    )


def multilingual_ranks(path: str | None = None) -> Ranks:
    """The public multilingual rank file, or the one at ``path``."""
    import public_tokenizers

    return load_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, digest of its ids, digest of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_and_decode(docs, multilingual_ranks()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
