"""Char-coded token sequences.

Inside a job, a token sequence is a STRING whose code points are token ids.
Merging a pair is then ``replace``, listing pairs is string slicing, and the
binary order of strings is the numeric order of ids, so the byte-pair loop runs
in JVM expressions without a Python worker. Ids from 0xD800 on are moved up to
step over the surrogate range; U+10FFFF is kept free as a boundary mark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATE_START = 0xD800
SURROGATE_SPAN = 0x800
BOUNDARY = chr(0x10FFFF)
MAX_TOKEN_ID = 0x10FFFE - SURROGATE_SPAN
PAIR_BASE = 1 << 21


def symbol(token_id: int) -> str:
    """The one-character string that stands for ``token_id``."""
    if not 0 <= token_id <= MAX_TOKEN_ID:
        raise ValueError(f"token id {token_id} cannot be char-coded")
    return chr(token_id if token_id < SURROGATE_START else token_id + SURROGATE_SPAN)


def id_of(sym: str) -> int:
    """Inverse of :func:`symbol`."""
    point = ord(sym)
    return point if point < SURROGATE_START else point - SURROGATE_SPAN


def pair_code(a: int, b: int) -> int:
    """A pair of ids as one integer; integer order is the order of (a, b)."""
    return a * PAIR_BASE + b


def split_pair_code(code: int) -> tuple[int, int]:
    return divmod(code, PAIR_BASE)


def byte_symbols(text: Column) -> Column:
    """UTF-8 bytes of a string as symbols U+0000..U+00FF."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def symbols_to_bytes(latin: Column) -> Column:
    """Inverse of :func:`byte_symbols`, as binary."""
    return F.encode(latin, "ISO-8859-1")


def symbols(word: Column) -> Column:
    """Array of the single symbols of a char-coded string (empty for '')."""
    return F.when(F.length(word) > 0, F.split(word, "")).otherwise(F.array().cast("array<string>"))


def symbol_id(sym: Column) -> Column:
    """Token id of a one-symbol string."""
    point = F.ascii(sym)
    return F.when(point >= SURROGATE_START + SURROGATE_SPAN, point - SURROGATE_SPAN).otherwise(point)


def ids(word: Column) -> Column:
    """Token ids of a char-coded string as ARRAY<INT>."""
    return F.transform(symbols(word), symbol_id)


def pair_ids(pair: Column) -> tuple[Column, Column]:
    """Ids of the left and right symbol of a two-symbol string."""
    return symbol_id(F.substring(pair, 1, 1)), symbol_id(F.substring(pair, 2, 1))
