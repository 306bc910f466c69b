"""Text expressions: pre-tokenization and special-marker handling."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenlake.functions import chars

# The end-of-text marker and the published GPT-2 pre-tokenization
# pattern. (?U) gives \s its Unicode meaning, which the pattern relies on.
END_OF_TEXT = "<|endoftext|>"
PRETOKEN_PATTERN = (
    r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def pretokens(text: Column) -> Column:
    """All pre-tokens in order; together they spell the text again."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def without_specials(text: Column, specials: Sequence[str]) -> Column:
    """Delete every special, one after the other in list order."""
    for special in specials:
        text = F.replace(text, F.lit(special), F.lit(""))
    return text


def special_pattern(specials: Sequence[str]) -> str:
    """Alternation of the quoted specials; where two could match, the longer does."""
    return "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))


def special_parts(text: Column, specials: Sequence[str]) -> Column:
    """ARRAY<STRUCT<is_special, text>>: the text cut at its specials, without
    empty text parts."""
    if not specials:
        plain = F.array(F.struct(F.lit(False).alias("is_special"), text.alias("text")))
        return F.filter(plain, lambda p: p["text"] != "")
    pattern = special_pattern(specials)
    between = F.transform(
        F.split(text, pattern, -1),
        lambda t: F.struct(F.lit(False).alias("is_special"), t.alias("text")),
    )
    found = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda t: F.struct(F.lit(True).alias("is_special"), t.alias("text")),
    )
    zipped = F.flatten(F.zip_with(between, found, lambda b, f: F.array(b, f)))
    return F.filter(zipped, lambda p: p["is_special"] | (p["text"] != ""))


def utf8_bytes(text: Column) -> Column:
    """Byte values 0..255 of the UTF-8 form as ARRAY<INT>."""
    return chars.ids(chars.byte_symbols(text))
