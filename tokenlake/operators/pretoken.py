"""Text to pre-tokens, bytes and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenlake.functions import chars, text


def strip_specials(df: DataFrame, specials: Sequence[str], text_col: str = "text") -> DataFrame:
    return df.withColumn(text_col, text.without_specials(F.col(text_col), specials))


def split_specials(
    df: DataFrame, specials: Sequence[str], text_col: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """(keep, part, is_special, text): text parts and specials in order."""
    parts = text.special_parts(F.col(text_col), specials)
    return df.select(*keep, F.posexplode(parts).alias("part", "p")).select(
        *keep, "part", F.col("p.is_special").alias("is_special"), F.col("p.text").alias("text")
    )


def pretokenize(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep, pos, pretoken)"""
    return df.select(*keep, F.posexplode(text.pretokens(F.col(text_col))).alias("pos", "pretoken"))


def utf8_byte_ids(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    return df.select(*keep, text.utf8_bytes(F.col(text_col)).alias("ids"))


def pretoken_freq(df: DataFrame, text_col: str = "text", specials: Sequence[str] = ()) -> DataFrame:
    """(pretoken, freq). Counts combine on the map side, so common words do not skew."""
    stripped = text.without_specials(F.col(text_col), specials)
    return (
        df.select(F.explode(text.pretokens(stripped)).alias("pretoken"))
        .groupBy("pretoken")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def word_table(freqs: DataFrame) -> DataFrame:
    """(word, freq) with char-coded words, from (pretoken, freq)."""
    return freqs.select(chars.byte_symbols(F.col("pretoken")).alias("word"), F.col("freq").cast("bigint").alias("freq"))
