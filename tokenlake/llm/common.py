"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType
from pyspark.sql.pandas.types import to_arrow_type

from tokenlake.shipping import ship_package

# Texts that a Python worker turns into Python objects at a time, in bytes.
CHUNK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """16 bytes that identify a row by its content, NULLs included.

    Rows with equal content share a key, and every operator gives such rows equal
    results, so results can be joined back by key without losing or adding rows.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x00", *parts)))


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of bounded size; a single longer text is a slice of its own."""
    if len(texts) == 0:
        return
    if pa.types.is_nested(texts.type):
        # Nested values have no cheap size each, so slices have the mean size.
        step = max(1, len(texts) * CHUNK_BYTES // max(texts.nbytes, 1))
        yield from (texts.slice(at, step) for at in range(0, len(texts), step))
        return
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > CHUNK_BYTES:
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += size
    yield texts.slice(start)


def per_text(
    spark: SparkSession, schema: StructType | DataType, make: Callable[[], Callable], as_bytes: bool = False
) -> Callable[[Column], Column]:
    """An Arrow UDF from a text column to one value of ``schema`` per text.

    ``make`` runs once per task and returns the function that is applied to each
    text (``str`` or UTF-8 ``bytes``; None for NULL).
    """
    ship_package(spark)
    out_type = to_arrow_type(schema)

    @F.arrow_udf(schema)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for batch in batches:
            # Python objects of one slice at a time.
            parts = [pa.array(list(map(function, (part.cast(pa.binary()) if as_bytes else part).to_pylist())), out_type) for part in chunks(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], out_type)

    return apply


def cut_spans(df: DataFrame, text_col: str, spans_col: str, out: str, mark: str = "") -> DataFrame:
    """``df`` with ``out``: the text with ``mark`` for each of its (start, end) spans.

    Spans are in code points, sorted and without overlaps. A NULL text stays NULL; without spans a text stays as it is.
    """
    ship_package(df.sparkSession)

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            out_texts = []
            for text, found in zip(texts, spans):
                if not text.is_valid or not found.is_valid or not len(found):
                    out_texts.append(text.as_py())
                    continue
                whole, pieces, at = text.as_py(), [], 0
                for span in found.as_py():
                    pieces.append(whole[at : span["start"]])
                    at = span["end"]
                pieces.append(whole[at:])
                out_texts.append(mark.join(pieces))
            yield pa.array(out_texts, pa.string())

    # Only texts with a span travel to Python.
    touched = F.size(spans_col) > 0
    new = cut(F.when(touched, F.col(text_col)), F.when(touched, F.col(spans_col)))
    return df.withColumn(out, F.when(touched, new).otherwise(F.col(text_col)))


def spans_text(spans_col: str) -> Column:
    """start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores behind them as it takes to be no column of ``df``."""
    taken, mark = {c.lower() for c in df.columns}, ""
    while any((name + mark).lower() in taken for name in names):
        mark += "_"
    return [name + mark for name in names]


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add under these names."""
    return df.drop(*[n for n in df.columns if n.lower() in {x.lower() for x in names}])
