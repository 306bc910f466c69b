"""The tokenizer value: merges and specials, and its table forms.

Its size is the vocabulary size, a parameter of training, so it lives on the
driver and may be sent to every task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_BYTES = 256
MERGES_SCHEMA = "rank int, a int, b int, new_id int, cnt bigint"
VOCAB_SCHEMA = "token_id int, token binary, kind string"


@dataclass(frozen=True)
class Merge:
    a: int
    b: int
    cnt: int | None = None


@dataclass(frozen=True)
class Tokenizer:
    merges: tuple[Merge, ...] = ()
    specials: tuple[str, ...] = ()
    # Set only for a vocabulary that was loaded and does not follow from the merges.
    loaded_vocab: tuple[bytes, ...] | None = field(default=None, repr=False)

    @property
    def first_merge_id(self) -> int:
        return N_BYTES + len(self.specials)

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """Byte string of every id: bytes, then specials, then merges."""
        if self.loaded_vocab is not None:
            return list(self.loaded_vocab)
        table = [bytes([i]) for i in range(N_BYTES)] + [s.encode("utf-8") for s in self.specials]
        for m in self.merges:
            table.append(table[m.a] + table[m.b])
        return table

    @cached_property
    def canonical_id(self) -> dict[bytes, int]:
        """Where several ids spell the same bytes, encoding emits the last one."""
        return {token: token_id for token_id, token in enumerate(self.token_bytes)}

    @property
    def vocab_size(self) -> int:
        return len(self.token_bytes)

    def encode_rules(self) -> list[tuple[int, int, int]]:
        """(a, b, emitted id) in rank order."""
        table = self.token_bytes
        return [(m.a, m.b, self.canonical_id[table[m.a] + table[m.b]]) for m in self.merges]

    def special_id(self, special: str) -> int:
        return self.canonical_id[special.encode("utf-8")]

    def merges_table(self, spark: SparkSession) -> DataFrame:
        first = self.first_merge_id
        # A loaded vocabulary has its own places for what the merges make.
        made = [first + i if self.loaded_vocab is None else rule[2] for i, rule in enumerate(self.encode_rules())]
        rows = [(i, m.a, m.b, new, m.cnt) for i, (m, new) in enumerate(zip(self.merges, made))]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    def kinds(self) -> list[str]:
        """What each id is; in a loaded vocabulary its bytes tell."""
        if self.loaded_vocab is None:
            first = self.first_merge_id
            return ["byte" if i < N_BYTES else "special" if i < first else "merge" for i in range(self.vocab_size)]
        specials = {s.encode("utf-8") for s in self.specials}
        return ["special" if t in specials else "byte" if len(t) == 1 else "merge" for t in self.token_bytes]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(t), kind) for i, (t, kind) in enumerate(zip(self.token_bytes, self.kinds()))]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)


def vocab_stats(vocab: DataFrame) -> DataFrame:
    """Vocabulary size, longest token length, first token of that length."""
    length = F.octet_length("token")
    return vocab.agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.max(length).alias("longest_bytes"),
        F.max_by("token", F.struct(length, -F.col("token_id"))).alias("longest_token"),
    )


def tokenizer_from_tables(merges: DataFrame, specials: Sequence[str] = ()) -> Tokenizer:
    rows = merges.select("rank", "a", "b", "cnt").collect()
    ordered = sorted(rows, key=lambda r: r["rank"])
    return Tokenizer(tuple(Merge(r["a"], r["b"], r["cnt"]) for r in ordered), tuple(specials))
