"""Saved states of iterative jobs, one folder of tables per iteration."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenlake.workspace import hadoop_path


@dataclass(frozen=True)
class SavedState:
    spark: SparkSession
    path: str
    step: int
    meta: dict[str, Any]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def fingerprint(df: DataFrame, **settings: Any) -> dict[str, Any]:
    """What a job works on: the number of rows, a hash of them that no order changes, and its settings."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*sorted(df.columns))).alias("h"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("s")).first()
    return {"rows": row["n"], "hash": row["h"], "sum": str(row["s"]), "columns": sorted(df.columns), **settings}


class OtherJobError(ValueError):
    """A saved state is of another corpus or of other settings."""


class JobCheckpoint:
    """Writes and finds the states of one job under ``path``.

    The description of a state is written after its tables; a folder without it
    was interrupted and is ignored.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.of: dict[str, Any] | None = None

    def claim(self, of: dict[str, Any]) -> SavedState | None:
        """The newest state, if there is one, of the job with this :func:`fingerprint`; states saved from now on carry it."""
        self.of = json.loads(json.dumps(of))
        state = self.latest()
        if state is not None and state.meta.get("of") != self.of:
            raise OtherJobError(f"{state.path} was saved for {state.meta.get('of')}, not {self.of}")
        return state

    def _folder(self, step: int) -> str:
        return f"{self.path}/step={step:09d}"

    def save(self, step: int, tables: dict[str, DataFrame], meta: dict[str, Any]) -> None:
        folder = self._folder(step)
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
        row = self.spark.createDataFrame([(json.dumps(meta if self.of is None else meta | {"of": self.of}),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{folder}/meta")

    def steps(self) -> list[int]:
        """Complete steps, oldest first."""
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            done, marker = hadoop_path(self.spark, f"{self.path}/{name}/meta/_SUCCESS")
            if name.startswith("step=") and done.exists(marker):
                found.append(int(name[len("step="):]))
        return sorted(found)

    def load(self, step: int) -> SavedState:
        folder = self._folder(step)
        meta = json.loads(self.spark.read.text(f"{folder}/meta").first()["value"])
        return SavedState(self.spark, folder, step, meta)

    def latest(self) -> SavedState | None:
        steps = self.steps()
        return self.load(steps[-1]) if steps else None
