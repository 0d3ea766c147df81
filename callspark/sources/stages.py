"""Stages that are written beside what is there, published by a commit, and resumed by the next run.

A stage is a folder with one directory per version and a table of commits. A version is written
first; a row in the commits then names it, with a fingerprint of what it was made from. Readers follow the
last commit, so a run that ends half-way leaves a version that nobody reads, and a reader never sees a
stage that is half replaced. A run that finds a commit with its own fingerprint takes that version and
computes nothing. Everything goes through Spark's readers and writers, to any store they reach.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMITS = "version string, fingerprint string, committed_ns long, retired boolean"


@dataclass(frozen=True)
class Stages:
    """The stages below a folder that all executors share."""

    spark: SparkSession
    folder: str

    def _at(self, name: str, *more: str) -> str:
        return "/".join((self.folder.rstrip("/"), name, *more))

    def commits(self, name: str) -> list:
        """Commits of a stage, the last one first; a row for each finished run."""
        try:
            rows = self.spark.read.schema(_COMMITS).parquet(self._at(name, "commits"))
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return rows.orderBy(F.desc("committed_ns"), F.desc("version")).collect()

    def versions(self, name: str) -> list[str]:
        """Versions that can be read, the last commit first."""
        commits = self.commits(name)
        gone = {c["version"] for c in commits if c["retired"]}
        return [c["version"] for c in commits if c["version"] not in gone]

    def read(self, name: str, version: str | None = None) -> DataFrame:
        """The last committed version of a stage, or the one named."""
        known = self.versions(name)
        if not known or version is not None and version not in known:
            raise FileNotFoundError(f"no committed version {version or ''} of {name} below {self.folder}")
        return self.spark.read.parquet(self._at(name, version or known[0]))

    def write(self, name: str, df: DataFrame, fingerprint: str = "") -> str:
        """Writes a new version and publishes it; returns its name."""
        version = f"v-{uuid.uuid4().hex}"
        df.write.parquet(self._at(name, version))
        self._commit(name, version, fingerprint)
        return version

    def _commit(self, name: str, version: str, fingerprint: str, retired: bool = False) -> None:
        row = self.spark.createDataFrame([(version, fingerprint, time.time_ns(), retired)], _COMMITS).coalesce(1)
        row.write.mode("append").parquet(self._at(name, "commits"))

    def run(self, name: str, fingerprint: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The committed version with this fingerprint if there is one; otherwise ``make`` is called, written and published."""
        gone = set(self.versions(name))
        for commit in self.commits(name):
            if commit["fingerprint"] == fingerprint and commit["version"] in gone:
                return self.read(name, commit["version"])
        return self.read(name, self.write(name, make(), fingerprint))

    def retire(self, name: str, keep: int = 1) -> int:
        """Gives up all committed versions but the last ``keep``; returns how many.

        A version is first marked, so that no reader starts on it, and then overwritten by an
        empty table, which frees its space.
        """
        old = self.versions(name)[keep:]
        for version in old:
            rows = self.spark.read.parquet(self._at(name, version))
            self._commit(name, version, "", retired=True)
            self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(self._at(name, version))
        return len(old)


def fingerprint(*inputs: DataFrame | str | int | float | None) -> str:
    """Tells runs over different inputs apart: the number and a sum of hashes of all rows, and plain values as they are.

    Each table is read once; two tables with the same rows in another order have the same fingerprint.
    """
    parts = []
    for value in inputs:
        if isinstance(value, DataFrame):
            # Maps have no hash; their JSON has.
            columns = [F.to_json(f"`{f.name}`") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in value.schema.fields]
            hashed = F.xxhash64(*columns)
            n, low, high = value.agg(
                F.count(F.lit(1)), F.sum(hashed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(hashed, 32))
            ).first()
            parts.append(f"{value.schema.simpleString()}#{n}#{low}#{high}")
        else:
            parts.append(repr(value))
    return "|".join(parts)
