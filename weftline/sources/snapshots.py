"""Versioned tables: a change writes new files, and readers see them only once they are committed."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_COMMITS = "version long, folder string, batch string, base boolean"


class Snapshots:
    """Versions of one table under ``base`` (any path Spark can write to, shared by all executors).

    ``publish`` writes a full version; ``append`` writes only additional rows, and readers see them together with the
    full version before. Rows go to a folder of their own first; a one-row entry in the commit log then makes them
    visible, so a job that fails half way changes nothing. One writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.base}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def latest(self) -> int | None:
        """Number of the newest version, or None before the first."""
        return self._commits().agg(F.max("version")).first()[0]

    def publish(self, df: DataFrame, batch: str | None = None) -> int:
        """Write ``df`` as the next full version. A ``batch`` that was committed before is not written again."""
        return self._commit(df, batch, base=True)

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """Add rows to the table. A ``batch`` that was committed before is not written again."""
        return self._commit(df, batch, base=False)

    def _commit(self, df: DataFrame, batch: str | None, base: bool) -> int:
        same_batch = F.max(F.when(F.col("batch") == F.lit(batch), F.col("version")))
        newest, done = self._commits().agg(F.max("version"), same_batch).first()
        if done is not None:
            return done
        version = (newest or 0) + 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.base}/{folder}")
        entry = self.spark.createDataFrame([(version, folder, batch, base)], _COMMITS)
        entry.coalesce(1).write.mode("append").parquet(f"{self.base}/commits")
        return version

    def _folders(self, version: int | None) -> list[str]:
        """Folders that make up a version: the last full one and what was appended after it."""
        commits = self._commits() if version is None else self._commits().where(F.col("version") <= version)
        start = commits.where("base").agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
        rows = commits.where(F.col("version") >= start).select("version", "folder").collect()
        return [f"{self.base}/{r.folder}" for r in sorted(rows)]

    def pending(self) -> int:
        """Number of appends since the last full version."""
        return len(self._folders(None))

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the one asked for."""
        folders = self._folders(version)
        if not folders:
            raise ValueError(f"no version {version or ''} under {self.base}")
        return self.spark.read.parquet(*folders)

    def clear(self) -> int:
        """Publish an empty version with the same columns; earlier versions stay readable."""
        return self.publish(self.spark.createDataFrame([], self.read().schema))
