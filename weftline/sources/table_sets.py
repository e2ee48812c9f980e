"""Several tables that change together: one commit entry names the folders of all of them."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_COMMITS = "version long, batch string, folders map<string, string>"


class TableSet:
    """Versions of a set of tables under ``base``. A version becomes visible by one entry of one row, for all tables at once, so a
    job that fails between two writes leaves none of them changed. One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMITS).parquet(f"{self.base}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMITS)

    def publish(self, tables: dict[str, DataFrame], batch: str | None = None) -> int:
        """Write all tables as the next version. A ``batch`` that was committed before is not written again."""
        same_batch = F.max(F.when(F.col("batch") == F.lit(batch), F.col("version")))
        newest, done = self._commits().agg(F.max("version"), same_batch).first()
        if done is not None:
            return done
        version = (newest or 0) + 1
        folders = {name: f"{name}-v{version}-{uuid.uuid4().hex}" for name in tables}
        for name, df in tables.items():
            df.write.parquet(f"{self.base}/{folders[name]}")
        entry = self.spark.createDataFrame([(version, batch, folders)], _COMMITS)
        entry.coalesce(1).write.mode("append").parquet(f"{self.base}/commits")
        return version

    def read(self, name: str) -> DataFrame:
        """The newest version of one table."""
        found = self._commits().agg(F.max_by(F.col("folders")[name], "version")).first()[0]
        if found is None:
            raise ValueError(f"no table {name} under {self.base}")
        return self.spark.read.parquet(f"{self.base}/{found}")
