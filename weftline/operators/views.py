"""Named queries: plain views, refreshable snapshots and incrementally maintained aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.session import cut_lineage
from weftline.sources.snapshots import Snapshots

BATCH, BUCKET = "__batch", "__bucket"


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A temporary view; each read runs the query again. Returns the view as a DataFrame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


class MaterializedView:
    """A query whose result is stored. Changes of the base tables stay unseen until ``refresh``."""

    def __init__(self, store: Snapshots, define: Callable[[], DataFrame]):
        self.store, self.define = store, define
        if store.latest() is None:
            self.refresh()

    def refresh(self) -> int:
        return self.store.publish(self.define())

    def read(self) -> DataFrame:
        return self.store.read()


class IncrementalAggregate:
    """Sums and counts per key, kept up to date from new rows alone.

    A batch is reduced to one row per key and appended as it is, so the cost of a merge depends on the batch, not on the
    table; a hot key is absorbed by the partial aggregation. Readers add the parts up. After ``compact_after`` appends
    the parts are folded into one. A batch id that was merged before is skipped, which makes a replay harmless.
    """

    def __init__(self, store: Snapshots, keys: Sequence[str], sums: dict[str, str], count: str, compact_after: int = 16):
        self.store, self.keys, self.sums, self.count = store, list(keys), sums, count
        self.compact_after = compact_after

    def merge(self, rows: DataFrame, batch: str) -> None:
        sums = [F.sum(value).alias(out) for out, value in self.sums.items()]
        self.store.append(rows.groupBy(*self.keys).agg(*sums, F.count(F.lit(1)).alias(self.count)), batch)
        if self.store.pending() > self.compact_after:
            self.store.publish(self.read())

    def read(self) -> DataFrame:
        parts = self.store.read()
        types = {f.name: f.dataType for f in parts.schema.fields}
        totals = [F.sum(c).cast(types[c]).alias(c) for c in (*self.sums, self.count)]
        return parts.groupBy(*self.keys).agg(*totals)


class LatestTable:
    """The last write per key, kept up to date while batches arrive, in the same way."""

    def __init__(self, store: Snapshots, keys: Sequence[str], order: Sequence[str], compact_after: int = 16):
        self.store, self.keys, self.order, self.compact_after = store, list(keys), list(order), compact_after

    def _last(self, rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rows.columns), F.struct(*self.order)).alias("__last")
        return rows.groupBy(*[F.col(k).alias(f"__k_{k}") for k in self.keys]).agg(last).select("__last.*")

    def merge(self, rows: DataFrame, batch: str) -> None:
        self.store.append(self._last(rows), batch)
        if self.store.pending() > self.compact_after:
            self.store.publish(self.read())

    def read(self) -> DataFrame:
        return self._last(self.store.read())


class _Bucketed:
    """One row per key in a table parted by key bucket, of which a merge rewrites the touched buckets only.

    Keys are hashed into ``buckets`` folders. A batch is reduced to one row per key; the buckets that it touches are read, folded with
    it and written again, the others stay as they are, and there is no log that grows. Every bucket holds the number of the last
    batch it has taken, so batches come with rising numbers, and one that is delivered again, whole or after a failure half
    way, changes only the buckets that it had not reached. One writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _reduced(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _folded(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _stored(self, like: DataFrame) -> DataFrame:
        try:
            return self.spark.read.schema(like.schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], like.schema)

    def merge(self, rows: DataFrame, batch: int) -> None:
        added = self._reduced(rows)
        names, bucket = added.columns, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        added = cut_lineage(added.withColumns({BATCH: F.lit(batch).cast("long"), BUCKET: bucket}))
        # At most one number a bucket, so this list is bounded.
        touched = [r[0] for r in added.select(BUCKET).distinct().collect()]
        if not touched:
            return
        before = self._stored(added).where(F.col(BUCKET).isin(touched))
        reached = [r[0] for r in before.groupBy(BUCKET).agg(F.max(BATCH).alias("last")).where(F.col("last") >= batch).collect()]
        both = before.unionByName(added).where(~F.col(BUCKET).isin(reached)).select(*names)
        whole = self._folded(both).withColumns({BATCH: F.lit(batch).cast("long"), BUCKET: bucket})
        # Written aside first, as it reads what it replaces.
        whole = cut_lineage(whole.select(*added.columns))
        whole.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BATCH, BUCKET)


class BucketedAggregate(_Bucketed):
    """Sums and counts per key, in buckets."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sums: dict[str, str], count: str, buckets: int = 64):
        super().__init__(spark, path, keys, buckets)
        self.sums, self.count = sums, count

    def _reduced(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(value).alias(out) for out, value in self.sums.items()]
        return rows.groupBy(*self.keys).agg(*sums, F.count(F.lit(1)).alias(self.count))

    def _folded(self, rows: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in rows.schema.fields}
        return rows.groupBy(*self.keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in (*self.sums, self.count)])


class BucketedLatest(_Bucketed):
    """The last row per key by ``order``, in buckets."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64):
        super().__init__(spark, path, keys, buckets)
        self.order = list(order)

    def _reduced(self, rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rows.columns), F.struct(*self.order)).alias("__last")
        return rows.groupBy(*[F.col(k).alias(f"__k_{k}") for k in self.keys]).agg(last).select("__last.*")

    _folded = _reduced
