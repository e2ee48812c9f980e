"""Running a stream to the end of its input, with sinks that take each micro-batch once."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from weftline.session import scratch_path

# Later than any event; its only use is to move the watermark past the last real window.
END_OF_TIME = "2900-01-01 00:00:00"


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Streaming time functions need a zoned timestamp; the session zone is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _drain(start: Callable[[], object], arrivals: Iterable | None) -> list[dict]:
    """Run a query over all that is there, once, or after each arrival; every run goes on from the checkpoint. The progress
    reports of all runs."""
    progress = []
    for _ in arrivals if arrivals is not None else [None]:
        run = start()
        run.awaitTermination()
        progress += run.recentProgress
    return progress


def append_to(stream: DataFrame, out: str, checkpoint: str, arrivals: Iterable | None = None) -> list[dict]:
    """Write all available input to parquet files (exactly once per checkpoint) and return the progress reports."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    return _drain(writer.start, arrivals)


def run_to_close(
    events: DataFrame, ts: str, build: Callable[[DataFrame], DataFrame], arrivals: Iterable | None = None
) -> tuple[DataFrame, list[dict]]:
    """Run ``build`` over a finite stream and close its last windows too.

    Append mode emits a window only once the watermark has passed it, which never happens for the last ones. So the
    stream is joined by a second, empty file source. After all input is read, one far-future row is placed there and the
    same query continues from its checkpoint; the row's own window stays open and is never emitted.
    Returns the result and the progress reports of both runs.
    """
    spark = events.sparkSession
    folder = scratch_path(spark, "stream")
    clock, out, checkpoint = f"{folder}/clock", f"{folder}/out", f"{folder}/checkpoint"
    spark.createDataFrame([], events.schema).write.parquet(clock)
    with_clock = events.unionByName(spark.readStream.schema(events.schema).parquet(clock))
    progress = append_to(build(with_clock), out, checkpoint, arrivals)
    end = [
        (F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema.fields
    ]
    spark.range(1).select(*end).write.mode("append").parquet(clock)
    progress += append_to(build(with_clock), out, checkpoint)
    return spark.read.parquet(out), progress


def run_updates(stream: DataFrame, keys: list[str], arrivals: Iterable | None = None) -> DataFrame:
    """Run an aggregation in update mode and return the last value per key.

    Each micro-batch goes to a folder named by its batch id and replaces it, so a repeated batch changes nothing.
    """
    spark = stream.sparkSession
    folder = scratch_path(spark, "updates")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    writer = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("update")
        .trigger(availableNow=True)
    )
    _drain(writer.start, arrivals)
    rows = spark.read.parquet(f"{folder}/out")
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__last"))
    return last.select(*keys, *[f"__last.{c}" for c in values])


def run_merging(
    stream: DataFrame, merge: Callable[[DataFrame, int], object], checkpoint: str, arrivals: Iterable | None = None
) -> None:
    """Hand every micro-batch to ``merge(rows, batch_number)``; the number is the same when a batch is repeated."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge(batch, batch_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _drain(writer.start, arrivals)


def dropped_rows(progress: list[dict]) -> int:
    """Rows that came after the watermark had passed them and were left out."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
