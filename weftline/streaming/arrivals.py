"""A table handed to a stream in several arrivals: rows that land in one folder, one arrival after another."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.scalars import epoch_micros
from weftline.session import scratch_path

ARRIVAL = "__arrival"


class Arrivals:
    """Rows of a table by the number of their arrival, which is any whole number; rows without one come first.

    ``stream`` reads the folder in which they land. Iterating lands the next arrival and gives its number, so whoever runs the
    stream to its end between two steps sees one micro-batch per arrival, and the watermark moves in between. An arrival
    has any number of files. The table is read once, to part it by arrival.
    """

    def __init__(self, rows: DataFrame, arrival: Column):
        spark = rows.sparkSession
        self._spark, self._schema = spark, rows.schema
        self._staged, self._landing = scratch_path(spark, "staged"), scratch_path(spark, "landing")
        rows.withColumn(ARRIVAL, arrival.cast("long")).write.partitionBy(ARRIVAL).parquet(self._staged)
        spark.createDataFrame([], rows.schema).write.parquet(self._landing)

    @property
    def stream(self) -> DataFrame:
        return self._spark.readStream.schema(self._schema).parquet(self._landing)

    def __iter__(self) -> Iterator[int | None]:
        staged = self._spark.read.schema(f"{_ddl(self._schema)}, `{ARRIVAL}` long").parquet(self._staged)
        numbers = [r[0] for r in staged.select(ARRIVAL).distinct().orderBy(F.col(ARRIVAL).asc_nulls_first()).collect()]
        for number in numbers:
            staged.where(F.col(ARRIVAL).eqNullSafe(F.lit(number))).drop(ARRIVAL).write.mode("append").parquet(self._landing)
            yield number


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def in_pieces(rows: DataFrame, ts: str, pieces: int, late_by: Column) -> Arrivals:
    """Arrivals that part the time range of the table into equal pieces; ``late_by`` is how much later than its time a row comes,
    in seconds."""
    at = epoch_micros(ts) + late_by * 1_000_000
    low, high = rows.agg(F.min(at), F.max(at)).first()
    width = 1 if low is None else max(1, -(-(high + 1 - low) // pieces))
    return Arrivals(rows, F.floor((at - F.lit(low or 0)) / F.lit(width)))


def by_days(rows: DataFrame, ts: str, days: int, late_days: Column) -> Arrivals:
    """One arrival for every ``days`` days from the table's first day on; a row comes ``late_days`` after its own day."""
    first = rows.agg(F.to_date(F.min(ts))).first()[0]
    return Arrivals(rows, F.floor((F.datediff(F.to_date(ts), F.lit(first)) + late_days) / F.lit(days)))
