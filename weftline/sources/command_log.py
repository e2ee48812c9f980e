"""A log of key-value commands as a table, the form in which key-value workloads reach Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# op is one of: set, del, incr, persist. ``field`` is the field of a record or the member of a set.
COMMAND_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("ttl_s", T.LongType()),
    ]
)


def commands(
    rows: DataFrame, key: Column, op: Column, ts: Column, seq: Column, field: Column | None = None,
    value: Column | None = None, ttl_s: Column | None = None,
) -> DataFrame:
    """Read any table (or stream) as a command log."""
    given = {"key": key, "op": op, "field": field, "value": value, "ts": ts, "seq": seq, "ttl_s": ttl_s}
    columns = []
    for f in COMMAND_SCHEMA.fields:
        source = given[f.name] if given[f.name] is not None else F.lit(None)
        columns.append(source.cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def command_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Command files (JSON lines) as they arrive in a folder."""
    return spark.readStream.schema(COMMAND_SCHEMA).options(**options).json(path)
