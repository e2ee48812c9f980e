"""Rate limiting with windows that open at the first hit, and leases that go to the first writer.

The first hit of a key opens a window of fixed length; a hit at or after its end opens the next one. Every hit counts,
also a refused one. A lease is the same with a length of its own for every attempt. Both are chains, see ``chains``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.scalars import epoch_micros, micros_to_ntz
from weftline.operators.chains import FIRST, PLACE, START, chain

SECOND = 1_000_000


def limit_from_first_hit(
    hits: DataFrame, key: str, ts: str, tiebreak: str, limit: int, window_s: int, group_limit: int | None = None
) -> DataFrame:
    """Add ``window_start``, ``count`` (place of the hit in its window), ``allowed`` and ``ttl_s`` to every hit.

    A hit without time belongs to no window and opens none: the four columns are null.
    """
    width = window_s * SECOND
    untimed, timed = hits.where(F.col(ts).isNull()), hits.where(F.col(ts).isNotNull())
    placed = timed.withColumn("__t", epoch_micros(ts)).withColumn("__until", F.col("__t") + width)
    chained = chain(placed, [key], "__t", tiebreak, "__until", group_limit)
    count = F.col(PLACE) - F.col(FIRST) + 1
    limited = chained.select(
        *hits.columns,
        micros_to_ntz(F.col(START)).alias("window_start"),
        count.alias("count"),
        (count <= limit).alias("allowed"),
        F.ceil((F.col(START) + width - F.col("__t")) / SECOND).alias("ttl_s"),
    )
    added = limited.schema.fields[len(hits.columns) :]
    return limited.unionByName(untimed.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}))


def leases(
    attempts: DataFrame, keys: list[str], ts: str, tiebreak: str, seconds: Column, group_limit: int | None = None
) -> DataFrame:
    """The attempts that get a lease on their key, with ``lease_start``, ``lease_end`` and ``refused``, the attempts that came in vain
    while it lasted.

    An attempt is granted when no lease of its key is open at its time, and then holds the key for its own number of
    ``seconds``; without a number (null) it holds it for ever. Attempts without time are left out.
    """
    endless = 2**62
    placed = attempts.where(F.col(ts).isNotNull()).withColumn("__t", epoch_micros(ts))
    placed = placed.withColumn("__until", F.coalesce(F.col("__t") + seconds.cast("long") * SECOND, F.lit(endless)))
    chained = chain(placed, keys, "__t", tiebreak, "__until", group_limit)
    end = F.when(F.col("__until") < endless, micros_to_ntz(F.col("__until")))
    owner = F.when(F.col(PLACE) == F.col(FIRST), F.struct(*attempts.columns, end.alias("lease_end")))
    held = chained.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys], FIRST, START).agg(F.first(owner, ignorenulls=True).alias("__own"), F.count(F.lit(1)).alias("__tries"))
    own = [F.col(f"__own.{c}").alias(c) for c in attempts.columns]
    return held.select(*own, micros_to_ntz(F.col(START)).alias("lease_start"), F.col("__own.lease_end").alias("lease_end"), (F.col("__tries") - 1).alias("refused"))
