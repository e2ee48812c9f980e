"""Mix sources to target weights: repetition rates per source, whole copies plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weftline.llm.common import BLANK_WORD, beside, small, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix"


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``size``: the number of words between blanks; 0 for a null text."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(BLANK_WORD)), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, size) rows to one row per source: source_size, target, rate.

    Sources in code point order, null last, get the weights in turn and share the total size. A target stops at
    ``max_repeat`` times the source; what is over is shared again by weight until no target is above. That is filling to a
    common level: sort by cap / weight, and the level is the first one that does not pass the cap it stands at. The
    windows run over one row per source, after the documents were aggregated.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_fill = Window.orderBy("fill", "nth")
    below = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    above = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (
        total.withColumn("nth", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(above))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "nth", "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return filled.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def coin(doc_id: str = "doc_id", seed: str = SEED):
    """A number in [0, 1) that depends on the seed and the id alone, so reruns and retries agree."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


@beside("doc_id", "text", "source")
def mixing_plan(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, rate and copies.

    Needs doc_id, text and source; other columns pass through, whatever their names. A null text has size
    0, null is a source of its own, equal ids draw the same coin, an empty table gives no rows. Only (source, size) is
    shuffled, after partial sums; the table of sources is broadcast once it is counted, else AQE splits the hot source.
    """
    docs = with_size(docs)
    rates = stored(source_targets(docs.select("source", "size"), weights, max_repeat)).withColumnRenamed("source", "rate_source")
    joined = docs.join(small(rates), docs["source"].eqNullSafe(F.col("rate_source")), "left").drop("rate_source")
    whole = F.floor("rate")
    return joined.withColumn("copies", whole + (coin() < F.col("rate") - whole).cast("long"))


def emit_copies(plan: DataFrame) -> DataFrame:
    """The mixed corpus: each row ``copies`` times, numbered from 0 in ``copy``."""
    return plan.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
