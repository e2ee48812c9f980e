"""From raw documents to a training mix: five stages, each a Parquet table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.llm import decontaminate, jaccard, lines, mixing, quality
from weftline.llm.common import forget, prepared, stored, table


def _sized(docs: DataFrame) -> DataFrame:
    """The text may have become shorter; a null text keeps its count, and a table without the count stays without."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def _apart(docs: DataFrame, step: Callable[[DataFrame], DataFrame], *added: str) -> DataFrame:
    """``step`` over documents of which only id, text and source keep their names, so that their other columns come through as
    they are, even one that is named like a column of the operator. Of the columns that ``step`` adds, those in ``added`` stay,
    with an underscore more where the documents have such a column."""
    names = {c: f"own_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    done = step(docs.withColumnsRenamed(names))
    extra = []
    for name in added:
        free = name
        while free in docs.columns:
            free += "_"
        extra.append(F.col(name).alias(free))
    return done.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns], *extra)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, also those without text or words; the others lose the boilerplate lines of their host. Repeated
    rows are judged each; an empty table stays empty."""
    return _sized(_apart(docs, lambda d: quality.accepted(quality.judged(d)).withColumn("text", F.col("clean_text"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document holds go from the later one, and documents of which nothing is left. Null and empty texts
    and rows without id stay as they are; rows that share an id are not compared."""
    return _sized(_apart(docs, lines.without_common_blocks))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar shingle sets stays, the one with the smallest id, and one of each repeated id and
    text. Texts without words and rows without id are classes of their own."""
    return _apart(docs, jaccard.one_per_class)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of words from benchmark items go; documents made of them go. Null and empty texts stay; repeated rows are cut alike."""
    items = table(spark, sf_dir, "benchmark")
    return _sized(_apart(docs, lambda d: decontaminate.cut(d, items)))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate says, with its ``size`` and numbered by ``copy``. Null is a source of its own, a
    text without words has size 0, rows with equal ids draw the same coin."""
    return _apart(docs, lambda d: mixing.emit_copies(mixing.mixing_plan(d)), "size", "copy")


#: (name, function); a function takes (spark, docs, sf_dir) and returns the documents that go on.
STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
]

#: Patience diff and suffix automaton runs are not expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result but the last is stored, and forgotten once the next one is."""
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs)
            if k > 1:
                forget(before)
    return docs
