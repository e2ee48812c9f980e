"""Quality rules: per-document measures and cross-document line frequency per host, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import BLANK_WORD, beside, lowered, small, stored

#: A line is boilerplate of its host when at least so many distinct texts hold it, and more than this share of the host's distinct
#: texts; so the limit is reached in hosts of any size. A document is depleted when boilerplate is more than this share (percent) of
#: its words.
MIN_DOCS, HOST_SHARE, DEPLETED_PERCENT = 3, 0.05, 80
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BLANKS = " \t\n\x0b\f\r"


def _lines(text: str = "text"):
    """The lines that hold a word: raw line, hash of its lower-cased words, number of words."""
    line = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: F.regexp_like(x, F.lit(BLANK_WORD)))
    return F.transform(
        line,
        lambda x: F.struct(
            x.alias("raw"),
            F.xxhash64(F.trim(F.regexp_replace(lowered(x), r"[\x20\x09-\x0D]+", " "))).alias("hash"),
            F.regexp_count(x, F.lit(BLANK_WORD)).alias("n"),
        ),
    )


def frequent_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = HOST_SHARE) -> DataFrame:
    """Boilerplate per host: (host, lines: array of line hashes).

    Counts distinct texts, so a text that stands in a host many times counts once. The first grouping is by host, line
    and text, so that neither a hot host nor a hot line meets in one task; the second sums counts with partial sums.
    """
    texts = docs.select(F.col(host).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("doc"), F.transform(_lines(), lambda x: x["hash"]).alias("lines"))
    held = texts.select("host", "doc", F.explode(F.array_distinct("lines")).alias("line")).distinct()
    counted = held.groupBy("host", "line").count().filter(F.col("count") >= min_docs)
    sizes = texts.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs")).withColumnRenamed("host", "of")
    above = counted.join(sizes, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("count") > F.lit(share) * F.col("docs"))
    return above.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("frequent"))


def measured(docs: DataFrame) -> DataFrame:
    """Adds the base measures and ``lines``; every measure is computed inside the row."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(BLANK_WORD), 0)
    n = F.col("n_words")
    df = docs.withColumn("_words", words).withColumn("n_words", F.size("_words").cast("long")).withColumn("_lines", _lines())
    text = F.coalesce("text", F.lit(""))
    # Windows of three words as (hash, place), sorted; equal neighbours are repeats. What they cover is a union of spans.
    windows = F.when(
        n >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), (n - 3).cast("int")),
                lambda i: F.struct(F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("p")),
            )
        ),
    )
    df = df.withColumn("_windows", windows)
    same = lambda i, x: F.coalesce(F.get("_windows", i)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_places", F.sort_array(F.transform(F.filter("_windows", lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["p"])))
    covered = F.transform("_places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_places", i + 1) - p, F.lit(3))))
    return df.withColumns(
        {
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct(F.transform("_lines", lambda x: x["raw"])))).cast("long"),
            "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        }
    ).drop("_words", "_windows", "_places")


@beside("text", "source")
def judged(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = HOST_SHARE, depleted: int = DEPLETED_PERCENT) -> DataFrame:
    """Every row with its measures, ``n_removed_words``, ``base_failed``, ``kept`` and ``clean_text``.

    ``clean_text`` is the text without the host's boilerplate lines, unchanged if it has none. Null and empty texts have
    no words and fail the base rule. Null is a host of its own. Repeated rows are judged each, alike. Other columns pass
    through, whatever their names; the host column is ``source``.
    """
    frequent = stored(frequent_lines(docs, "source", min_docs, share))
    df = measured(docs).join(small(frequent, 10_000), F.col("source").eqNullSafe(F.col("host")), "left").drop("host")
    found = F.array_intersect(F.transform("_lines", lambda x: x["hash"]), F.coalesce("frequent", F.array().cast("array<bigint>")))
    df = df.withColumn("_found", found)
    gone = lambda x: F.array_contains("_found", x["hash"])
    lost = F.aggregate(F.filter("_lines", gone), F.lit(0), lambda a, x: a + x["n"])
    df = df.withColumn("n_removed_words", F.when(F.size("_found") > 0, lost).otherwise(0).cast("long"))
    raw = F.transform(F.filter("_lines", gone), lambda x: x["raw"])
    df = df.withColumn("_gone", F.when(F.size("_found") > 0, raw))
    clean = F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("_gone", x)), "\n")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    kept = ~base & (100 * F.col("n_removed_words") <= depleted * F.col("n_words"))
    df = df.withColumns({"clean_text": F.when(F.size("_found") > 0, clean).otherwise(F.col("text")), "base_failed": base, "kept": kept})
    return df.drop("_lines", "_found", "_gone", "frequent")


def accepted(rows: DataFrame) -> DataFrame:
    """The judged rows that are kept. A filter would be pushed below the measures and evaluate them again inside their own
    lambdas; a generator with one or no row stays where it is."""
    once = F.when(F.col("kept"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return rows.withColumn("_once", F.explode(once)).drop("_once")
