"""Language of web pages: text likelihoods fused with the declared language, the address suffix and smoothed host priors.

Text likelihoods come from hashed byte trigrams, counted over all documents with a known language. Every page gets a first
guess from its text; grouped counts of these guesses then give P(declared | language), P(suffix | language) and a
chain of priors from all pages to the domain to the host, each level smoothed by the one above and without the page itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import LOWER_BYTES, small, stored, utf8

GRAMS = 1 << 16
#: A text counts as this many independent trigrams at most, and three overlapping ones as one.
STRENGTH = 300
#: Pages by which a level of the prior chain outweighs the one above.
PRIOR_PAGES = 5.0
_TAGS = re.compile(rb"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>")


def grams(body: bytes) -> np.ndarray:
    """Hashes of all byte trigrams of the lower-cased text, runs of anything but letters being one blank."""
    clean = b" " + b" ".join(re.findall(rb"[a-z\x80-\xff]+", body.translate(LOWER_BYTES))) + b" "
    a = np.frombuffer(clean, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64)
    return ((((a[:-2] << 16) | (a[1:-1] << 8) | a[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def page_text(html: bytes) -> bytes:
    """Without comments, scripts, styles, tags and character references."""
    return re.sub(rb"&[#\w]+;", b" ", _TAGS.sub(b" ", html))


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities per language and trigram hash); one count table of fixed size per language."""
    rows = docs.filter("lang IS NOT NULL").select("lang", utf8(F.col("text")).alias("body"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body")):
                found = grams(body.as_py())
                sums.setdefault(lang, np.zeros(GRAMS, np.int64))
                np.add.at(sums[lang], found, 1)
        yield _tables(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, counts in zip(batch.column("lang").to_pylist(), batch.column("counts")):
                sums[lang] = sums.get(lang, 0) + np.frombuffer(counts.as_py(), np.int64)
        yield _tables(sums)

    schema = "lang string, counts binary"
    found = sorted(rows.mapInArrow(count, schema).repartition("lang").mapInArrow(add, schema).collect(), key=lambda r: r.lang)
    counts = np.array([np.frombuffer(r.counts, np.int64) for r in found], float).reshape(len(found), GRAMS) + 0.1
    return [r.lang for r in found], np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def _tables(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    packed = [s.tobytes() for s in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(packed, pa.binary())], names=["lang", "counts"])


def evidence(pages: DataFrame, languages: list[str], logs: np.ndarray) -> DataFrame:
    """Per page: page_id, host, domain, suffix, declared (primary language tag) and ``text``, a log likelihood per language."""
    model = pages.sparkSession.sparkContext.broadcast(logs)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    tag = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    rows = pages.select("page_id", host.alias("host"), F.lower(tag).alias("declared"), utf8(F.col("html")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for body in batch.column("body"):
                found = grams(page_text(body.as_py()))
                texts.append((model.value[:, found].mean(1, dtype=float) * min(len(found), STRENGTH) / 3 if len(found) else np.zeros(len(model.value))).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "declared")), pa.array(texts, pa.list_(pa.float64()))], names=["page_id", "host", "declared", "text"])

    found = rows.mapInArrow(run, "page_id long, host string, declared string, text array<double>")
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    suffix = F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise("")
    guess = F.array_position("text", F.array_max("text")).cast("int") - 1
    return found.withColumns({"domain": domain, "suffix": suffix, "guess": guess})


def identified(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per page: page_id, host, declared, suffix, text_lang, lang, probability.

    A page without text has even likelihoods; an undeclared language, or an address without host or suffix, says nothing. Null
    html and url count as empty. Ties go to the language first in order. With no documents of a known language, lang is null.
    Counts are grouped with partial sums; the joins on host and domain may be split, so a hot host does not meet in one task.
    """
    languages, logs = trained(docs)
    if not languages:
        nothing = F.lit(None).cast("string")
        return evidence(pages, ["?"], np.zeros((1, GRAMS), np.float32)).select("page_id", "host", "declared", "suffix", nothing.alias("text_lang"), nothing.alias("lang"), F.lit(None).cast("double").alias("probability"))
    size = len(languages)
    rows = stored(evidence(pages, languages, logs))
    per_language = F.array(*[F.sum((F.col("guess") == k).cast("double")) for k in range(size)])
    counts = {c: stored(rows.filter(F.col(c) != "").groupBy(c).agg(per_language.alias(f"{c}_counts"))) for c in ("host", "domain", "declared", "suffix")}
    everything = rows.agg(per_language.alias("n")).first().n
    total = sum(everything)
    overall = F.array(*[F.lit((n + 1) / (total + size)) for n in everything])
    # P(value | language) from the counts of the value and the language's total over all values.
    values = {}
    for c in ("declared", "suffix"):
        sums = [r or 0.0 for r in counts[c].agg(*[F.sum(F.get(f"{c}_counts", F.lit(k))) for k in range(size)]).first()]
        kinds = counts[c].count()
        all_of = F.array(*[F.lit(s + kinds + 1.0) for s in sums])
        values[c] = lambda k, c=c, all_of=all_of: F.log((F.get(f"{c}_counts", k) + 1.0) / F.get(all_of, k))
    df = rows
    for c in ("host", "domain", "declared", "suffix"):
        df = df.join(small(counts[c], 10_000), c, "left")

    def level(counts: str, k, above):
        """Share of a language among the group's other pages, smoothed by the level above."""
        others = F.get(counts, k) - (F.col("guess") == k).cast("double")
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) - 1
        return F.when(F.col(counts).isNull(), above).otherwise((others + PRIOR_PAGES * above) / (n + PRIOR_PAGES))

    def fused(k):
        prior = level("host_counts", k, level("domain_counts", k, F.get(overall, k)))
        said = [F.when(F.col(f"{c}_counts").isNull(), 0.0).otherwise(values[c](k)) for c in ("declared", "suffix")]
        return F.get("text", k) + F.log(prior) + said[0] + said[1]

    df = df.withColumn("fused", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), fused)).withColumn("top", F.array_max("fused"))
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_position("fused", F.col("top")).cast("int") - 1
    share = 1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    return df.select("page_id", "host", "declared", "suffix", F.get(names, F.col("guess")).alias("text_lang"), F.get(names, best).alias("lang"), share.alias("probability"))
