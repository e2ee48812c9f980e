"""The stages of the pipeline, each held against brute force over all that the stage before it kept."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
from pyspark.sql import functions as F
from test_operators import BLANK, LOWER, PLAIN, bag, brute_classes, brute_lines

from weftline.llm.sql import mixing_parts


def quality(rows, con):
    """Lines that at least 3 and more than 5 % of a host's distinct texts hold go, then the measures of the text as it was decide."""
    texts, held = defaultdict(set), defaultdict(set)
    norm = lambda line: " ".join(re.findall(BLANK, line.translate(LOWER)))
    for _, text, source in rows:
        texts[source].add(text or "")
        for line in (text or "").split("\n"):
            held[source, norm(line)].add(text)
    out = []
    for doc_id, text, source in rows:
        words = re.findall(BLANK, text or "")
        wins = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if wins[tuple(words[i : i + 3])] > 1 for k in range(3)}
        often = lambda x: norm(x) and len(held[source, norm(x)]) >= 3 and len(held[source, norm(x)]) > 0.05 * len(texts[source])  # noqa: E731, B023
        lost = sum(len(norm(x).split()) for x in (text or "").split("\n") if often(x))
        if len(words) >= 50 and 100 * len(hit) <= 50 * len(words) and 100 * lost <= 80 * len(words):
            out.append((doc_id, "\n".join(x for x in text.split("\n") if not often(x))))
    return out


def line_dedup(rows, con):
    gone, out = brute_lines(rows), []
    for doc_id, text in rows:
        lost = gone[doc_id, text]
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in lost)
        if not lost or re.search(BLANK, left):
            out.append((doc_id, left))
    return out


def one_per_class(rows, con):
    top = {i: c for i, _, c in brute_classes(rows)}
    return list(dict.fromkeys((i, t) for i, t in rows if i is None or top[i] == i))


def decontaminate(rows, con):
    windows = set()
    for (text,) in con.execute("SELECT text FROM benchmark").fetchall():
        w = re.findall(PLAIN, (text or "").translate(LOWER))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w}
    out = []
    for doc_id, text in rows:
        spans = [m.span() for m in re.finditer(PLAIN, text.translate(LOWER))]
        w = [text.translate(LOWER)[a:b] for a, b in spans]
        hit = {i + k for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        if 100 * len(hit) > 50 * len(w):
            continue
        left = text[: spans[0][0]] if spans else text
        for i, (a, _) in enumerate(spans):
            end = spans[i + 1][0] if i + 1 < len(spans) else len(text)
            left += "" if i in hit else text[a:end]
        out.append((doc_id, left))
    return out


def test_stages(spark, folder, con):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, []
    for (name, stage), brute in zip(corpus_pipeline.STAGES, [quality, line_dedup, one_per_class, decontaminate]):
        rows = [(r.doc_id, r.text, r.source)[: 3 if brute is quality else 2] for r in docs.collect()]
        done = stage(spark, docs, folder)
        assert done.columns == columns, name
        kept = done.collect()
        assert bag((r.doc_id, r.text) for r in kept) == bag(brute(rows, con)), name
        assert all(r.n_chars == len(r.text) for r in kept), name
        docs = spark.createDataFrame(kept, done.schema)
        sizes.append((len(rows), len(kept)))
    assert sizes[0][0] > sizes[0][1] and sizes[-1][1] > 10
    mixed = corpus_pipeline.STAGES[4][1](spark, docs, folder).collect()
    db = duckdb.connect()
    table = docs.select("doc_id", "text", "source").toArrow()
    db.register("left_over", table)
    want = db.execute(f"WITH {mixing_parts('left_over')} SELECT doc_id, copies FROM mixed WHERE copies > 0").fetchall()
    assert Counter((r.doc_id, r.text) for r in mixed).total() == sum(c for _, c in want)
    assert Counter(r.doc_id for r in mixed) == Counter({d: 0 for d, _ in want}) + Counter(d for d, c in want for _ in range(c))


def test_empty_documents(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).count() == 0


def test_own_columns_come_through(spark, folder, tmp_path):
    """Extra columns with the names of those that operators add keep their values, and the result can be written."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"copy": F.lit("own"), "kept": F.lit("own"), "clean_text": F.lit("own"), "n_removed_lines": F.lit(7)})
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns[: len(columns)] == columns, name
    assert docs.columns == [*columns, "size_", "copy_"]
    assert {(r.copy, r.kept, r.clean_text, r.n_removed_lines, r.size, r.rate) for r in docs.collect()} == {("own", "own", "own", 7, "clash", "clash")}


def test_stages_without_a_count_and_with_repeated_rows(spark, folder):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(7, text, "a"), (7, text, "a"), (None, text + " x", "a"), (None, text + " x", None), (8, text + " y", "b"), (9, "other " + " ".join(f"v{k}" for k in range(70)), "b"), (10, None, "c"), (11, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert Counter(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, folder).collect()) == {7: 2, None: 2, 8: 1, 9: 1}
    assert Counter(r.doc_id for r in corpus_pipeline.jaccard_join(spark, docs, folder).collect()) == {7: 1, None: 1, 9: 1, 10: 1, 11: 1}
    assert all(stage(spark, docs, folder).columns[:3] == docs.columns for _, stage in corpus_pipeline.STAGES)
