import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of and thing read write tree stone river light house green paper cloud spoon idiot scum über größe".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", ".\n"]) for _ in range(n))


def fixture_rows():
    """(doc_id, text, lang, source): distinct texts, copies, near copies, shared runs, junk, and every odd row."""
    rows = [(i, prose(i, 40 + 7 * i % 150), "en", ["b", "a", None, "c"][i % 4]) for i in range(60)]
    rows += [(100 + i, rows[3][1], "en", "b") for i in range(12)]
    base = prose(900, 160)
    rows += [(200 + i, base + f" end{i}", "en", "b") for i in range(12)]
    run = " ".join(prose(901, 70).split())
    rows += [(300 + i, prose(300 + i, 30) + run + " " + prose(400 + i, 30), "de", "a") for i in range(6)]
    rows += [(400, "la la la " * 60, "fr", "c"), (401, "# $ %|% " * 30, "fr", "c"), (402, "one\ntwo\none\n" * 20, None, "c")]
    rows += [(403, "Released Under the MIT License. Apache License, Version 2.0; CC BY-NC and cc-by-nc-sa " + prose(5, 60), "en", "a")]
    rows += [(404, "x" * 5000, "en", "a"), (405, "", "en", "a"), (406, None, "en", "a"), (407, " \t\n\x0b ", None, None)]
    rows += [(None, prose(7, 80), "en", "b"), (None, None, None, None), (5, rows[5][1], "en", "a"), (5, prose(77, 90), "en", "c")]
    rows += [(408, prose(8, 3000), "en", "b"), (409, "a b c", "en", "a"), (410, "A B  C", "en", "a"), (411, run, "en", "a")]
    return rows


def conversation_rows():
    """(conv_id, turn, role, text): a first turn that most share, copies, families, and every odd row."""
    rows = []
    for c in range(60):
        n = c % 5 + 1
        rows += [(c, k, "user" if k % 2 == 0 else "assistant", "hello there" if k == 0 and c % 3 else prose(700 + (c % 7) * 10 + k, 6)) for k in range(n)]
    rows += [(100 + c, k, "user", f"the same turn {k}") for c in range(30) for k in range(4)]
    rows += [(200, 0, "user", "a\tb"), (200, 0, "user", "a\tb"), (200, 0, "bot", None), (201, None, None, None), (202, 5, "x", ""), (202, 5, "", "x"), (202, None, "first", "one two")]
    rows += [(-7, 1, "user", "negative id"), (-20, 1, "user", "first of the negative"), (-20, 2, "user", "and more"), (None, 1, "user", "lost"), (203, 0, "user", "long " * 3000)]
    return rows


def vector_rows():
    """(vec_id, embedding): repeated ids and vectors, ties, short, empty and unusable ones."""
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(160)]
    rows += [(200 + i, list(rows[50][1])) for i in range(12)] + [rows[3], rows[50], (50, [1.0] * 8), (100, [0.5, -0.25])]
    rows += [(300, None), (350, [1.0, None]), (400, [float("nan")] * 8), (450, [float("inf"), 1.0]), (None, [1.0] * 8), (500, []), (501, [2.0]), (502, [0.0] * 9)]
    return rows


@pytest.fixture(scope="session")
def folder(tmp_path_factory):
    """Tables with every odd case, and columns whose names clash with those that operators add."""
    path = tmp_path_factory.mktemp("corpus")
    rows = fixture_rows()
    columns = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string()}
    data = {c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(columns.items())}
    data["n_chars"] = pa.array([len(r[1]) if r[1] else None for r in rows], pa.int64())
    for clash in ("size", "n_words", "kept", "copies", "digest", "host", "rate"):
        data[clash] = pa.array(["clash"] * len(rows))
    pq.write_table(pa.table(data), path / "documents.parquet")
    items = [("i1", " ".join(prose(10, 60).split()[5:30])), ("i2", "green paper cloud"), ("i3", rows[20][1]), ("i3", "nothing of this occurs"), (None, None), ("i4", ""), ("i5", "x")]
    pq.write_table(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}), path / "benchmark.parquet")
    labels = [(r[0], 0, int("idiot" in (r[1] or "") and r[0] % 2 == 0)) for r in rows if r[0] is not None]
    pq.write_table(pa.table({"doc_id": pa.array([x[0] for x in labels] + [None], pa.int64()), "quality": pa.array([x[1] for x in labels] + [1], pa.int32()), "toxic": pa.array([x[2] for x in labels] + [1], pa.int32())}), path / "labels.parquet")
    page = "<html lang='{}'><body><script>var x = 'der die das';</script><p>{}</p></body></html>"
    pages = [(i, f"https://h{i % 3}.example.de/x", page.format("de-DE" if i % 4 else "en", prose(i, 50, ["und", "der", "nicht", "schön"]))) for i in range(20)]
    pages += [(50, None, None), (51, "no address", "<p></p>"), (52, "http://solo/", page.format("en", "the river and the stone")), (52, "http://solo/", page.format("en", "the river and the stone"))]
    pq.write_table(pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()), "url": [p[1] for p in pages], "html": [p[2] for p in pages]}), path / "pages.parquet")
    columns = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    turns = {c: pa.array([r[k] for r in conversation_rows()], t) for k, (c, t) in enumerate(columns.items())}
    turns |= {clash: pa.array(["clash"] * len(turns["turn"])) for clash in ("path", "steps", "depth", "shard", "n_convs")}
    pq.write_table(pa.table(turns), path / "conversations.parquet")
    vectors = {"vec_id": pa.array([r[0] for r in vector_rows()], pa.int64()), "embedding": pa.array([r[1] for r in vector_rows()], pa.list_(pa.float32()))}
    vectors |= {clash: pa.array(["clash"] * len(vectors["vec_id"])) for clash in ("node", "query", "score", "rank", "vector", "ids")}
    pq.write_table(pa.table(vectors), path / "embeddings.parquet")
    return str(path)


TABLES = ("documents", "benchmark", "labels", "pages", "conversations", "embeddings")


@pytest.fixture(scope="session")
def empty_folder(tmp_path_factory, folder):
    path = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        pq.write_table(pq.read_table(f"{folder}/{name}.parquet").slice(0, 0), path / f"{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def con(folder):
    db = duckdb.connect()
    for name in TABLES:
        columns = "doc_id, text, lang, source, n_chars" if name == "documents" else "*"
        db.execute(f"CREATE VIEW {name} AS SELECT {columns} FROM '{folder}/{name}.parquet'")
    return db
