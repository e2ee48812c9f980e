"""Every dealt query over odd rows, against SQL or against brute force."""

import math
import random
import re
import time
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest

from weftline.llm import context_tree, decontaminate, jaccard, licenses, lines, quality, substrings, toxicity
from weftline.llm.queries import ORACLES, QUERIES
from weftline.llm.sql import quality_parts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK, PLAIN = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def documents(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert bag(df.collect()) == bag(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).count() == 0


def test_licenses(spark, folder, con):
    got = bag((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in QUERIES["op2_license_scan"](spark, folder).collect())
    want = []
    for doc_id, text in documents(con):
        words = re.findall(PLAIN, (text or "").translate(LOWER))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        want.append((doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    assert got == bag(want)
    assert len(licenses.rules()) > 200


def test_license_priority_and_containment(spark):
    texts = ["code under cc by nc sa 4.0 here", "SPDX-License-Identifier: Apache-2.0", "mit dem Wagen, gnu lesser general public license version 3", None]
    rows = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [r.labels for r in rows] == ["cc-by-nc,cc-by-nc-sa", "apache-2", "lgpl", ""]
    assert [[d.start for d in r.detections] for r in rows] == [[2], [0], [3], []]
    assert all(0 <= r.score <= 1 for r in rows)


def test_automaton_blocks_agree(spark, folder, monkeypatch):
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    whole = bag(decontaminate.spans(docs, items).select("doc_id", "n_words", "hit_runs", "items").collect())
    assert whole == bag(decontaminate.spans(docs, items, block_words=10).select("doc_id", "n_words", "hit_runs", "items").collect())


def brute_classes(rows):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(BLANK, (text or "").translate(LOWER))
        grams = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        sets.setdefault(doc_id, []).append(grams)
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and any(100 * len(s & t) >= 80 * len(s | t) > 0 for s in sets[i] for t in sets[j]):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else top(i)) for i, each in sets.items() for s in each]


def brute_links(rows):
    """Row by row the number of other sets, of rows with an id, that are similar to the row's set."""
    sets = []
    for doc_id, text in rows:
        words = re.findall(BLANK, (text or "").translate(LOWER))
        sets.append((doc_id, frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()))
    known = {s for i, s in sets if i is not None and s}
    links = {s: sum(t != s and 100 * len(s & t) >= 80 * len(s | t) for t in known) for s in known}
    return [(i, len(s), None if i is None else links.get(s, 0)) for i, s in sets]


def test_jaccard_join(spark, folder, con):
    got = QUERIES["op9_ngram_jaccard_join"](spark, folder).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == bag(brute_classes(documents(con)))
    assert bag((r.doc_id, r.n_shingles, r.n_links) for r in got) == bag(brute_links(documents(con)))


def test_links_of_a_large_group(spark):
    """Many members of one first set with edits from a small pool: pairs that their counts leave open, linked or not by edits that
    both have, and edits that nearly all have."""
    rng = random.Random(5)
    base = [f"w{j}" for j in range(90)]
    rows = [(0, " ".join(base))]
    for member in range(1, 160):
        words = list(base)
        if member % 4:
            words[88] = "common"
        for at in rng.sample([5, 17, 29, 41, 53, 65, 77], rng.choice([1, 2, 2, 3])):
            words[at] = rng.choice(["x", "y", f"own{member}"])
        rows.append((member, " ".join(words)))
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))[0].collect()
    assert bag((r.doc_id, r.n_shingles, r.n_links) for r in got) == bag(brute_links(rows))
    assert 0 < sum(r.n_links for r in got) < 160 * 159


def test_every_link_counts(spark):
    """Groups with members at all distances around the threshold, over several first sets; four texts that are all similar."""
    rng = random.Random(12)
    rows = [(k, " ".join(f"a{j}" for j in range(100)) + f" end{k}") for k in range(4)]
    for group in range(12):
        base = [f"g{group}w{j}" for j in range(rng.choice([9, 40, 120, 400]))]
        for member in range(rng.randint(3, 14)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8]) * max(1, len(base) // 100)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 2)] = [f"n{rng.randrange(6)}"] * rng.randint(0, 2)
            rows.append((1000 * group + 1000 + 20 * member + rng.randrange(20), " ".join(words)))
    rng.shuffle(rows)
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))[0].collect()
    assert bag((r.doc_id, r.n_shingles, r.n_links) for r in got) == bag(brute_links(rows))
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == bag(brute_classes(rows))
    assert [r.n_links for r in got if r.doc_id in (0, 1, 2, 3)] == [3] * 4 and len({r.n_links for r in got}) > 3


def test_cover_holds_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def brute_lines(rows):
    """(doc_id, text) -> removed line numbers, by comparing with the first holder of each line and of each shortest block."""
    docs = []
    for doc_id, text in {(d, t or "") for d, t in rows}:
        seen, keys = Counter(), []
        for number, line in enumerate(text.translate(LOWER).split("\n")):
            if words := tuple(line.encode().split()):
                keys.append((number, (words, seen[words]), len(words)))
                seen[words] += 1
        docs.append((doc_id, text, keys))
    first_text, holder, gone = {}, {}, {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first_text[text] = min(doc_id, first_text.get(text, doc_id))
    single = [d for d in docs if d[0] is not None and first_text[d[1]] == d[0]]
    at = {}
    for doc_id, text, keys in single:
        for place, (_, key, _) in enumerate(keys):
            at[doc_id, text, key] = place
        for key in marks(keys):
            holder.setdefault(key, []).append((doc_id, text))
    for doc_id, text, keys in docs:
        total = sum(n for _, _, n in keys)
        if doc_id is not None and first_text[text] < doc_id:
            gone[doc_id, text] = [k for k, _, _ in keys] if total >= lines.BLOCK_WORDS else []
            continue
        out = set()
        partners = {min(holder[key]) for key in marks(keys) if doc_id is not None and min(h[0] for h in holder[key]) < doc_id}
        for p in partners:
            shared = [(place, at[(*p, key)]) for place, (_, key, _) in enumerate(keys) if (*p, key) in at]
            chain = longest(shared)
            for run in runs(chain):
                if sum(keys[x][2] for x, _ in run) >= lines.BLOCK_WORDS:
                    out |= {keys[x][0] for x, _ in run}
        gone[doc_id, text] = sorted(out)
    return gone


def marks(keys):
    """The lines, and the runs of lines that lose their block when cut at the far end."""
    out = {key for _, key, _ in keys}
    size = lambda i, j: sum(n for _, _, n in keys[i:j])
    for i in range(len(keys)):
        for j in range(i + 2, min(len(keys), i + lines.BLOCK_WORDS) + 1):
            if size(i, j) >= lines.BLOCK_WORDS and min(size(i, j - 1), size(i + 1, j)) < lines.BLOCK_WORDS:
                out.add(tuple(key for _, key, _ in keys[i:j]))
    return out


def longest(pairs):
    """Longest rising series, by the same tie rule as patience piles."""
    tops, at, back = [], [], []
    for i, (_, there) in enumerate(pairs):
        k = bisect_left(tops, there)
        tops[k : k + 1], at[k : k + 1] = [there], [i]
        back.append(at[k - 1] if k else None)
    out, i = [], at[-1] if at else None
    while i is not None:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def runs(chain):
    out = []
    for x in chain:
        if out and x == (out[-1][-1][0] + 1, out[-1][-1][1] + 1):
            out[-1].append(x)
        else:
            out.append([x])
    return out


def test_line_dedup(spark, folder, con):
    rows = documents(con)
    gone = brute_lines(rows)
    assert sum(map(bool, gone.values())) > 10
    got = bag((r.doc_id, r.n_removed_lines, r.removed) for r in QUERIES["op1_line_dedup"](spark, folder).collect())
    assert got == bag((d, len(gone[d, t or ""]), gone[d, t or ""]) for d, t in rows)


def test_block_of_a_later_holder(spark):
    """Lines that other documents hold first, one each, make a block only with a document that is the first holder of none."""
    one, two = (" ".join(f"{c}{k}" for k in range(12)) for c in "ab")
    rows = [(1, f"{one}\nx"), (2, f"y\n{two}"), (3, f"p\n{one}\n{two}"), (4, f"q\n{one}\n{two}\nr"), (5, f"{two}\n{one}")]
    got = lines.common_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.removed for r in got} == {1: [], 2: [], 3: [], 4: [1, 2], 5: []}


def shared_runs(earlier, later):
    """Places of ``later`` in any run of lines with 20 words that ``earlier`` holds as it is."""
    out = set()
    for i in range(len(later)):
        for j in range(len(earlier)):
            n = 0
            while i + n < len(later) and j + n < len(earlier) and later[i + n] == earlier[j + n]:
                n += 1
            if sum(len(x.split()) for x in later[i : i + n]) >= lines.BLOCK_WORDS:
                out |= set(range(i, i + n))
    return sorted(out)


def test_block_whose_lines_occur_before(spark):
    """Lines of the shared passage stand alone in both documents too, also in the passage itself."""
    rng = random.Random(4)
    rows, want = [], {}
    for case in range(40):
        passage = [" ".join(f"p{case}x{rng.randrange(5)}y{k}" for k in range(rng.randint(4, 19))) for _ in range(rng.randint(3, 9))]
        passage += [passage[0], passage[-1]] * (case % 3 == 0)
        alone = lambda side: [x for k in range(rng.randint(0, 6)) for x in (rng.choice(passage[1:]), f"{side}{case} {k}")]
        earlier, later = (["top " + side, *alone(side), *passage, *alone(side + "z")] for side in ("e", "l"))
        rows += [(2 * case, "\n".join(earlier)), (2 * case + 1, "\n".join(later))]
        want |= {2 * case: [], 2 * case + 1: shared_runs(earlier, later)}
    one, two, three = (" ".join(f"{c}{k}" for k in range(n)) for c, n in (("r", 19), ("s", 15), ("t", 19)))
    rows += [(100, f"{one}\n{two}\n{three}"), (101, f"x\n{two}\ny\n{one}\n{two}\n{three}")]
    rows += [(102, f"{three}\n{three}\nz\n{one}\n{two}"), (103, f"{two}\n{three}\nw\n{one}\n{two}")]
    want |= {100: [], 101: [3, 4, 5], 102: [3, 4], 103: [0, 1, 3, 4]}
    got = lines.common_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.removed for r in got} == want
    assert sum(map(bool, want.values())) > 30


@pytest.mark.parametrize("case", ["reversed", "equal", "shuffled"])
def test_work_on_a_pair_grows_with_its_lines(case):
    """Blocks in another order, and lines that are all equal, are found in one alignment and one pass."""
    words = [4] * 10_500
    place = list(range(len(words)))
    there = {
        "reversed": [b * 7 + k for b in reversed(range(1_500)) for k in range(7)],
        "equal": [0] * 30,
        "shuffled": [b * 7 + k for b in np.random.default_rng(2).permutation(1_500) for k in range(7)],
    }[case]
    here = [0] * len(place) if case == "equal" else place
    start = time.time()
    assert lines.blocks(dict(enumerate(here)), dict(enumerate(there)), words) == place
    assert time.time() - start < 10


def test_block_that_most_texts_hold(spark):
    """With production parameters: a line and a run of 20 words or more in over 1,000 texts and over half of them."""
    line, one, two = (" ".join(f"{c}{k}" for k in range(n)) for c, n in (("l", 24), ("m", 12), ("n", 12)))
    rows = [(i, f"a{i}\n{line}\nb{i}" if i % 2 else f"{one}\n{two}\nc{i}") for i in range(2_400)] + [(i, f"d{i}\n{line}\n{one}\n{two}") for i in range(2_400, 2_600)]
    got = {r.doc_id: r.removed for r in lines.common_blocks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: ([] if i < 2 else [1] if i % 2 else [0, 1]) if i < 2_400 else [1, 2, 3] for i in range(2_600)}


def test_every_line_of_a_block_is_in_a_run():
    rng = np.random.default_rng(3)
    for _ in range(50):
        words = rng.integers(1, 30, rng.integers(0, 12)).tolist()
        covered = {k for i, j in lines.block_runs(words) for k in range(i, j)} | {k for k, n in enumerate(words) if n >= lines.BLOCK_WORDS}
        assert covered == (set(range(len(words))) if sum(words) >= lines.BLOCK_WORDS else set())
        assert all(sum(words[i:j]) >= lines.BLOCK_WORDS for i, j in lines.block_runs(words))


def test_toxicity_learns_pairs():
    """An insult and a group word are harmless alone; additive weights cannot tell the pair."""
    rng = np.random.default_rng(1)
    x = (rng.random((600, 6)) < 0.5).astype(float)
    y = x[:, 0] * x[:, 1]
    bias, weights, factors = toxicity._fit(x, y)
    machine = toxicity.FactorizationMachine(np.arange(6), bias, weights, factors)
    score = lambda ids: 1 / (1 + math.exp(-(bias + weights[ids].sum() + 0.5 * ((factors[ids].sum(0) ** 2).sum() - (factors[ids] ** 2).sum()))))
    assert score([0, 1]) > 0.9 and score([0]) < 0.1 and score([1]) < 0.1 and score([]) < 0.1
    assert 0 <= machine.scores([b""])[0] <= 1


def test_toxicity_rows(spark, folder, con):
    got = QUERIES["op4_toxicity"](spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in documents(con))
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_language_of_pages(spark, folder):
    got = {r.page_id: r for r in QUERIES["op8_language_id"](spark, folder).collect()}
    assert len(got) == 23 and got[50].host == "" and got[0].host == "h0.example.de" and got[0].suffix == "de"
    assert got[1].declared == "de" and all(0 < r.probability <= 1 for r in got.values())


def brute_tree(train, texts, depth):
    """log10 probabilities by the recursive definition; contexts that training has not seen predict as their parent."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def each(body):
        padded = bytes(depth) + body + b"\0"
        for i in range(depth, len(padded)):
            for k in range(8):
                yield padded[i - depth : i], (1 << k) | (padded[i] >> (8 - k)), (padded[i] >> (7 - k)) & 1

    for body in train:
        for context, earlier, bit in each(body):
            for d in range(depth + 1):
                counts[context[depth - d :], earlier][bit] += 1
                if d < depth:
                    children[context[depth - d :], earlier].add((context[depth - d - 1 :], earlier))
    memo = {}

    def own(n):
        a, b = counts[n]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(n):
        if n not in memo:
            memo[n] = own(n) if len(n[0]) == depth else np.logaddexp(own(n), sum(weighted(c) for c in children[n])) - math.log(2)
        return memo[n]

    out = []
    for body in texts:
        total = 0.0
        for context, earlier, bit in each(body):
            p, deeper = 0.5, False
            for d in range(depth, -1, -1):
                n = (context[depth - d :], earlier)
                if n in counts:
                    a, b = counts[n]
                    stop = math.exp(own(n) - math.log(2) - weighted(n)) if deeper and d < depth else 1.0
                    p, deeper = stop * (b + 0.5) / (a + b + 1) + (1 - stop) * p, True
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def test_context_tree(spark, con, folder):
    rows = [(i, t) for i, t in documents(con) if not t or len(t) < 700][:25]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.score) for r in context_tree.scored(df, depth=3).collect()]
    low = [(t or "").translate(LOWER).encode() for _, t in rows]
    train = [b for (i, _), b in zip(rows, low) if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1]
    want = [(i, s) for (i, _), s in zip(rows, brute_tree(train, low, 3))]
    assert [i for i, _ in sorted(got, key=repr)] == [i for i, _ in sorted(want, key=repr)]
    ours, theirs = {i: s for i, s in got if i}, {i: s for i, s in want if i}
    assert all(ours[i] == pytest.approx(theirs[i], rel=1e-5) for i in theirs)


@pytest.mark.parametrize("held", [0, 20, 1_000_000])
def test_context_tree_of_any_size(spark, con, monkeypatch, held):
    """Limits of what scoring holds do not reach the scores: every node counts, also of windows that are joined."""
    monkeypatch.setattr(context_tree, "MODEL_NODES", 50, raising=False)
    monkeypatch.setattr(context_tree, "MODEL_WINDOWS", held)
    rows = [(i, t) for i, t in documents(con) if i is not None and (not t or len(t) < 700)][:25] + [(900, "quite other zebras"), (900, "quite other zebras")]
    got = sorted(tuple(r) for r in context_tree.scored(spark.createDataFrame(rows, "doc_id long, text string"), depth=3).select("doc_id", "n_tokens", "score").collect())
    low = [(t or "").translate(LOWER).encode() for _, t in rows]
    train = [b for (i, _), b in zip(rows, low) if zlib.crc32(str(i).encode()) % 5 != 1]
    assert 0 < len(train) < len(rows)
    want = sorted((i, len(b.split()) + 1, s) for (i, _), b, s in zip(rows, low, brute_tree(train, low, 3)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-7)


@pytest.mark.parametrize("top", [0, 200_000])
def test_word_model(spark, folder, con, monkeypatch, top):
    monkeypatch.setattr(context_tree, "TOP_WORDS", top)
    rows = documents(con)
    tokens = [re.findall(BLANK, (t or "").translate(LOWER)) + [""] for _, t in rows]
    c = Counter()
    for (i, _), w in zip(rows, tokens):
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            c.update(w)
    n, v = sum(c.values()), len(c)
    want = [(i, len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for (i, _), w in zip(rows, tokens)]
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in QUERIES["op10_context_tree_scores"](spark, folder).collect()]
    assert bag(got) == bag(want)


def test_boilerplate_lines(spark):
    rows = [(i, "h" if i % 2 else None, f"Shared  LINE of the host\nown text {i} {i + 1}") for i in range(20)] + [(99, "h", "shared line of the host")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.n_removed_words, r.clean_text) for r in quality.judged(docs, min_docs=5, share=0.5).collect()}
    assert got[3] == (5, "own text 3 4") and got[2] == (5, "own text 2 3") and got[99] == (5, "")
    assert jaccard.one_per_class(docs).count() == 21


def test_boilerplate_with_production_parameters(spark):
    """Lines are removed and documents depleted in hosts of any size, as the SQL says; the pipeline stage does the same."""
    long = " ".join(f"long{k}" for k in range(300))
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, "Shared LINE of the host\n" + own(i) + (f"\n{long}" if i < 105 else ""), "en", "h", 1) for i in range(150)]
    rows += [(i, "shared line of the host\n" + own(i), "en", "small", 1) for i in range(200, 203)]
    rows += [(i, ("rare line of the host\n" if i < 305 else "") + (f"{long}\n" if i < 302 else "") + own(i), "en", "wide", 1) for i in range(300, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.n_removed_words, r.kept, r.clean_text) for r in quality.judged(docs).collect()}
    db = duckdb.connect()
    db.register("rows", docs.toArrow())
    want = db.execute(f"WITH {quality_parts('rows')} SELECT doc_id, n_removed_words, kept, clean_text FROM judged").fetchall()
    assert got == {d: tuple(x) for d, *x in want}
    assert got[0] == (305, False, own(0)) and got[140] == (5, True, own(140)) and got[200] == (5, True, own(200))
    assert got[300] == (0, True, rows[153][1]) and got[304] == (0, True, rows[157][1])  # two texts, and 5 of 100 texts
    stage = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert stage == {d: text for d, (_, kept, text) in got.items() if kept}
