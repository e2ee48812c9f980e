"""Spelling variants against brute force: words of every length, ties, chains of forms, deletions by hash."""

import random
import re
import zlib
from collections import Counter

import pytest

from weftline.llm import spelling


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, ratio=10):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    others = {w: sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: o[0] if o and n[o[0]] >= ratio * n[w] else None for w, o in others.items()}
    root = {}
    for w in n:
        root[w] = w
        while form[root[w]]:
            root[w] = form[root[w]]
    return sorted((w, n[w], len(others[w]), form[w] or "", n.get(form[w], 0), root[w]) for w in n)


def rows_of(rng, letters):
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(40)]
    words = []
    for w in base:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(4):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            words += [v] * rng.choice([2, 3, 40])
    rng.shuffle(words)
    return [(k, " ".join(words[k * 50 : k * 50 + 50])) for k in range(len(words) // 50 + 1)]


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdeé"), (3, "aàÿZ×")])
def test_all_near_words(spark, seed, letters):
    rng = random.Random(seed)
    rows = rows_of(rng, letters) + [(None, "Zebraaa zebraaa, ZEBRAAA"), (None, None), (7, ""), (8, "aaaaaaaa " * 3 + "aaaaaaa " * 40)]
    rows += [rows[0]] * 2
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in got) == brute(rows)
    assert sum(r.form is not None for r in got) > 5 and any(r.form and r.root != r.form for r in got)


def test_words_longer_than_the_trie(spark):
    """Around the limit, and far beyond it, in one direction and in the other."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 9, 10, 60, 3000)]
    words = [v for w in base for v in (w, w[1:], w[:-1], w + "x", "x" + w, w[:4] + "z" + w[5:], w[:4] + "y" + w[5:], w[:-1] + "q") if len(v) >= 7]
    rows = [(k, f"{w} {w} " * (1 + 10 * (k % 3 == 0))) for k, w in enumerate(words)]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), longest=8).collect()
    assert sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in got) == brute(rows)
    assert any(len(r.word) > 2000 and r.n_near for r in got)
