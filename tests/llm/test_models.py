"""Toxicity and language against right answers: plain sums, held-out rows, pages of known language."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from weftline.llm import language, toxicity


def test_scores_are_the_plain_pairwise_sum():
    rng = np.random.default_rng(5)
    words = [f"word{k}" for k in range(40)]
    terms = np.sort(np.array(sorted(set().union(*(toxicity.buckets(w.encode()) for w in words))), np.int64))
    machine = toxicity.FactorizationMachine(terms, -0.3, rng.normal(0, 0.5, len(terms)), rng.normal(0, 0.3, (len(terms), toxicity.FACTORS)))
    texts = [" ".join(rng.choice(words, rng.integers(0, 12))) + " unknown" for _ in range(30)] + ["", "word1 word1 WORD1"]
    place = {t: k for k, t in enumerate(terms.tolist())}
    for text, score in zip(texts, machine.scores(t.encode() for t in texts)):
        ids = sorted(place[t] for t in toxicity.buckets(text.encode()) if t in place)
        z = machine.bias + sum(machine.weights[i] for i in ids)
        z += sum(float(machine.factors[i] @ machine.factors[j]) for n, i in enumerate(ids) for j in ids[n + 1 :])
        assert score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)
    assert machine.scores([b"word1"])[0] == machine.scores([b"word1 word1 WORD1"])[0]


def auc(scores, labels):
    pos, neg = ([s for s, y in zip(scores, labels) if y == want] for want in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_held_out_rows_of_an_interaction(spark):
    """Toxic is an insult together with a group; either alone is harmless, so additive weights alone cannot rank these rows."""
    rng = random.Random(3)
    filler = [f"plain{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(1_600):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(filler, 8) + ["vermin"] * insult + ["folk"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = {i: y for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert auc([got[i] for i in held], list(held.values())) > 0.97
    assert sum((got[i] >= 0.5) == y for i, y in held.items()) > 0.93 * len(held)


GERMAN, ENGLISH = "der die und nicht ist wir haben ein schöner tag im wald über".split(), "the and not is we have a nice day in the woods over".split()


def page(words, tag=""):
    return f"<html{f' lang={tag}' if tag else ''}><body><script>var the = 1;</script><p>{' '.join(words)}</p></body></html>"


def pages():
    rng = random.Random(8)
    text = lambda words, n: [rng.choice(words) for _ in range(n)]
    rows = [(k, f"https://www.wald{k % 4}.de/{k}", page(text(GERMAN, 60), "de")) for k in range(40)]
    rows += [(100 + k, f"https://www.woods{k % 4}.uk/{k}", page(text(ENGLISH, 60), "en")) for k in range(40)]
    rows += [(200, "https://www.wald1.de/empty", page([])), (201, "https://www.woods1.uk/empty", page([]))]
    rows += [(202, "https://new.example.org/", page([], "de")), (203, "https://new.example.org/x", page([], "en"))]
    rows += [(204, "https://other.de/", page([])), (205, "https://www.wald2.de/english", page(text(ENGLISH, 200), "de"))]
    return rows


def documents():
    rng = random.Random(9)
    return [(k, " ".join(rng.choice(GERMAN if k % 2 else ENGLISH) for _ in range(50)), "de" if k % 2 else "en") for k in range(60)]


@pytest.fixture(scope="module")
def found(spark):
    got = language.identified(spark.createDataFrame(pages(), "page_id long, url string, html string"), spark.createDataFrame(documents(), "doc_id long, text string, lang string"))
    return {r.page_id: r for r in got.collect()}


def test_pages_of_known_language(found):
    assert all(found[k].lang == "de" and found[100 + k].lang == "en" for k in range(40))
    assert (found[200].lang, found[201].lang) == ("de", "en")  # only the address speaks
    assert (found[202].lang, found[203].lang) == ("de", "en")  # only the tag speaks
    assert found[204].lang == "de" and found[205].lang == "en"  # the suffix alone; much text against tag, suffix and host
    assert found[200].probability < found[0].probability


def test_posterior_is_the_plain_product(found):
    """Counts, smoothing and fusion computed again page by page."""
    counts = {lang: np.zeros(language.GRAMS) for lang in ("de", "en")}
    for _, text, lang in documents():
        np.add.at(counts[lang], language.grams(text.encode()), 1)
    logs = {lang: np.log((c + 0.1) / (c + 0.1).sum()) for lang, c in counts.items()}
    rows = {}
    for k, url, html in pages():
        host = re.match(r"https://([^/]*)", url)[1]
        grams = language.grams(language.page_text(html.encode()))
        text = [float(logs[x][grams].mean() * min(len(grams), language.STRENGTH) / 3) if len(grams) else 0.0 for x in ("de", "en")]
        tag = (re.search(r"lang=(\w\w)", html) or ["", ""])[1]
        rows[k] = (text, int(text[1] > text[0]), host, ".".join(host.split(".")[-2:]), tag, host.split(".")[-1])
    total = Counter(r[1] for r in rows.values())
    group = {c: defaultdict(Counter) for c in range(2, 6)}
    for r in rows.values():
        for c in range(2, 6):
            if r[c]:
                group[c][r[c]][r[1]] += 1
    for k, r in rows.items():
        fused = []
        for lang in (0, 1):
            p = (total[lang] + 1) / (len(rows) + 2)
            for c in (3, 2):
                others = group[c][r[c]][lang] - (r[1] == lang)
                p = (others + language.PRIOR_PAGES * p) / (sum(group[c][r[c]].values()) - 1 + language.PRIOR_PAGES)
            z = r[0][lang] + math.log(p)
            for c in (4, 5):
                if r[c]:
                    of = sum(g[lang] for g in group[c].values())
                    z += math.log((group[c][r[c]][lang] + 1) / (of + len(group[c]) + 1))
            fused.append(z)
        best = int(fused[1] > fused[0])
        assert found[k].lang == ("de", "en")[best], k
        assert found[k].probability == pytest.approx(1 / (1 + math.exp(fused[1 - best] - fused[best])), rel=1e-4), k
