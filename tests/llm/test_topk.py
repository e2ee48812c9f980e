"""Exact top-k search against brute force: ties, copies, more groups than components, several blocks, whole 64-bit scores."""

import math
import random

import pytest
from conftest import vector_rows

from weftline.llm import topk


def brute(rows, k=5, every=50):
    usable = []
    for r, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((r, i, [math.floor(256 * x) for x in v]))
    out = []
    for r, i, v in usable:
        if i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for s, j, w in usable if s != r)
            out += [(i, rank, j, -score) for rank, (score, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return sorted(tuple(r) for r in topk.nearest(df, **options).collect())


@pytest.mark.parametrize("groups", [1, 2, 3, 20])
def test_groups(spark, groups):
    assert found(spark, vector_rows(), groups=groups) == brute(vector_rows())


def test_blocks_and_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 300)
    monkeypatch.setattr(topk, "CELLS", 5)
    assert found(spark, vector_rows(), every=20) == brute(vector_rows(), every=20)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [-1.0, -3.0])]
    assert found(spark, rows) == brute(rows) and len(brute(rows)) == 4
    assert found(spark, [(0, [1.0])]) == [] and found(spark, [(1, [1.0])]) == []


def test_many_copies_and_ties(spark):
    """Copies of a query's vector and copies of a better one; every score ties."""
    rows = [(i, [0.25, 0.5, 0.0]) for i in range(120)] + [(1000 + i, [0.5, 1.0, 0.0]) for i in range(40)] + [(2000 + i, [0.0, 0.0, i / 64]) for i in range(40)]
    random.Random(1).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_scores_beyond_doubles(spark):
    rows = [(i, [(2.0**20 + i) / 1, 2.0**21 - i * 3]) for i in range(60)]
    assert found(spark, rows) == brute(rows) and brute(rows)[0][3] > 2**53
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [2.0**40]), (1, [2.0**40])])
