"""The prefix trie against brute force, with many shards, long paths and chunks of ids."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from conftest import conversation_rows

from weftline.llm import prefixes


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(first, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path)))
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(sums[k][0] for k in kids[node]) or 1
        sums[node] = leaves, (len(members[node]) - 1) * words + sum(sums[k][1] for k in kids[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in m if n == len(node)))
        parent = min(members[node[:-1]])[0] if node else None
        out.append((min(m)[0], len(node), parent, len(m), len(kids[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shards, turns, chunk", [(1, 64, 32_000), (5, 64, 32_000), (60, 64, 20), (60, 1, 1), (60, 2, 50)])
def test_any_number_of_shards(spark, monkeypatch, shards, turns, chunk):
    """Copies of one conversation and its first turns stand in many shards; short splitters leave the rest to one."""
    monkeypatch.setattr(prefixes, "SPLITTER_TURNS", turns)
    monkeypatch.setattr(prefixes, "CHUNK", chunk)
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = sorted((tuple(r) for r in prefixes.prefix_trie(df, shards=shards).collect()), key=repr)
    assert got == brute(rows)
    assert max(r[3] for r in got if r[1] == 4) >= 25


def test_splitters_are_paths_of_the_skeleton():
    a, b, c = (bytes([k]) * 16 + (5).to_bytes(4, "big") for k in range(3))
    s = prefixes.Skeleton([(a + b, 1), (a + b, 9), (a + c, 2), (b, 3)])
    assert len(s.parent) == 5 and s.parent == [-1, 0, 1, 1, 0] and s.depth == [0, 1, 2, 2, 1] and s.words[1:] == [5] * 4
