"""Chains of accepted rows: the first row of a group is accepted, and then always the first one that does not come before the end
of the last accepted one.

Rate limits whose window opens with the first hit are such chains, and leases that only the first writer gets. Which row is accepted
depends on the rows before it. A group of normal size is one ordered fold over Arrow batches with one small state. In a group that
is too large for one task every row links to the row that would be accepted next, which is a lookup by range, and the links
are followed from the first row on by pointer doubling: after k joins of the links with themselves the first 2**k accepted rows
are known. No task walks the group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.operators.ordered import OrderedGroups, join_same
from weftline.plans.slicing import SLICE
from weftline.session import cut_lineage

#: Columns that ``chain`` adds: place of the row in its group from 1, place and ``at`` of the accepted row that covers it.
PLACE, FIRST, START = "__n", "__first", "__start"


def chain(rows: DataFrame, keys: Sequence[str], at: str, tiebreak: str, until: str, limit: int | None = None) -> DataFrame:
    """Every row with ``__n``, ``__first`` and ``__start``; it is accepted where ``__n`` equals ``__first``.

    ``at`` and ``until`` are whole numbers that are never null; rows are ordered by (at, tiebreak), which must be unique in a
    group. Null keys form a group. A row whose ``until`` does not lie after its ``at`` covers itself alone.
    """
    # A text identity, so that a missing key forms a group like any other in the fold.
    identity = F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("none")) for k in keys])
    placed = rows.withColumn("__g", identity)
    groups = OrderedGroups(placed, ["__g"], [at, tiebreak], limit)
    if not groups.large:
        return _folded(placed, at, tiebreak, until).drop("__g")
    small = _folded(groups.where(F.col(SLICE) == 0).df, at, tiebreak, until)
    return small.unionByName(_doubled(groups.where(F.col(SLICE) > 0), at, until, limit)).drop("__g")


def spans(at: np.ndarray, until: np.ndarray, reach: int | None, end: int | None) -> np.ndarray:
    """For rows in order, the index of the accepted row that covers each; -1 while the row before them, which ends at ``end``,
    still does. ``reach`` is the largest end of any row before."""
    n = len(at)
    out = np.empty(n, np.int64)
    furthest = np.maximum.accumulate(until)
    before = np.concatenate(([-(2**63) if reach is None else reach], np.maximum(furthest[:-1], -(2**63) if reach is None else reach)))
    # A row that no row before it could cover is accepted whatever went before.
    fresh = np.flatnonzero(at >= before)
    edges = np.concatenate(([0], fresh[fresh > 0], [n]))
    out[edges[:-1]] = edges[:-1]
    for a, b in zip(edges[:-1][np.diff(edges) > 1].tolist(), edges[1:][np.diff(edges) > 1].tolist()):
        i = a
        if a == 0 and end is not None and at[0] < end:
            i = int(np.searchsorted(at[:b], end, side="left"))
            out[:i] = -1
        while i < b:
            j = max(i + 1, int(np.searchsorted(at[:b], until[i], side="left")))
            out[i:j] = i
            i = j
    if n and end is not None and at[0] < end and out[0] == 0:
        out[0] = -1
    return out


def _folded(rows: DataFrame, at: str, tiebreak: str, until: str) -> DataFrame:
    """One exchange and one pass: rows sorted by group, with one open row and a place as state between batches."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, reach, end, first, start = None, 0, None, None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            times, ends = (batch.column(c).to_numpy() for c in (at, until))
            group = batch.column("__g").to_numpy(zero_copy_only=False)
            added = np.empty((3, len(times)), np.int64)
            edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(times)]
            for a, b in zip(edges, edges[1:]):
                if group[a] != current:
                    current, place, reach, end = group[a], 0, None, None
                covered = spans(times[a:b], ends[a:b], reach, end)
                own = covered >= 0
                added[0, a:b] = np.arange(place + 1, place + 1 + b - a)
                added[1, a:b] = np.where(own, covered + place + 1, first)
                added[2, a:b] = np.where(own, times[a:b][covered], start)
                first, start = int(added[1, b - 1]), int(added[2, b - 1])
                end = int(ends[a:b][covered[-1]]) if own[-1] else end
                reach = max(int(ends[a:b].max()), ends[a] if reach is None else reach)
                place += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, added)], names=[*batch.schema.names, PLACE, FIRST, START])

    ordered = rows.repartition("__g").sortWithinPartitions("__g", at, tiebreak)
    return ordered.mapInArrow(run, f"{schema}, {PLACE} long, {FIRST} long, {START} long")


def _doubled(groups: OrderedGroups, at: str, until: str, limit: int | None) -> DataFrame:
    """The same for groups in slices, by joins."""
    numbered = groups.number(PLACE).stored()
    accepted = marked(numbered.sliced.select("__g", F.col(at).alias("at"), F.col(until).alias("until"), PLACE), limit)
    flagged = join_same(numbered.sliced, accepted.withColumn("__mark", F.lit(True)), ["__g", PLACE], "left")
    of = lambda c: F.when(F.col("__mark"), F.col(c))
    # Places and times rise with the order, so the largest accepted one so far is the last one.
    return numbered.over(flagged).running({FIRST: ("max", of(PLACE)), START: ("max", of(at))}).df.drop("__mark")


def marked(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """(__g, __n) of the accepted rows, from (__g, at, until, __n)."""
    hits = rows.select("__g", F.col("at").alias("moment"), F.lit(0).alias("kind"), F.col(PLACE).alias("who"), F.col(PLACE).alias("next"))
    # What a row looks for lies after itself, also when it covers nothing.
    end = F.greatest("until", F.col("at"))
    probes = rows.select("__g", end.alias("moment"), F.lit(1).alias("kind"), F.col(PLACE).alias("who"), F.lit(None).cast("long").alias("next"))
    found = OrderedGroups(cut_lineage(hits.unionByName(probes)), ["__g"], ["-moment", "kind", "who"], limit).running({"to": ("min", "next")})
    links = found.df.where((F.col("kind") == 1) & F.col("to").isNotNull()).select("__g", F.col("who").alias(PLACE), F.greatest("to", F.col("who") + 1).alias("to"))
    jump = cut_lineage(join_same(links, rows.groupBy("__g").agg(F.max(PLACE).alias("__last")), ["__g"]).where(F.col("to") <= F.col("__last")).drop("__last"))
    done = cut_lineage(rows.groupBy("__g").agg(F.min(PLACE).alias(PLACE)))
    while True:
        more = cut_lineage(done.join(jump, ["__g", PLACE]).select("__g", F.col("to").alias(PLACE)))
        if not more.limit(1).count():
            return done
        done = cut_lineage(done.unionByName(more))
        further = jump.select("__g", F.col(PLACE).alias("to"), F.col("to").alias("__far"))
        jump = cut_lineage(jump.join(further, ["__g", "to"]).select("__g", PLACE, F.col("__far").alias("to")))
