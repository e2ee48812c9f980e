"""Leaderboards: members ordered by score, ties by member name.

The reversed board reverses the ties too, so the order from the top is score descending, then member descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.operators.ordered import OrderedGroups, join_same


def scores(points: DataFrame, member: str, points_column: Column, boards: Sequence[str] = ()) -> DataFrame:
    """Total score per member (and board)."""
    return points.groupBy(*boards, member).agg(F.sum(points_column).alias("score"))


def bump(board: DataFrame, deltas: DataFrame, member: str, boards: Sequence[str] = ()) -> DataFrame:
    """Scores after adding deltas ``(member, score)``; an unknown member starts at 0."""
    names = [*boards, member]
    both = board.select(*names, "score").unionByName(deltas.select(*names, "score"))
    return both.groupBy(*names).agg(F.sum("score").alias("score"))


def top(board: DataFrame, member: str, n: int) -> DataFrame:
    """The ``n`` best members with their rank from 0."""
    return _ranked(board, [F.desc("score"), F.desc(member)], n)


def bottom(board: DataFrame, member: str, n: int) -> DataFrame:
    """The ``n`` lowest members with their rank from 0, counted from the bottom."""
    return _ranked(board, [F.asc("score"), F.asc(member)], n)


def _ranked(board: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows are found per task first; only they are numbered."""
    return board.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long") - 1)


def score_range(board: DataFrame, low, high) -> DataFrame:
    """Members with ``low`` <= score <= ``high``."""
    return board.where(F.col("score").between(low, high))


def ranks(board: DataFrame, member: str, boards: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Every member with ``rank_from_top`` and ``rank_from_bottom``, both counted from 0."""
    ordered = OrderedGroups(board, list(boards), ["-score", f"-{member}"], limit).number("rank_from_top", start=0).df
    if boards:
        sizes = board.groupBy(*boards).agg(F.count(F.lit(1)).alias("__n"))
        ordered, total = join_same(ordered, sizes, boards), F.col("__n")
    else:
        total = board.agg(F.count(F.lit(1))).scalar()
    return ordered.withColumn("rank_from_bottom", total - 1 - F.col("rank_from_top")).drop("__n")


def lookup(ranked: DataFrame, wanted: DataFrame, member: str) -> DataFrame:
    """Rank and score of the wanted members; an unknown member gives no row."""
    return ranked.join(wanted.select(member).distinct(), member, "left_semi")


def around(ranked: DataFrame, wanted: DataFrame, member: str, radius: int, boards: Sequence[str] = ()) -> DataFrame:
    """For each wanted member, the members at most ``radius`` ranks away, with ``center`` naming the wanted one.

    The ranks wanted are listed and joined by equality; ranks before the first do not exist and drop out.
    """
    r = F.col("rank_from_top")
    centers = lookup(ranked, wanted, member).select(
        *boards, F.col(member).alias("center"), F.explode(F.sequence(r - radius, r + radius)).alias("rank_from_top")
    )
    return join_same(centers, ranked, [*boards, "rank_from_top"])
