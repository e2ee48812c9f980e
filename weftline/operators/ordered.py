"""Ordered analytics per group that stay correct and parallel when one group holds a large share of the rows.

``OrderedGroups`` is the entry point. While all groups are of normal size it emits the plain Spark window, one shuffle
on the key. When a group is too large for one task its rows are cut into ordered slices (see ``plans.slicing``); each
slice is processed on its own and receives a small carry (running aggregates) or a few neighbouring rows (lag, lead and
short ROWS frames). Both ways give the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from weftline.plans.slicing import SLICE, By, slice_groups, sort_columns
from weftline.session import cut_lineage

_FOLD = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
FAN = 1024  # slices, or groups of slices, whose totals one task scans
SMALL_SLICES = 20_000  # a table with a row per slice is broadcast up to here


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "min":
        return F.least(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    return F.coalesce(carried + local, carried, local)


def join_same(rows: DataFrame, table: DataFrame, names: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on equally named columns where NULL equals NULL, keeping one copy of them.

    ``small`` is for a table whose size is bounded by construction; it is then broadcast. Otherwise Catalyst and AQE
    decide from the measured size, and AQE splits a key that many rows share.
    """
    renamed = table.withColumnsRenamed({n: f"__j_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__j_{n}")) for n in names])
    return rows.join(F.broadcast(renamed) if small else renamed, on, how).drop(*[f"__j_{n}" for n in names])


def earlier_totals(table: DataFrame, keys: Sequence[str], place: str, columns: dict[str, str], places: int) -> DataFrame:
    """``table`` has one row per (keys, place), places being numbers up to ``places``; each of ``columns`` (with its kind: sum, count,
    min or max) becomes the total over the smaller places of the same keys.

    With more than ``FAN`` places these are summed in groups of so many, the group totals are scanned in the same way, and each
    group is scanned on its own, so the work of a task stays bounded and the number of levels is a logarithm.
    """
    if places <= FAN:
        before = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumns({c: _MERGE[kind](c).over(before) for c, kind in columns.items()})
    part = f"{place}_"
    parted = cut_lineage(table.withColumn(part, F.floor(F.col(place) / FAN)))
    sums = parted.groupBy(*keys, part).agg(*[_MERGE[kind](c).alias(f"__up{c}") for c, kind in columns.items()])
    above = earlier_totals(sums, keys, part, {f"__up{c}": kind for c, kind in columns.items()}, places // FAN + 1)
    before = Window.partitionBy(*keys, part).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = parted.withColumns({c: _MERGE[kind](c).over(before) for c, kind in columns.items()})
    joined = join_same(local, above, [*keys, part], "left")
    merged = {c: _combine(kind, F.col(f"__up{c}"), F.col(c)) for c, kind in columns.items()}
    return joined.withColumns(merged).select(table.columns)


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and sorted by ``order`` within each group.

    ``order`` takes column names, ``-name`` for descending, or ``By`` entries. Row-wise methods (``number``, ``running``
    with ``peers=False``, ``neighbours``) need an order that is unique within a group, so end it with a unique column.
    No ``keys`` means the whole table is one group; it is then always sliced, never moved to one task.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[By | str], limit: int | None = None):
        self.keys, self.order, self.limit = list(keys), sort_columns(order), limit
        least = 1 if keys else df.sparkSession.sparkContext.defaultParallelism
        sliced = slice_groups(df, self.keys, self.order, limit, min_slices=least)
        self._rows, self._large, self._slices = sliced.df, sliced.large, sliced.slices

    def where(self, condition: Column) -> OrderedGroups:
        """Only some of the groups, cut into the same slices. The condition must hold for whole groups or whole slices."""
        return self._with(self._rows.where(condition))

    def stored(self) -> OrderedGroups:
        """The same rows, written once and read by whatever follows."""
        return self._with(cut_lineage(self._rows))

    def over(self, rows: DataFrame) -> OrderedGroups:
        """The same groups and slices over ``sliced`` rows that got more columns."""
        return self._with(rows)

    def _with(self, rows: DataFrame) -> OrderedGroups:
        other = object.__new__(OrderedGroups)
        other.__dict__.update(self.__dict__, _rows=rows)
        return other

    @property
    def df(self) -> DataFrame:
        return self._rows.drop(SLICE)

    @property
    def sliced(self) -> DataFrame:
        """The rows with their ``__slice`` column, 0 for groups that were not cut."""
        return self._rows

    @property
    def large(self) -> bool:
        """Whether any group was cut."""
        return self._large

    def with_columns(self, columns: dict[str, Column]) -> OrderedGroups:
        return self._with(self._rows.withColumns(columns))

    def _window(self, *more: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *more).orderBy(*[entry.column() for entry in self.order])

    # -- running aggregates ------------------------------------------------------------------------------------------

    def running(self, columns: dict[str, tuple[str, str | Column]], peers: bool = False) -> OrderedGroups:
        """Add running aggregates ``{out: (kind, value)}`` with kind sum, count, min, max or avg.

        ``peers=False`` is ROWS UNBOUNDED PRECEDING; ``peers=True`` is the SQL default RANGE frame, where rows with an
        equal order value share one result.
        """
        parts: dict[str, tuple[str, Column]] = {}
        for out, (kind, value) in columns.items():
            value = F.col(value) if isinstance(value, str) else value
            if kind == "avg":
                parts[f"__s_{out}"], parts[f"__n_{out}"] = ("sum", value), ("count", value)
            else:
                parts[out] = (kind, value)
        if peers and self._large:
            done = self._running_by_value(parts)
        else:
            done = self._running_rows(parts, peers)
        averages = {
            out: F.col(f"__s_{out}").cast("double") / F.when(F.col(f"__n_{out}") > 0, F.col(f"__n_{out}"))
            for out, (kind, _) in columns.items()
            if kind == "avg"
        }
        helpers = [n for n in parts if n not in columns]
        return self._with(done.withColumns(averages).drop(*helpers) if averages else done)

    def _running_rows(self, parts: dict[str, tuple[str, Column]], peers: bool) -> DataFrame:
        more = [SLICE] if self._large else []
        frame = self._window(*more)
        frame = frame if peers else frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = self._rows.withColumns({out: _FOLD[kind](value).over(frame) for out, (kind, value) in parts.items()})
        if not self._large:
            return local
        totals = (
            self._rows.where(F.col(SLICE) > 0)
            .groupBy(*self.keys, SLICE)
            .agg(*[_FOLD[kind](value).alias(f"__c_{out}") for out, (kind, value) in parts.items()])
        )
        kinds = {f"__c_{out}": kind for out, (kind, _) in parts.items()}
        carry = earlier_totals(totals, self.keys, SLICE, kinds, self._slices)
        # One row per slice of a large group.
        joined = join_same(local, carry, [*self.keys, SLICE], "left", small=self._slices <= SMALL_SLICES)
        return joined.withColumns(
            {out: _combine(kind, F.col(f"__c_{out}"), F.col(out)) for out, (kind, _) in parts.items()}
        ).drop(*[f"__c_{out}" for out in parts])

    def _running_by_value(self, parts: dict[str, tuple[str, Column]]) -> DataFrame:
        """Peers share a result, so it is enough to run over one row per distinct order value."""
        names = [*self.keys, *dict.fromkeys(e.name for e in self.order)]
        per_value = self._rows.groupBy(*names).agg(
            *[_FOLD[kind](value).alias(out) for out, (kind, value) in parts.items()]
        )
        groups = OrderedGroups(per_value, self.keys, self.order, self.limit)
        merged = groups.running({f"__r_{out}": (_over_partials(kind), out) for out, (kind, _) in parts.items()}).df
        merged = merged.drop(*parts).withColumnsRenamed({f"__r_{out}": out for out in parts})
        return join_same(self._rows, merged, names)

    # -- positions ---------------------------------------------------------------------------------------------------

    def number(self, out: str, start: int = 1) -> OrderedGroups:
        """ROW_NUMBER as a bigint, counted from ``start``."""
        if not self._large:
            position = F.row_number().over(self._window()).cast("long")
            return self._with(self._rows.withColumn(out, position + (start - 1)))
        done = self.running({out: ("count", F.lit(1))})
        return done if start == 1 else done._with(done._rows.withColumn(out, F.col(out) + (start - 1)))

    def rank(self, rank: str | None = None, dense: str | None = None) -> OrderedGroups:
        """RANK (gaps after ties) and DENSE_RANK (no gaps) as bigints."""
        if not self._large:
            w = self._window()
            columns = {rank: F.rank().over(w).cast("long")} if rank else {}
            columns |= {dense: F.dense_rank().over(w).cast("long")} if dense else {}
            return self._with(self._rows.withColumns(columns))
        names = [*self.keys, *dict.fromkeys(e.name for e in self.order)]
        per_value = self._rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__ties"))
        groups = OrderedGroups(per_value, self.keys, self.order, self.limit)
        table = groups.running({"__upto": ("sum", "__ties"), "__values": ("count", F.lit(1))}).df
        columns = {rank: F.col("__upto") - F.col("__ties") + 1} if rank else {}
        columns |= {dense: F.col("__values")} if dense else {}
        table = table.withColumns(columns).drop("__ties", "__upto", "__values")
        return self._with(join_same(self._rows, table, names))

    # -- neighbouring rows -------------------------------------------------------------------------------------------

    def neighbours(
        self, columns: dict[str, Callable[[WindowSpec], Column]], before: int = 0, after: int = 0
    ) -> OrderedGroups:
        """Add columns that look at most ``before`` rows back and ``after`` rows ahead.

        Each entry maps the ordered window to a column, for instance ``lambda w: F.lag("x").over(w)`` or
        ``lambda w: F.avg("x").over(w.rowsBetween(-2, 0))``.
        """
        if not self._large:
            w = self._window()
            return self._with(self._rows.withColumns({out: make(w) for out, make in columns.items()}))
        rows = self._rows.withColumn("__own", F.lit(True))
        if before:
            rows = rows.unionByName(self._borrowed(before, earlier=True))
        if after:
            rows = rows.unionByName(self._borrowed(after, earlier=False))
        w = self._window(SLICE)
        done = rows.withColumns({out: make(w) for out, make in columns.items()})
        return self._with(done.where("__own").drop("__own"))

    def _borrowed(self, n: int, earlier: bool) -> DataFrame:
        """For each slice, copies of the ``n`` rows of the same group that lie just before (or after) the slice."""
        outward = [e.reversed() for e in self.order] if earlier else self.order
        edge = Window.partitionBy(*self.keys, SLICE).orderBy(*[e.column() for e in outward])
        names = self._rows.columns
        place = F.col("__place") if not earlier else -F.col("__place")
        edges = (
            self._rows.where(F.col(SLICE) > 0)
            .withColumn("__place", F.row_number().over(edge))
            .where(F.col("__place") <= n)
            .groupBy(*self.keys, SLICE)
            .agg(F.array_sort(F.collect_list(F.struct(place.alias("__at"), *names))).alias("__edge"))
        )
        # Every slice listed here has a row, so n listed slices hold at least the n nearest rows.
        by_slice = Window.partitionBy(*self.keys).orderBy(SLICE)
        near = by_slice.rowsBetween(-n, -1) if earlier else by_slice.rowsBetween(1, n)
        reach = F.flatten(F.collect_list("__edge").over(near))
        reach = F.reverse(F.slice(F.reverse(reach), 1, n)) if earlier else F.slice(reach, 1, n)
        copies = edges.withColumn("__reach", reach).select(
            F.col(SLICE).alias("__to"), F.explode("__reach").alias("__row")
        )
        fields = [F.col(f"__row.{c}").alias(c) for c in names if c != SLICE]
        return copies.select(*fields, F.col("__to").alias(SLICE), F.lit(False).alias("__own"))


def _over_partials(kind: str) -> str:
    return "sum" if kind == "count" else kind


def sessionize(
    df: DataFrame, keys: Sequence[str], time: str, tiebreak: str, gap: Column, out: str = "session_no",
    limit: int | None = None,
) -> DataFrame:
    """Number sessions per key from 1; a row starts a session when it comes more than ``gap`` after the row before."""
    previous = {"__before": lambda w: F.lag(time).over(w)}
    groups = OrderedGroups(df, keys, [time, tiebreak], limit).neighbours(previous, before=1)
    opens = F.col("__before").isNull() | (F.col(time) > F.col("__before") + gap)
    return groups.running({out: ("sum", opens.cast("long"))}).df.drop("__before")


def range_totals(
    df: DataFrame, keys: Sequence[str], at: str, width: int, columns: dict[str, tuple[str, str | Column]],
    limit: int | None = None,
) -> DataFrame:
    """Sums and counts over RANGE BETWEEN ``width`` PRECEDING AND CURRENT ROW on the integer column ``at``.

    ``columns`` maps outputs to ``("sum", value)`` or ``("count", value)``; sums of floating point numbers are refused, as
    they would depend on the order of addition. Rows without ``at`` are the frame of each other. For a
    large group the frame becomes a difference of running totals: each value is added at ``at`` and taken back at
    ``at + width + 1``, so no group is held in one task and no row meets all rows of its frame.
    """
    keys = list(keys)
    values = {o: (k, F.col(v) if isinstance(v, str) else v) for o, (k, v) in columns.items()}
    summed = df.select(*[value.alias(out) for out, (kind, value) in values.items() if kind == "sum"]).dtypes
    if inexact := [out for out, kind in summed if kind in ("float", "double")]:
        raise TypeError(f"give integers or decimals to sum: {inexact}")
    groups = OrderedGroups(df, keys, [at], limit)
    if not groups.large:
        w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-width, 0)
        return df.withColumns({out: _FOLD[kind](value).over(w) for out, (kind, value) in values.items()})
    peers = df.where(F.col(at).isNull()).groupBy(*keys, at).agg(*[_FOLD[k](v).alias(o) for o, (k, v) in values.items()])
    per_time = df.where(F.col(at).isNotNull()).groupBy(*keys, at).agg(
        *[_FOLD[kind](value).alias(out) for out, (kind, value) in values.items()],
        *[F.count(value).alias(f"__n_{out}") for out, (_, value) in values.items()],
    )
    amounts = [*values, *[f"__n_{out}" for out in values]]
    leave = per_time.withColumns({at: F.col(at) + (width + 1), **{c: -F.col(c) for c in amounts}})
    steps = per_time.unionByName(leave).groupBy(*keys, at).agg(*[F.sum(c).alias(c) for c in amounts])
    totals = OrderedGroups(steps, keys, [at], limit).running({f"__r_{c}": ("sum", c) for c in amounts}).df
    totals = totals.select(
        *keys,
        at,
        *[
            (F.col(f"__r_{out}") if kind == "count" else F.when(F.col(f"__r___n_{out}") > 0, F.col(f"__r_{out}"))).alias(
                out
            )
            for out, (kind, _) in values.items()
        ],
    )
    return join_same(df, totals.unionByName(peers), [*keys, at])


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Stamp group aggregates on every row.

    Aggregate first, then join: the partial aggregation absorbs a hot key, and the joined side has one row per key, so
    Catalyst broadcasts it while it is below the threshold and AQE splits the hot key otherwise.
    """
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_same(df, table, keys)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[By | str], n: int, out: str = "rn") -> DataFrame:
    """The first ``n`` rows per group with their position.

    Spark limits each group to ``n`` rows before the shuffle (``WindowGroupLimit``), so a hot group shrinks on the map
    side and needs no slicing.
    """
    w = Window.partitionBy(*keys).orderBy(*[e.column() for e in sort_columns(order)])
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n).withColumn(out, F.col(out).cast("long"))


def top_per_group_with_ties(
    df: DataFrame, keys: Sequence[str], order: Sequence[By | str], n: int, out: str = "rk"
) -> DataFrame:
    """All rows with RANK <= ``n``.

    The ranks up to ``n`` are fixed by the first ``n`` rows alone, so find those (limited on the map side), keep one row
    per distinct order value, and join every row that has such a value. Any number of ties stays distributed.
    """
    entries = sort_columns(order)
    names = [*keys, *[e.name for e in entries]]
    first = top_per_group(df.select(*names), keys, order, n, "__rn")
    ranks = first.groupBy(*names).agg(F.min("__rn").alias(out))
    return join_same(df, ranks, names)
