"""Skew-safe exact ranking, quantiles and row-based rolling means.

A ``Window.partitionBy(key)`` puts every row of a key into one task, and the
exact ``percentile`` aggregate merges all distinct values of a group in one
task.  When one key holds a third of the data neither survives.  The
operators here never need a whole group in one place:

1. range-partition on (group, order, tie-break) -- Spark samples the key
   range, so a hot group is spread over many partitions;
2. sort within partitions and stamp partition id + monotonically increasing
   row id, then cut lineage with a reliable checkpoint so the stamps cannot
   change when a lost executor forces recomputation;
3. count rows per (partition, group) -- at most partitions + groups rows --
   and turn the counts into per-block offsets;
4. rank = row id - first row id of the block + block offset + 1.

Everything after step 2 joins on (partition id, group), a key without skew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_PID, _RID, _TIE, _SAME = "__pid", "__rid", "__tie", "__same"
_FIRST, _OFFSET, _BLOCK_N, _GROUP_N = "__first", "__offset", "__block_n", "__group_n"


def _layout(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    num_partitions: int | None,
) -> DataFrame:
    """Step 1: the rows dealt by ranges and sorted, with their tie-break."""
    # Names sort ascending with NULLs last (R's order); Columns keep the
    # direction the caller gave them (e.g. ``F.col(x).desc_nulls_last()``).
    order_exprs = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_cols]
    # Input row ids break ties, so even one repeated (group, value) pair is
    # split across partitions by the range partitioner.
    stamped = df.withColumn(_TIE, F.monotonically_increasing_id())
    sort_keys = [F.col(g).asc_nulls_last() for g in group_cols]
    sort_keys += order_exprs
    sort_keys.append(F.col(_TIE).asc())
    # Without an explicit count AQE may coalesce adjacent ranges (small
    # inputs); merged ranges stay in key order, so the stamps remain valid.
    ranged = (
        stamped.repartitionByRange(num_partitions, *sort_keys)
        if num_partitions
        else stamped.repartitionByRange(*sort_keys)
    )
    return ranged.sortWithinPartitions(*sort_keys).withColumns({_PID: F.spark_partition_id(), _RID: F.monotonically_increasing_id()})


def _continues(group_cols: Sequence[str]):
    """For sorted Arrow batches: whether a row has the group of the row before; NULL for the first one of the task."""

    def equal(x: pa.Array, y: pa.Array) -> pa.Array:
        same = pc.equal(x, y)
        if pa.types.is_floating(x.type):
            same = pc.or_(same, pc.and_(pc.is_nan(x), pc.is_nan(y)))
        return pc.if_else(pc.and_(x.is_null(), y.is_null()), True, pc.fill_null(same, False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.Array] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(g)) for g in group_cols]
            before = [c.slice(0, 1) for c in columns] if last is None else last
            same = pa.array([True] * batch.num_rows)
            for column, first in zip(columns, before, strict=True):
                same = pc.and_(same, equal(column, pa.concat_arrays([first, column.slice(0, batch.num_rows - 1)])))
            if last is None:
                same = pa.concat_arrays([pa.nulls(1, pa.bool_()), same.slice(1)])
            last = [c.slice(batch.num_rows - 1, 1) for c in columns]
            yield pa.record_batch([*batch.columns, same], [*batch.schema.names, _SAME])

    return run


class SortedTable:
    """Rows in (group, order) order, written once below the shared checkpoint folder with an index.

    ``rows`` has the stamps ``__pid`` (range), ``__rid`` (rises in the order of all rows) and
    ``__same`` (the row before, in the same range, has the same group).  ``index`` has a row per range and
    group: first row and count, and from them the rows of the group before and in all.  Ranks,
    repeat marks and group sizes are read from the two; nothing is sorted again.
    """

    def __init__(self, df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], num_partitions: int | None = None):
        self.columns, self.group_cols = df.columns, list(group_cols)
        sorted_rows = _layout(df, self.group_cols, order_cols, num_partitions)
        schema = T.StructType([*sorted_rows.schema.fields, T.StructField(_SAME, T.BooleanType())])
        self.rows = cut_lineage(sorted_rows.mapInArrow(_continues(self.group_cols), schema))

    def _keys_of(self, side: DataFrame, prefix: str):
        return _null_safe(self.rows, side, [_PID, *self.group_cols], prefix)

    @property
    def index(self) -> DataFrame:
        blocks = self.rows.groupBy(_PID, *self.group_cols).agg(
            F.count(F.lit(1)).alias(_BLOCK_N), F.min(_RID).alias(_FIRST)
        )
        # At most (partitions + groups) rows; a hot group has one row per
        # partition it spans, so this window never sees data volume.
        before = Window.partitionBy(*self.group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*self.group_cols)
        return blocks.withColumn(_OFFSET, F.coalesce(F.sum(_BLOCK_N).over(before), F.lit(0))).withColumn(
            _GROUP_N, F.sum(_BLOCK_N).over(whole)
        )

    def ranked(self, rank_col: str, size_col: str | None = None) -> DataFrame:
        """The rows with their exact 1-based number in their group."""
        taken = {rank_col, size_col} & set(self.columns)
        if taken:
            raise ValueError(f"the rows have columns {sorted(taken)} already")
        keys = [_PID, *self.group_cols]
        right = self.index.select(*[F.col(k).alias(f"__b_{k}") for k in keys], _FIRST, _OFFSET, _GROUP_N)
        out = self.rows.join(right, self._keys_of(right, "__b_"), "inner").withColumn(
            rank_col, (F.col(_RID) - F.col(_FIRST) + F.col(_OFFSET) + 1).cast("long")
        )
        if size_col:
            out = out.withColumn(size_col, F.col(_GROUP_N).cast("long"))
        return out.select(*self.columns, rank_col, *([size_col] if size_col else []))

    def mark_repeats(self, flag_col: str) -> DataFrame:
        """The rows with TRUE where their group has an earlier row."""
        group = F.struct(*self.group_cols)
        ends = self.rows.groupBy(_PID).agg(F.max_by(group, _RID).alias("__last"), F.min_by(group, _RID).alias("__head"))
        before = F.lag(F.struct("__last")).over(Window.orderBy(_PID))
        heads = ends.select(F.col(_PID).alias("__p"), (before.isNotNull() & before["__last"].eqNullSafe(F.col("__head"))).alias("__goes_on"))
        joined = self.rows.join(heads, F.col(_PID) == F.col("__p"))
        return joined.select(*self.columns, F.coalesce(_SAME, "__goes_on").alias(flag_col))


def _sorted_blocks(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    num_partitions: int | None,
) -> tuple[DataFrame, DataFrame]:
    """Steps 1-3: stamped rows and the per-block offset table."""
    table = SortedTable(df, group_cols, order_cols, num_partitions)
    return table.rows, table.index


def rank_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    rank_col: str = "rank",
    size_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact 1-based ``row_number()`` per group (all rows when no group).

    Ties in ``order_cols`` are numbered in input order.  ``size_col`` adds the
    number of rows of the row's group.
    """
    return SortedTable(df, group_cols, order_cols, num_partitions).ranked(rank_col, size_col)


def sort_rank(df: DataFrame, order_cols: Sequence[Column | str], rank_col: str = "rn") -> DataFrame:
    """Make a total order visible as a column (global ``row_number``) without a
    single-partition window."""
    return rank_within(df, [], order_cols, rank_col=rank_col)


def _quantile_name(p: float) -> str:
    return f"q_{str(p).replace('.', '_')}"


#: Bins per round of ``exact_quantiles`` and the bin size at which it stops narrowing.
QUANTILE_BINS = 256
QUANTILE_LEAF = 1024


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str):
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return cond


def value_summary(df: DataFrame, group_cols: Sequence[str], value_col: str, weight_col: str | None = None) -> DataFrame:
    """(group, __n, __min, __max) of the values that are neither NULL nor NaN; one partial aggregate."""
    v = F.col(value_col).cast("double")
    present = F.when(~F.isnan(v), v)
    n = F.coalesce(F.sum(F.when(present.isNotNull(), F.col(weight_col))), F.lit(0)) if weight_col else F.count(present)
    return df.groupBy(*group_cols).agg(n.cast("long").alias("__n"), F.min(present).alias("__min"), F.max(present).alias("__max"))


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    summary: DataFrame | None = None,
    weight_col: str | None = None,
    bins: int = QUANTILE_BINS,
    leaf: int = QUANTILE_LEAF,
) -> DataFrame:
    """Type-7 (linear) quantiles per group, exact, NULL and NaN ignored.

    q(p) = x[floor(h)] + (h - floor(h)) * (x[floor(h)+1] - x[floor(h)]),
    h = (n - 1) * p over the sorted non-missing values (0-based) -- the rule
    of Spark's ``percentile`` and DuckDB's ``quantile_cont``.  Groups without
    values get no row; callers left-join the result.

    Distributed selection: nothing is sorted or written but counts.  Each round makes a histogram
    of the ranges that hold a wanted rank (at first a group's whole range) with ``bins``
    bins between their least and largest value; running counts say which bin holds
    the rank, and the bin's own least and largest value are the next range.  A
    range of one value is the answer; of ranges with at most ``leaf`` values the counts of
    their values are made.  All aggregates combine on the map side, so a hot group
    is one row per bin and task.  ``summary``: ``value_summary`` if the caller has it.
    ``weight_col``: how often a row's value occurs (once without it).
    """
    group_cols = list(group_cols)
    names = list(names or [_quantile_name(p) for p in probs])
    v = F.col(value_col).cast("double")
    weight = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    values = df.select(*group_cols, v.alias("__v"), weight.alias("__w")).where(v.isNotNull() & ~F.isnan(v))
    summary = summary if summary is not None else value_summary(df, group_cols, value_col, weight_col)

    # wanted ranks, from 1: floor(h) + 1 and the next one
    h = (F.col("__n") - 1) * F.lit(1.0)
    ranks = []
    for p in probs:
        low = F.floor(h * F.lit(float(p))) + 1
        ranks += [low, F.least(low + 1, F.col("__n"))]
    wanted = summary.where("__n > 0").select(
        *group_cols,
        "__n",
        F.explode(F.array_distinct(F.array(*[r.cast("long") for r in ranks]))).alias("__rank"),
        F.col("__min").alias("__lo"),
        F.col("__max").alias("__hi"),
        F.lit(0).cast("long").alias("__below"),
        F.col("__n").alias("__inside"),
    )
    wanted = cut_lineage(wanted)
    open_range = (F.col("__lo") < F.col("__hi")) & (F.col("__inside") > leaf)
    while not wanted.where(open_range).isEmpty():
        binned = _in_ranges(values, wanted.where(open_range), group_cols).withColumn("__bin", _bin_of(bins))
        counts = binned.groupBy(*group_cols, "__lo", "__bin").agg(
            F.sum("__w").alias("__k"), F.min("__v").alias("__first"), F.max("__v").alias("__last")
        )
        wanted = cut_lineage(wanted.where(~open_range).unionByName(_narrowed(wanted.where(open_range), counts, group_cols, "__bin")))

    # ranges of few values: their counts
    counts = _in_ranges(values, wanted.where("__lo < __hi"), group_cols).groupBy(*group_cols, "__lo", "__v").agg(F.sum("__w").alias("__k"))
    counts = counts.select("*", F.col("__v").alias("__first"), F.col("__v").alias("__last"))
    found = wanted.where("__lo = __hi").unionByName(_narrowed(wanted.where("__lo < __hi"), counts, group_cols, "__v"))

    out = []
    for p, name in zip(probs, names, strict=True):
        pos = h * F.lit(float(p))
        low = F.floor(pos) + 1
        x0 = F.max(F.when(F.col("__rank") == low, F.col("__lo")))
        x1 = F.max(F.when(F.col("__rank") == F.least(low + 1, F.col("__n")), F.col("__lo")))
        out.append((x0 + F.max(pos - F.floor(pos)) * (x1 - x0)).alias(name))
    return found.groupBy(*group_cols).agg(*out)


def _in_ranges(values: DataFrame, wanted: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The values in the ranges of ``wanted``.  Ranges of a group are equal or disjoint, so a value is in
    one at most; the join side has a few numbers per group and range."""
    ranges = wanted.select(*[F.col(g).alias(f"__r_{g}") for g in group_cols], "__lo", "__hi").distinct()
    cond = _null_safe(values, ranges, group_cols, "__r_") & F.col("__v").between(F.col("__lo"), F.col("__hi"))
    return values.join(ranges, cond, "inner").select(*[values[g] for g in group_cols], "__v", "__w", "__lo", "__hi")


def _bin_of(bins: int):
    """Rises with the value: the least is in bin 0, the largest in the last.  Halves, so that the
    width is finite; among infinite limits all finite values share one bin."""
    share = (F.col("__v") / 2 - F.col("__lo") / 2) / (F.col("__hi") / 2 - F.col("__lo") / 2)
    inner = F.when(F.isnan(share), F.lit(bins // 2)).otherwise(F.least(F.floor(share * (bins - 1)), F.lit(bins - 2))).cast("int")
    return F.when(F.col("__v") == F.col("__hi"), bins - 1).when(F.col("__v") == F.col("__lo"), 0).otherwise(inner)


def _narrowed(wanted: DataFrame, counts: DataFrame, group_cols: Sequence[str], order: str) -> DataFrame:
    """``wanted`` with the range of the part that holds its rank; a range has few parts."""
    until = Window.partitionBy(*group_cols, "__lo").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = counts.withColumn("__until", F.sum("__k").over(until)).select(
        *[F.col(g).alias(f"__p_{g}") for g in group_cols], F.col("__lo").alias("__p_lo"), "__first", "__last", "__k", "__until"
    )
    place = F.col("__rank") - F.col("__below")
    cond = _null_safe(wanted, parts, group_cols, "__p_") & (F.col("__lo") == F.col("__p_lo"))
    cond = cond & (place > F.col("__until") - F.col("__k")) & (place <= F.col("__until"))
    return wanted.join(parts, cond, "inner").select(
        *[wanted[g] for g in group_cols],
        "__n",
        "__rank",
        F.col("__first").alias("__lo"),
        F.col("__last").alias("__hi"),
        (F.col("__below") + F.col("__until") - F.col("__k")).alias("__below"),
        F.col("__k").alias("__inside"),
    )


#: Rows of a group that one window task takes in ``rolling_mean_rows``.
BLOCK_ROWS = 1 << 16


def rolling_mean_rows(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    value_col: str,
    windows: dict[str, int],
    num_partitions: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Right-aligned rolling mean over the last ``k`` rows, NULL until ``k``
    rows exist and NULL when a value inside the window is missing.

    ``windows`` maps output column -> k.  Ranks cut each group into blocks of ``block_rows``
    rows; a block also gets the last k - 1 rows of the one before (its halo, the only
    rows that are copied) and a plain row frame runs inside it, so that a group of any size
    is dealt to many tasks.
    """
    group_cols = list(group_cols)
    kmax = max(windows.values())
    block_rows = max(block_rows, kmax)
    ranked = rank_within(df, group_cols, [order_col], rank_col="__pos", num_partitions=num_partitions)
    place = F.pmod(F.col("__pos") - 1, F.lit(block_rows))
    own = F.floor((F.col("__pos") - 1) / block_rows).cast("long")
    is_halo = place >= block_rows - (kmax - 1)
    both = F.when(is_halo, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    blocks = ranked.select("*", F.explode(both).alias("__halo")).withColumn("__block", own + F.col("__halo").cast("long"))
    out = blocks
    for name, k in windows.items():
        frame = Window.partitionBy(*group_cols, "__block").orderBy("__pos").rowsBetween(-(k - 1), 0)
        full = (F.count(F.lit(1)).over(frame) == k) & (F.count(F.col(value_col)).over(frame) == k)
        out = out.withColumn(name, F.when(full, F.avg(F.col(value_col).cast("double")).over(frame)))
    return out.where(~F.col("__halo")).drop("__pos", "__halo", "__block")


def mark_repeats(
    df: DataFrame,
    id_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    flag_col: str = "is_duplicate",
) -> DataFrame:
    """W-02: TRUE on every occurrence of an id except the first (R ``duplicated``).

    The rows are dealt once, by ranges of (id, order).  In this layout a row repeats
    its id when the row before has the same one, which the sorting task sees itself; only a
    partition's first row waits for the last id of the partitions before, a table of one row per
    partition however many ids there are.
    """
    return SortedTable(df, id_cols, order_cols).mark_repeats(flag_col)
