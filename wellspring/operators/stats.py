"""Aggregations, windows and sorts.

Decomposable aggregates (count, sum, min, max, avg) run as partial + final
hash aggregates, so a hot group is pre-aggregated on every map task before
the shuffle.  Order statistics and row-based windows use the skew-safe
ranking of ``ranking.py`` instead of whole-group windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import keyed_join
from .ranking import exact_quantiles, mark_repeats, rolling_mean_rows, sort_rank

__all__ = [
    "measurement_stats",
    "value_counts",
    "merged_counts",
    "stats_of_counts",
    "overall_period",
    "period_of",
    "daily_totals",
    "rolling_means",
    "yearly_mean",
    "sampling_stats",
    "count_by",
    "distinct_rows",
    "count_distinct_by",
    "joined_distinct_text",
    "duplicate_ids",
    "mark_repeats",
    "latest_rows",
    "sort_rank",
]


def measurement_stats(
    df: DataFrame,
    keys: Sequence[str] = ("sensor_id", "parameter"),
    time_col: str = "datum_uhrzeit",
    value_col: str = "messwert",
    approximate: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """A-01: per key first/last time, min, q10, mean, median, q90, max, rows.

    Quantiles skip NULL/NaN, the row count does not (Q-14).  Exact quantiles
    by default; ``approximate=True`` uses ``percentile_approx`` (one pass,
    bounded memory per group).
    """
    keys = list(keys)
    v = F.col(value_col)
    clean = df.withColumn(value_col, F.when(~F.isnan(v), v))
    base = clean.groupBy(*keys).agg(
        F.min(time_col).alias("datetime_min"),
        F.max(time_col).alias("datetime_max"),
        F.min(value_col).alias("min"),
        F.avg(value_col).alias("mean"),
        F.max(value_col).alias("max"),
        F.count(F.lit(1)).alias("number_of_samples"),
        F.count(value_col).alias("__n"),
    )
    if approximate:
        q = clean.groupBy(*keys).agg(
            F.percentile_approx(value_col, [0.1, 0.5, 0.9], accuracy).alias("__q")
        ).select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(("q10", "median", "q90"))])
    else:
        # one row per key, written: the quantiles start from its counts, least and largest values
        base = cut_lineage(base)
        summary = base.select(*keys, "__n", F.col("min").cast("double").alias("__min"), F.col("max").cast("double").alias("__max"))
        q = exact_quantiles(clean, keys, value_col, [0.1, 0.5, 0.9], ["q10", "median", "q90"], summary)
    cond = None
    for k in keys:
        c = base[k].eqNullSafe(q[k])
        cond = c if cond is None else cond & c
    joined = base.join(q, cond, "left")
    return joined.select(
        *[base[k] for k in keys],
        "datetime_min",
        "datetime_max",
        "min",
        "q10",
        "mean",
        "median",
        "q90",
        "max",
        "number_of_samples",
    )


def value_counts(df: DataFrame, keys: Sequence[str] = ("sensor_id", "parameter"), time_col: str = "datum_uhrzeit", value_col: str = "messwert") -> DataFrame:
    """(keys, value, n, first, last): the measurements as counts of their values (NaN as NULL).  Counts of several
    parts of the data add up to those of all (``merged_counts``), so they are a state that
    statistics, quantiles among them, can be kept from."""
    clean = df.withColumn(value_col, F.when(~F.isnan(value_col), F.col(value_col)))
    return clean.groupBy(*keys, value_col).agg(
        F.count(F.lit(1)).alias("n"), F.min(time_col).alias("first"), F.max(time_col).alias("last")
    )


def merged_counts(parts: DataFrame, keys: Sequence[str] = ("sensor_id", "parameter"), value_col: str = "messwert") -> DataFrame:
    return parts.groupBy(*keys, value_col).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def stats_of_counts(counts: DataFrame, keys: Sequence[str] = ("sensor_id", "parameter"), value_col: str = "messwert") -> DataFrame:
    """A-01 from ``value_counts``: the same columns as ``measurement_stats``, exact."""
    keys, v, n = list(keys), F.col(value_col), F.col("n")
    present = F.when(v.isNotNull(), n)
    base = cut_lineage(
        counts.groupBy(*keys).agg(
            F.min("first").alias("datetime_min"),
            F.max("last").alias("datetime_max"),
            F.min(v).alias("min"),
            (F.sum(v * n) / F.sum(present)).alias("mean"),
            F.max(v).alias("max"),
            F.sum(n).alias("number_of_samples"),
            F.coalesce(F.sum(present), F.lit(0)).alias("__n"),
        )
    )
    summary = base.select(*keys, "__n", F.col("min").cast("double").alias("__min"), F.col("max").cast("double").alias("__max"))
    q = exact_quantiles(counts, keys, value_col, [0.1, 0.5, 0.9], ["q10", "median", "q90"], summary, "n")
    out = keyed_join(base, q, keys)
    return out.select(*keys, "datetime_min", "datetime_max", "min", "q10", "mean", "median", "q90", "max", "number_of_samples")


def overall_period(stats: DataFrame) -> DataFrame:
    """A-02: covered period and total samples of a stats table."""
    return stats.agg(
        F.min("datetime_min").alias("datetime_min"),
        F.max("datetime_max").alias("datetime_max"),
        F.sum("number_of_samples").alias("number_of_samples"),
    )


def period_of(df: DataFrame, time_col: str = "datum_uhrzeit") -> DataFrame:
    """A-02 straight from the measurements: one aggregate, no quantiles."""
    return df.agg(
        F.min(time_col).alias("datetime_min"),
        F.max(time_col).alias("datetime_max"),
        F.count(F.lit(1)).alias("number_of_samples"),
    )


def daily_totals(
    df: DataFrame,
    date_col: str,
    well_col: str,
    value_col: str,
    levels: str = "both",
) -> DataFrame:
    """A-03: per day (and well) row count and volume sum (empty sum -> 0).

    ``levels='both'`` computes well and field rows in one aggregate with
    GROUPING SETS; ``is_field`` tells the field row from a NULL well.
    """
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(value_col), F.lit(0.0)).alias("volume"),
    ]
    if levels == "well":
        return df.groupBy(date_col, well_col).agg(*aggs)
    if levels == "field":
        return df.groupBy(date_col).agg(*aggs)
    out = df.groupingSets([[date_col, well_col], [date_col]], date_col, well_col).agg(
        *aggs, F.grouping_id().alias("__gid")
    )
    return out.withColumn("is_field", F.col("__gid") == 1).drop("__gid")


def rolling_means(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    value_col: str,
    windows: dict[str, int] | None = None,
) -> DataFrame:
    """W-01: right-aligned rolling means over 7 and 10 rows (default)."""
    return rolling_mean_rows(df, group_cols, order_col, value_col, windows or {"roll_7": 7, "roll_10": 10})


def yearly_mean(
    df: DataFrame, keys: Sequence[str], date_col: str, value_col: str, out_col: str = "mean_value"
) -> DataFrame:
    """A-04 / H-15: mean per keys and calendar year."""
    return df.groupBy(*keys, F.year(date_col).alias("year")).agg(F.avg(value_col).alias(out_col))


def sampling_stats(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """A-05: first/last sample date, span in days, count and the mean
    sampling interval ``round_half_even(span / count)``."""
    return (
        df.groupBy(*keys)
        .agg(
            F.min(F.to_date(date_col)).alias("date_min"),
            F.max(F.to_date(date_col)).alias("date_max"),
            F.count(F.lit(1)).alias("number_of_samples"),
        )
        .withColumn("period_days", F.datediff("date_max", "date_min"))
        .withColumn(
            "mean_sampling_interval_days",
            F.bround(F.col("period_days") / F.col("number_of_samples"), 0).cast("double"),
        )
    )


def count_by(df: DataFrame, keys: Sequence[str], out_col: str = "n") -> DataFrame:
    """A-06: rows per key (NULL keys form a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_col))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A-07."""
    return df.select(*cols).distinct()


def count_distinct_by(df: DataFrame, keys: Sequence[str], col: str, out_col: str) -> DataFrame:
    """A-08: two-phase distinct (distinct pairs, then count) keeps a hot key
    from building one large set in one task."""
    pairs = df.select(*keys, col).distinct()
    return pairs.groupBy(*keys).agg(F.count(col).alias(out_col))  # 0 for a group of NULLs


def joined_distinct_text(df: DataFrame, keys: Sequence[str], col: str, out_col: str, sep: str = ", ") -> DataFrame:
    """A-09: sorted distinct values joined as text (a label, e.g. the units
    of one parameter -- bounded by the value domain, not by row count)."""
    pairs = df.select(*keys, col).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(col)), sep).alias(out_col))


def duplicate_ids(df: DataFrame, id_cols: Sequence[str], out_col: str = "n") -> DataFrame:
    """A-11 / Q-A: ids that occur more than once, with their count."""
    return count_by(df, id_cols, out_col).where(F.col(out_col) > 1)


def latest_rows(df: DataFrame, col: str) -> DataFrame:
    """S-13 / W-03: rows with the maximum of ``col`` (ties kept).

    The maximum is a one-row aggregate (partial max on every task); joining
    a single row is a broadcast of proven size.
    """
    top = df.agg(F.max(col).alias("__max"))
    return df.join(F.broadcast(top), F.col(col) == F.col("__max"), "inner").drop("__max")
