"""Equi-joins with R's NULL rules.

dplyr joins match NA with NA; Spark's ``=`` does not, so key comparisons use
``<=>`` (still planned as hash / sort-merge equi-joins).

No broadcast hints: Catalyst's size estimate from the files decides against
``spark.sql.autoBroadcastJoinThreshold``, and AQE decides again with the bytes
that a derived lookup really has.  Beyond the threshold the join is a shuffle
join, and AQE's skew join splits hot keys on the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str] | None = None,
    how: str = "left",
    columns: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Join on (possibly differently named) keys; right keys are dropped.

    ``columns`` restricts the right side to those columns (projection
    before the join).
    """
    left_on = list(left_on)
    right_on = list(right_on or left_on)
    keep = list(columns) if columns is not None else [c for c in right.columns if c not in right_on]
    tmp = [f"__rk{i}" for i in range(len(right_on))]
    r = right.select(*[F.col(k).alias(t) for k, t in zip(right_on, tmp)], *keep)
    cond = None
    for lk, t in zip(left_on, tmp):
        c = left[lk].eqNullSafe(r[t]) if null_safe else left[lk] == r[t]
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("right", "full", "outer"):
        # keys of unmatched right rows survive in the left key columns
        out = out.withColumns({lk: F.coalesce(F.col(lk), F.col(t)) for lk, t in zip(left_on, tmp)})
    return out.drop(*tmp) if how not in ("left_semi", "left_anti") else out


def natural_join(
    left: DataFrame,
    right: DataFrame,
    how: str = "left",
    null_safe: bool = True,
) -> DataFrame:
    """J-03: join on every common column name (dplyr's default ``by``)."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural join: no common columns")
    return keyed_join(left, right, common, how=how, null_safe=null_safe)


def add_parameter_metadata(
    df: DataFrame,
    lookup_para: DataFrame,
    parameters: DataFrame | None = None,
    name_col: str = "VariableName_org",
) -> DataFrame:
    """J-04: keep rows whose name maps to a ``para_id`` (inner join).

    The lookup first gets the parameter table by a natural join (J-03).
    Fails when the lookup has no usable row (Q-I / Q-10).
    """
    # written, so that its size is known when the join is planned: a small one moves no row of ``df``
    lookup = cut_lineage(lookup_para.where(F.col("para_id").isNotNull()))
    if lookup.isEmpty():
        raise ValueError("no parameters defined in the lookup table")
    if parameters is not None:
        lookup = cut_lineage(natural_join(lookup, parameters))
    return keyed_join(df, lookup, [name_col], how="inner").where(F.col("para_id").isNotNull())


def map_or_template(
    df: DataFrame, lookup_para: DataFrame | None, parameters: DataFrame | None = None, name_col: str = "VariableName_org"
) -> tuple[DataFrame, DataFrame]:
    """J-03 / J-04 / K-06 in one scan: (rows whose name maps to a ``para_id``, template of the other names).

    The rows are joined and written once; both results read that table.  A missing or
    empty lookup maps nothing, and the template then has every name.
    """
    if lookup_para is None:
        kind = df.schema[name_col].dataType
        lookup_para = df.sparkSession.range(0).select(F.lit(None).cast(kind).alias(name_col), F.lit(None).cast("int").alias("para_id"))
    lookup = lookup_para.where(F.col("para_id").isNotNull())
    if parameters is not None:
        lookup = natural_join(lookup, parameters)
    joined = cut_lineage(keyed_join(df, lookup, [name_col]))
    mapped = joined.where(F.col("para_id").isNotNull())
    return mapped, unmapped_template(joined.where(F.col("para_id").isNull()), name_col)


def unmapped_template(df: DataFrame, name_col: str = "VariableName_org") -> DataFrame:
    """K-06 / O-04: distinct names with an empty ``para_id`` to fill in."""
    return (
        df.select(F.col(name_col).cast("string").alias(name_col))
        .distinct()
        .withColumn("para_id", F.lit(None).cast("string"))
    )


def add_site_metadata(
    df: DataFrame, sites: DataFrame, site_col: str = "site_id", site_key: str = "interne_nr"
) -> DataFrame:
    """J-05: left join sites on the numeric site id (both sides as DOUBLE)."""
    s = sites.withColumnRenamed(site_key, site_col).withColumn(site_col, F.col(site_col).cast("double"))
    d = df.withColumn(site_col, F.col(site_col).cast("double"))
    return keyed_join(d, s, [site_col])


def unseen(candidates: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """J-13 / U-04: distinct candidate keys not present in ``seen``."""
    seen_key = seen_key or key
    c = candidates.select(key).distinct()
    s = seen.select(F.col(seen_key).alias(key)).distinct()
    return c.join(s, c[key].eqNullSafe(s[key]), "left_anti")
