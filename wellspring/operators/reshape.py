"""Long/wide reshaping and unions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name_col: str = "parameter",
    value_col: str = "messwert",
    value_type: str | None = None,
) -> DataFrame:
    """R-01 ``pivot_longer``: NULL values are kept (unlike SQL UNPIVOT).

    Values of different types are cast to ``value_type`` (default: the
    common type when all agree, else string) before unpivoting.
    """
    values = list(values)
    types = {df.schema[v].dataType for v in values}
    target = value_type or (next(iter(types)).simpleString() if len(types) == 1 else "string")
    cast = df.select(*ids, *[F.col(v).cast(target).alias(v) for v in values])
    return cast.unpivot(list(ids), values, name_col, value_col)


def to_wide(
    df: DataFrame,
    keys: Sequence[str],
    name_col: str,
    value_col: str,
    names: Sequence[str],
) -> DataFrame:
    """R-11: one row per key, one column per name (explicit list, no extra
    job to discover values).  (key, name) must be unique, see
    ``quality.duplicated_samples``; names outside the list are reported by ``names_outside``."""
    return df.groupBy(*keys).pivot(name_col, list(names)).agg(F.first(value_col))


def names_outside(df: DataFrame, name_col: str, names: Sequence[str]) -> DataFrame:
    """R-11: the names that ``to_wide`` leaves out, with the number of their rows."""
    return df.where(S.not_in(name_col, names)).groupBy(name_col).agg(F.count(F.lit(1)).alias("n"))


def union_fill(frames: Mapping[str, DataFrame], source_col: str | None = "source") -> DataFrame:
    """U-01 ``rbindlist(fill=TRUE)`` / ``bind_rows(.id)``.

    Columns shared with differing types are cast to string first, because
    Spark's implicit widening of string + number raises on text.
    """
    items = list(frames.items())
    types: dict[str, set] = {}
    for _, df in items:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType)
    mixed = {name for name, ts in types.items() if len(ts) > 1}
    prepared = []
    for name, df in items:
        d = df.select(*[F.col(c).cast("string").alias(c) if c in mixed else F.col(c) for c in df.columns])
        if source_col:
            d = d.withColumn(source_col, F.lit(name))
        prepared.append(d)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), prepared)


def append_strict(base: DataFrame, new: DataFrame, column_order: Sequence[str] | None = None) -> DataFrame:
    """U-02: same columns required; result in ``column_order``."""
    if set(base.columns) != set(new.columns):
        raise ValueError(f"column sets differ: {sorted(set(base.columns) ^ set(new.columns))}")
    out = base.unionByName(new)
    return out.select(*(column_order or base.columns))


def bind_as_text(frames: Sequence[DataFrame], text_cols: Sequence[str]) -> DataFrame:
    """U-03: cast the given columns to text, then bind rows with fill."""
    cast = [df.withColumns({c: F.col(c).cast("string") for c in text_cols if c in df.columns}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """U-04 ``setdiff``: distinct rows of a not in b (EXCEPT DISTINCT)."""
    return a.subtract(b)


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


# R-07 / R-08 -------------------------------------------------------------------
def abstraction_long(wide: DataFrame, year_col: str = "Jahr") -> DataFrame:
    """R-07: waterworks columns -> (Wasserwerk, Foerdermenge_m3), code ``werk``.

    Unnamed ``..n`` columns are dropped, NULL volumes removed.
    """
    cols = [c for c in wide.columns if c != year_col and not c.startswith("..")]
    long = to_long(wide, [year_col], cols, "Wasserwerk", "Foerdermenge_m3", "double")
    return (
        long.withColumnRenamed(year_col, "year")
        .where(F.col("Foerdermenge_m3").isNotNull())
        .withColumn("werk", S.waterworks_code("Wasserwerk"))
    )


def gallery_long(wide: DataFrame, year_col: str = "year", prefix: str = "FRI ", werk: str = "FRI") -> DataFrame:
    """R-08: gallery columns starting with ``prefix`` -> long; year-end date.

    NULL volumes stay (they are removed by the caller, as in the source).
    """
    cols = [c for c in wide.columns if c.startswith(prefix.strip())]
    long = to_long(wide, [year_col], cols, "galerie", "foerdermenge_m3", "double")
    return long.select(
        F.col(year_col).alias("year"),
        S.year_end(year_col).alias("date"),
        F.regexp_replace("galerie", "^" + re.escape(prefix), "").alias("galerie"),
        "foerdermenge_m3",
        F.lit(werk).alias("werk"),
    )


# R-09 / H-19 -------------------------------------------------------------------
LAB_KEY_PARTS = ("par_name", "method", "par_name_phreeqc", "unit_org")


def lab_matrix_long(wide: DataFrame, sep: str = "@") -> DataFrame:
    """R-09: key columns are those without ``sep``; the others are gathered
    as text and their names split into four parts."""
    keys = [c for c in wide.columns if sep not in c]
    vals = [c for c in wide.columns if sep in c]
    long = to_long(wide, keys, vals, "key", "par_val_org", "string")
    parts = S.split_key("key", LAB_KEY_PARTS, sep)
    return long.select(*keys, *[v.alias(k) for k, v in parts.items()], "par_val_org")


def wide_to_long_matching(
    df: DataFrame, ids: Sequence[str], pattern: str, name_col: str, value_col: str, value_type: str = "string"
) -> DataFrame:
    """R-10: gather the columns whose name matches ``pattern``."""
    vals = [c for c in df.columns if re.search(pattern, c) and c not in ids]
    return to_long(df, ids, vals, name_col, value_col, value_type)

