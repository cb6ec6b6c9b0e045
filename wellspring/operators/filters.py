"""Projections and row filters.

Plain DataFrame verbs so Catalyst can push every predicate into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


# P-01 ... P-06 ------------------------------------------------------------------
def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P-01: rename; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """P-03: drop every column whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """P-06: constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


# P-07 ------------------------------------------------------------------------------
def remove_before(df: DataFrame, time_col: str, since) -> DataFrame:
    """Keep rows at or after ``since``; ``None``/empty means no filter."""
    if since is None or since == "":
        return df
    bound = F.lit(since).cast(df.schema[time_col].dataType)
    return df.where(F.col(time_col) >= bound)


# P-08 ... P-11 ---------------------------------------------------------------------
def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def keep_text(df: DataFrame, col: str) -> DataFrame:
    """P-09: not NULL and not empty."""
    return df.where(S.has_text(col))


def drop_empty_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P-10: drop rows where every (given) column is NULL."""
    return df.dropna(how="all", subset=list(cols) if cols else None)


def drop_header_repeats(df: DataFrame, col: str, header_text: str) -> DataFrame:
    """P-11: drop repeated header rows; NULL values go too (R filter on NA)."""
    return df.where(F.col(col) != F.lit(header_text))




def exclude_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """R ``!x %in% set``: NULL rows are kept."""
    return df.where(S.not_in(col, values))


def exclude_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """P-16 (``str_detect(negate=TRUE)``): NULL rows are dropped."""
    return df.where(~F.col(col).rlike(pattern))


def within(df: DataFrame, col: str, low, high) -> DataFrame:
    """P-18: inclusive window; bounds are cast to the column type."""
    t = df.schema[col].dataType
    return df.where(F.col(col).between(F.lit(low).cast(t), F.lit(high).cast(t)))


# P-14 ------------------------------------------------------------------------------
def null_implausible(
    df: DataFrame, parameter_col: str, value_col: str, parameter: str, upper: float
) -> DataFrame:
    """NULL out values above ``upper`` for one parameter, keep all rows."""
    bad = (F.col(parameter_col) == F.lit(parameter)) & (F.col(value_col) > F.lit(upper))
    return df.withColumn(value_col, F.when(~F.coalesce(bad, F.lit(False)), F.col(value_col)))




# P-19 --------------------------------------------------------------------------------
def first_present(*cols: str | Column) -> Column:
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


# P-20 --------------------------------------------------------------------------------
# --- fixed values: default synonym pairs of the 1991 survey (old <- new) ----
SURVEY_SYNONYMS = (
    ("fi_mi", "fi_mi_m_nn"),
    ("ku_sto", "kupp_st"),
    ("lf", "el_lf"),
    ("progr", "beprob_progr"),
    ("strat", "stratigr"),
    ("uv254", "uv_ext"),
)
# -------------------------------------------------------------------------------


def remap_synonyms(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]] = SURVEY_SYNONYMS,
    delete_cols: bool = True,
) -> DataFrame:
    """Fill NULLs of ``old`` from ``new``; drop ``new`` (always, Q-9).

    Pairs with an absent column are skipped.
    """
    out = df
    for old, new in pairs:
        if new not in out.columns or old not in out.columns:
            continue
        out = out.withColumn(old, F.coalesce(F.col(old), F.col(new)))
        if delete_cols:
            out = out.drop(new)
    return out
