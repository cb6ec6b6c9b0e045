"""Data-quality rules as queries (SURVEY Q-A ... Q-I).

Each rule returns its violations as a DataFrame; ``check`` raises when a
violation table is not empty (``isEmpty`` reads at most one row).  Rules on single rows are
also conditions that ``written_checked`` counts while a flow's table is written, without
a job of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut_lineage
from .joins import keyed_join
from .stats import duplicate_ids


class QualityError(ValueError):
    pass


def check(violations: DataFrame, message: str) -> None:
    if not violations.isEmpty():
        raise QualityError(f"{message}: e.g. {violations.take(5)}")


def observed(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its ``rows`` and of how many meet each rule's condition, counted by
    whatever job runs it; several rules are one pass."""
    seen = Observation()
    counts = [F.count(F.when(F.coalesce(bad, F.lit(False)), 1)).alias(name) for name, bad in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def written_checked(df: DataFrame, rules: Mapping[str, Column], required: str | None = None) -> DataFrame:
    """``cut_lineage`` that raises if the rows written break a rule (name -> condition of a bad row) or,
    with ``required`` (what the table is), if there are none (Q-I)."""
    watched, seen = observed(df, rules)
    written = cut_lineage(watched)
    counts = seen.get
    broken = {name: counts[name] for name in rules if counts[name]}
    if broken:
        raise QualityError("; ".join(f"{name}: {n} rows" for name, n in broken.items()))
    if required and not counts["rows"]:
        raise QualityError(f"{required} is empty")
    return written


def duplicated_samples(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Q-A: sample ids that occur more than once."""
    return duplicate_ids(df, id_cols, "n")


def bad_logger_names(files: DataFrame, stem_col: str = "file_stem") -> DataFrame:
    """Q-B: logger files whose name does not match the pattern."""
    return files.where(is_bad_logger_name(stem_col))


def is_bad_logger_name(stem_col: str = "file_stem") -> Column:
    return S.not_rlike(stem_col, S.LOGGER_FILE_PATTERN)


def unit_violations(df: DataFrame, par_col: str = "par_name_phreeqc", unit_col: str = "unit",
                    exempt: Sequence[str] = ("temp", "pH"), unit: str = "mg/l") -> DataFrame:
    """Q-C: every unit is mg/l except for temperature and pH."""
    return df.where(is_unit_violation(par_col, unit_col, exempt, unit))


def is_unit_violation(par_col: str = "par_name_phreeqc", unit_col: str = "unit",
                      exempt: Sequence[str] = ("temp", "pH"), unit: str = "mg/l") -> Column:
    return S.not_in(par_col, exempt) & (F.col(unit_col).isNull() | (F.col(unit_col) != unit))


def missing_sheets(sheets: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q-D: (file, required sheet) pairs that are absent."""
    files = sheets.select("file_name").distinct()
    wanted = files.withColumn("sheet_name", F.explode(F.array(*[F.lit(s) for s in required])))
    have = sheets.select("file_name", "sheet_name").distinct()
    return wanted.join(have, ["file_name", "sheet_name"], "left_anti")


def meta_sheet_violations(layouts: DataFrame) -> DataFrame:
    """Q-E: files of the META layout without exactly one META sheet."""
    return layouts.where((F.col("n_meta_sheets") > 0) & (F.col("n_meta_sheets") != 1))


def site_sheet_violations(layouts: DataFrame) -> DataFrame:
    """Q-F: files without any sheet starting with a site code."""
    return layouts.where((F.col("layout") != "header1") & (F.col("n_site_sheets") == 0))


def bad_utc_text(df: DataFrame, col: str) -> DataFrame:
    """Q-G: text that is not strict ``yyyy-MM-ddTHH:mm:ssZ``."""
    return df.where(~S.is_utc_text(col))


def group_status(df: DataFrame, group_col: str, rules: Mapping[str, DataFrame]) -> DataFrame:
    """Q-H: one row per group with the violation count of every rule and a
    status; each rule table must carry ``group_col``."""
    status = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"))
    for name, viol in rules.items():
        counts = viol.groupBy(group_col).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        status = keyed_join(status, counts, [group_col]).withColumn(
            f"n_{name}", F.coalesce(F.col(f"n_{name}"), F.lit(0)).cast("long")
        )
    bad = F.lit(False)
    for name in rules:
        bad = bad | (F.col(f"n_{name}") > 0)
    return status.withColumn("status", F.when(bad, F.lit("failed")).otherwise(F.lit("ok")))


def keep_good_groups(df: DataFrame, status: DataFrame, group_col: str) -> DataFrame:
    """Q-H: drop the rows of failed groups (the NULL group is one); good groups are still used."""
    failed = status.where(F.col("status") == "failed").select(group_col)
    return keyed_join(df, failed, [group_col], how="left_anti")


def require_rows(df: DataFrame, what: str) -> None:
    """Q-I: a lookup or input must not be empty."""
    if df.isEmpty():
        raise QualityError(f"{what} is empty")
