"""Sinks.

All writes are distributed (one file per task); ordering at a sink is done
with ``repartitionByRange`` + ``sortWithinPartitions`` instead of a global
sort into one task.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S


def period_postfix(df: DataFrame, time_col: str = "datum_uhrzeit") -> str:
    """H-17 / Q-1: '<first>_<last>' of the covered period (one-row aggregate)."""
    row = df.agg(
        S.period_text(F.min(time_col)).alias("a"), S.period_text(F.max(time_col)).alias("b")
    ).first()
    return f"{row['a']}_{row['b']}"


def write_sensor_data(
    df: DataFrame,
    target_dir: str,
    fmt: str = "parquet",
    name: str = "messketten",
    compression: str | None = None,
    partition_col: str | None = "parameter",
    order_cols: Sequence[str] = ("sensor_id", "datum_uhrzeit"),
) -> str:
    """K-01: write the long sensor table to ``<target>/<name>_<period>``.

    Rows are range-partitioned and sorted within files (O-01 at the sink);
    CSV is gzip-compressed by default (zip is no Spark codec).
    """
    path = os.path.join(target_dir, f"{name}_{period_postfix(df)}")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ([partition_col] if partition_col else []) + list(order_cols)
    laid = df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys]).sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in keys])
    w = laid.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    if fmt == "csv":
        w.option("header", True).option("compression", compression or "gzip").csv(path)
    else:
        w.option("compression", compression or "snappy").parquet(path)
    return path


def write_side_tables(tables: Mapping[str, DataFrame], target_dir: str, postfix: str = "") -> dict[str, str]:
    """K-02: named side tables (statistics, metadata, files) as CSV with header."""
    out = {}
    for name, df in tables.items():
        path = os.path.join(target_dir, f"{name}{'_' + postfix if postfix else ''}")
        df.write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out


def to_german_csv_frame(df: DataFrame, digits: int = 2) -> DataFrame:
    """K-03: doubles as decimal-comma text (to be written with sep ';')."""
    return df.select(
        *[
            S.decimal_comma(f.name, digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_german_csv(df: DataFrame, path: str, digits: int = 2) -> str:
    to_german_csv_frame(df, digits).write.mode("overwrite").option("header", True).option("sep", ";").csv(path)
    return path


def save_tables(tables: Mapping[str, DataFrame], target_dir: str) -> dict[str, str]:
    """K-04 / K-05: several tables side by side in one folder (parquet)."""
    out = {}
    for name, df in tables.items():
        path = os.path.join(target_dir, name)
        df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out


def write_template(template: DataFrame, path: str, order_col: str = "VariableName_org") -> str:
    """K-06: the unmapped-names template as CSV, dealt by ranges and sorted, so that the files one after
    another are in order; a few names make one file."""
    key = F.col(order_col).asc_nulls_last()
    template.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("header", True).csv(path)
    return path
