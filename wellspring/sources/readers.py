"""Sources: typed scans, file inventories, import plans.

Explicit schemas everywhere (no inference); CSV headers are verified
against the schema (``enforceSchema=false``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions.names import clean_name

# --- schemas of the reference's machine files ------------------------------------
SENSOR_METADATA_SCHEMA = T.StructType(
    [
        T.StructField("galerie", T.StringType()),
        T.StructField("brunnen_nummer", T.IntegerType()),
        T.StructField("dn", T.IntegerType()),
        T.StructField("einbau_pumpe", T.StringType()),
        T.StructField("einbau_messkette", T.StringType()),
        T.StructField("filteroberkante_muGOK", T.DoubleType()),
        T.StructField("filterunterkante_muGOK", T.DoubleType()),
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("sensor_endnummer", T.IntegerType()),
        T.StructField("einbau_sensor_muGOK", T.DoubleType()),
    ]
)
SENSOR_FILE_SCHEMA = T.StructType(
    [
        T.StructField("Geraet", T.IntegerType()),
        T.StructField("DatumUhrzeit", T.StringType()),
        T.StructField("Leitfaehigkeit", T.DoubleType()),
        T.StructField("Temperatur", T.DoubleType()),
    ]
)
SENSOR_LONG_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("datum_uhrzeit", T.TimestampNTZType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("messwert", T.DoubleType()),
    ]
)
CELLS_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("col_idx", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
# Isotope export: 7 ';'-separated columns, text columns kept as text.
ISOTOPE_SCHEMA = T.StructType(
    [
        T.StructField("lab_id", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("sampling_date", T.StringType()),
        T.StructField("fuk_masl", T.DoubleType()),
        T.StructField("x2h", T.StringType()),
        T.StructField("x18o", T.StringType()),
        T.StructField("cond_field", T.StringType()),
    ]
)

# --- fixed values: rows to skip per survey file name prefix (1991 survey) ----
SURVEY_SKIP_RULES = (
    ("^B[0-9]", 1), ("^EWGES", 1), ("^EWMITTEL", 1), ("^GWBR", 1), ("^JURA", 1),
    ("^K[0-9]", 1), ("^KREIDE", 1), ("^PRAERUP", 1), ("^UF", 1), ("^GF-GM", 1),
    ("^GWMGUETE", 1), ("^GWNMITTE", 2), ("^GWNHOCH", 2), ("^GWNTIEF", 2), ("^Q13", 2),
)
SURVEY_FILES_TO_IGNORE = ("cl25", "clliste", "rupelauf", "salzlast")
# ---------------------------------------------------------------------------------


# Batch and streaming readers alike: header names are checked against the schema.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "ignoreLeadingWhiteSpace": True, "mode": "PERMISSIVE"}


def _csv(spark: SparkSession, schema: T.StructType, sep: str = ","):
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("sep", sep)


def read_sensor_metadata(spark: SparkSession, path: str) -> DataFrame:
    """S-01."""
    return _csv(spark, SENSOR_METADATA_SCHEMA).csv(path)


def read_sensor_files(spark: SparkSession, paths: str | Sequence[str], root: str | None = None) -> DataFrame:
    """S-02 / S-03: logger CSVs -> raw rows with a ``file`` column relative
    to ``root`` (Q-3); one distributed scan over all files."""
    df = _csv(spark, SENSOR_FILE_SCHEMA).csv(paths if isinstance(paths, str) else list(paths))
    path = file_path()
    if root:
        prefix = root.rstrip("/") + "/"
        path = F.regexp_replace(path, "^(file:)?" + _re_escape(prefix), "")
    return df.withColumn("file", path)


def file_path() -> Column:
    """The file of a row as its plain path: Spark gives it URL-encoded (blanks, umlauts)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _re_escape(s: str) -> str:
    return re.escape(s)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """S-04: recursive file inventory (path and modification time only; the
    file contents are never read)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "modificationTime", "length")
    )


def logger_inventory(files: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """S-04 + H-01 ... H-04: sftp_path below root -> folder, file, gallery,
    well, prefix, sensor id, sensor end digit, time."""
    # listings give plain paths, the readers' file column is decoded to the same
    rel = F.regexp_replace(F.col(path_col), "^(file:)?" + _re_escape(root.rstrip("/") + "/"), "")
    x = files.withColumn("sftp_path", rel)
    x = x.withColumns({"folder": S.path_folder("sftp_path"), "file": S.path_file("sftp_path")})
    x = x.withColumns(
        {
            "galerie": S.gallery_of_folder("folder"),
            "brunnen_nummer": S.well_of_folder("folder"),
            "file_stem": S.drop_extension("file"),
        }
    )
    return x.withColumns(S.logger_parts("file_stem"))


def read_accumulated(spark: SparkSession, path: str, schema: T.StructType = SENSOR_LONG_SCHEMA) -> DataFrame:
    """S-05: the accumulated data set; absent -> empty with the fixed schema.
    Only a missing path means 'nothing yet'; any other error is raised."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lookup(spark: SparkSession, path: str, schema: str = "VariableName_org string, para_id int") -> DataFrame | None:
    """J-03 / K-06: the lookup of parameter names; None where the file is missing."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_isotopes(spark: SparkSession, path: str) -> DataFrame:
    """S-06: ';'-separated isotope export."""
    return _csv(spark, ISOTOPE_SCHEMA, sep=";").csv(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells relation from parquet."""
    return spark.read.schema(CELLS_SCHEMA).parquet(path)


@F.udf(T.StringType())
def _cleaned(stem):
    return clean_name(stem)


def import_plan(
    paths: DataFrame,
    path_col: str = "ods_paths",
    rules: Sequence[tuple[str, int]] = SURVEY_SKIP_RULES,
    ignore: Sequence[str] = SURVEY_FILES_TO_IGNORE,
) -> DataFrame:
    """S-12: per survey file its clean id and the header rows to skip."""
    files = S.path_file(path_col)
    stem = F.regexp_replace(files, r"\.ods$", "")
    # H-20 on all files of the plan together, so that no two get one name
    at = Window.partitionBy(_cleaned(stem)).orderBy(path_col)
    number = F.row_number().over(at)
    clean = F.concat(_cleaned(stem), F.when(number > 1, F.concat(F.lit("_"), number)).otherwise(F.lit("")))
    skip = None
    for pattern, n in rules:
        cond = files.rlike(pattern)
        skip = F.when(cond, F.lit(n)) if skip is None else skip.when(cond, F.lit(n))
    skip = skip.otherwise(F.lit(0)) if skip is not None else F.lit(0)
    plan = paths.select(F.col(path_col), files.alias("ods_files"), clean.alias("ods_names_clean"), skip.alias("skip_rows"))
    return plan.where(S.not_in("ods_names_clean", ignore))


def newest_files(files: DataFrame, time_col: str = "modificationTime") -> DataFrame:
    """S-13: files with the latest modification time (ties kept)."""
    from ..operators.stats import latest_rows

    return latest_rows(files, time_col)

