"""Queries that write files and read them back through the sources (S-01, S-04, S-06,
S-07, S-09, K-02, K-04, K-05, T-02).  Every file goes below the shared
checkpoint folder; the result is what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells as CL
from ..session import scratch_path
from ..sources import readers as SR
from ..sources import sinks as K
from ..streaming.ingest import ingest_new_files, refresh_stats
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE, replaced
from .queries import r6, register, ts
from .queries_cells import _B, FIRST_PART_COL, lab_cells
from .queries_io import _LOGGER_LONG, STAT_COLS, stage_logger_files
from .queries_lab import isotope_sheet


# --- S-01 / K-02 ---------------------------------------------------------------------
@register("sensor_metadata")
def sensor_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Tables(spark, sf_dir).supplier
    number = F.col("s_suppkey").cast("int")
    meta = s.select(
        F.lit("K").alias("galerie"), F.col("s_nationkey").alias("brunnen_nummer"), F.lit(400).alias("dn"),
        F.lit("über Filter").alias("einbau_pumpe"), F.col("s_name").alias("einbau_messkette"),
        F.lit(21.0).alias("filteroberkante_muGOK"), F.lit(27.0).alias("filterunterkante_muGOK"),
        number.alias("sensor_id"), (number % 10).alias("sensor_endnummer"), F.col("s_acctbal").alias("einbau_sensor_muGOK"),
    )
    paths = K.write_side_tables({"metadata": meta}, scratch_path(spark, "side"), postfix="now")
    return SR.read_sensor_metadata(spark, paths["metadata"])


ORACLE["sensor_metadata"] = """
SELECT 'K' AS galerie, s_nationkey AS brunnen_nummer, 400 AS dn, 'über Filter' AS einbau_pumpe, s_name AS einbau_messkette,
       CAST(21 AS DOUBLE) AS "filteroberkante_muGOK", CAST(27 AS DOUBLE) AS "filterunterkante_muGOK",
       CAST(s_suppkey AS INTEGER) AS sensor_id, CAST(s_suppkey % 10 AS INTEGER) AS sensor_endnummer,
       s_acctbal AS "einbau_sensor_muGOK"
FROM supplier
"""


# --- S-04 -----------------------------------------------------------------------------------
@register("file_listing")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of a file tree (one per nation, with a blank) found by listing it."""
    root = scratch_path(spark, "tree")
    c = Tables(spark, sf_dir).customer
    folder = F.concat(F.lit("K "), F.col("c_nationkey").cast("string"))
    c.select(folder.alias("well"), "c_custkey").write.partitionBy("well").option("header", True).csv(root)
    files = SR.list_files(spark, root, "*.csv")
    inner = F.regexp_extract("path", r"/well=([^/]*)/[^/]*$", 1)
    return files.select(F.url_decode(inner).alias("folder")).distinct()


ORACLE["file_listing"] = "SELECT DISTINCT 'K ' || CAST(c_nationkey AS VARCHAR) AS folder FROM customer"


# --- S-06 / C-08 --------------------------------------------------------------------------------
@register("isotopes_file")
def isotopes_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "isotopes")
    isotope_sheet(Tables(spark, sf_dir)).write.option("header", True).option("sep", ";").csv(path)
    x = C.isotopes_long(SR.read_isotopes(spark, path), "crew_1", "lab_B")
    # the reader drops the blanks that lead a value
    return x.withColumns({"probenahme_datum": ts("probenahme_datum"), "numeric_value": r6("numeric_value")})


ORACLE["isotopes_file"] = replaced(ORACLE["isotopes_long"], ("' ' || CAST(s_suppkey AS VARCHAR)", "CAST(s_suppkey AS VARCHAR)"))


# --- S-07 / S-09 -----------------------------------------------------------------------------------
@register("sheet_blocks")
def sheet_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks of columns of the rows below the header, glued."""
    first = FIRST_PART_COL
    cells = CL.cell_range(lab_cells(Tables(spark, sf_dir), 2), rows=(3, None), col_ranges=((1, 2), (first + 7, first + 9)))
    return cells.select("file_name", "sheet_name", "row_idx", "col_idx", "value")


ORACLE["sheet_blocks"] = "WITH " + _B + """
, r AS (SELECT DISTINCT file_name, sheet_name, l_orderkey FROM b)
SELECT file_name, sheet_name, CAST(l_orderkey + 3 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx,
       printf('%.2f', q) AS value
FROM b WHERE l_partkey BETWEEN 7 AND 9
UNION ALL
SELECT file_name, sheet_name, CAST(l_orderkey + 3 AS BIGINT), CAST(1 AS BIGINT), strftime(o_orderdate, '%Y-%m-%d')
FROM r LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT file_name, sheet_name, CAST(l_orderkey + 3 AS BIGINT), CAST(2 AS BIGINT), CAST(l_orderkey AS VARCHAR) FROM r
"""


# --- K-02 / K-04 / K-05 -------------------------------------------------------------------------------
@register("side_tables")
def side_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables saved as parquet and as CSV side by side, all four read back."""
    t = Tables(spark, sf_dir)
    nations = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    status = t.orders.groupBy(F.year("o_orderdate").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    tables = {"nations": nations, "years": status}
    root = scratch_path(spark, "saved")
    saved, side = K.save_tables(tables, root), K.write_side_tables(tables, root, postfix="csv")
    parts = []
    for name in tables:
        parts.append(spark.read.parquet(saved[name]).withColumn("form", F.lit(f"{name} parquet")))
        back = spark.read.schema("k int, n bigint").option("header", True).option("enforceSchema", False).csv(side[name])
        parts.append(back.withColumn("form", F.lit(f"{name} csv")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ORACLE["side_tables"] = """
WITH x AS (
  SELECT 'nations' AS name, CAST(c_nationkey AS INTEGER) AS k, count(*) AS n FROM customer GROUP BY ALL
  UNION ALL
  SELECT 'years', CAST(year(o_orderdate) AS INTEGER), count(*) FROM orders GROUP BY ALL)
SELECT k, n, name || ' ' || f AS form FROM x, (VALUES ('parquet'), ('csv')) AS v(f)
"""


# --- T-02 ----------------------------------------------------------------------------------------------
@register("refreshed_stats")
def refreshed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingest runs (the second finds nothing new), then the statistics of the accumulated table."""
    src = stage_logger_files(Tables(spark, sf_dir), scratch_path(spark, "loggers"))
    sink, ckpt = scratch_path(spark, "sensor-sink"), scratch_path(spark, "sensor-ckpt")
    for _ in range(2):
        ingest_new_files(spark, src, sink, ckpt)
    st = refresh_stats(spark, sink)
    return st.select("sensor_id", "parameter", "datetime_min", "datetime_max", *[r6(c).alias(c) for c in STAT_COLS], "number_of_samples")


ORACLE["refreshed_stats"] = replaced(ORACLE["sensor_ingest_stats"], (",\n       row_number() OVER (ORDER BY sensor_id, parameter) AS rn", ""))
