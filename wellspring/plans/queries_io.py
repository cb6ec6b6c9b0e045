"""Sources, sinks, streaming and composite-flow queries (S-01 ... S-06, K-01 ... K-05,
T-01, T-02, C-01, C-02, C-05, C-06, C-10).

Files are written below the shared checkpoint folder (``spark.checkpoint.dir``),
each run into a fresh folder, never to a machine-local temporary path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import cells as CL
from ..operators.ranking import sort_rank
from ..session import scratch_path
from ..sources import readers as SR
from ..sources import sinks as K
from ..streaming.ingest import ingest_new_files
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE, replaced
from .queries import INSTALLATION_UTC, dbl, r6, register, ts
from .queries_cells import archive_cells, lab_cells
from .queries_text import survey_paths

STAT_COLS = ("min", "q10", "mean", "median", "q90", "max")


def stage_logger_files(t: Tables, path: str) -> str:
    """Write ``events`` as logger CSV files (F-2 layout, local UTC+1 text)."""
    e = t.events.select(
        F.col("user_id").cast("int").alias("Geraet"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("DatumUhrzeit"),
        (F.col("value") * 100).alias("Leitfaehigkeit"),
        (F.col("value") / 10).alias("Temperatur"),
    )
    e.write.mode("overwrite").option("header", True).csv(path)
    return path


_LOGGER_LONG = """
l AS (
  SELECT CAST(user_id AS INTEGER) AS sensor_id, ts - INTERVAL 1 HOUR AS datum_uhrzeit,
         'Leitfaehigkeit' AS parameter, value * 100 AS messwert FROM events
  UNION ALL
  SELECT CAST(user_id AS INTEGER), ts - INTERVAL 1 HOUR, 'Temperatur', value / 10 FROM events)
"""


# --- T-01 ------------------------------------------------------------------------------
@register("stream_ingest")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    src = stage_logger_files(t, scratch_path(spark, "loggers"))
    sink, ckpt = scratch_path(spark, "sensor-sink"), scratch_path(spark, "sensor-ckpt")
    ingest_new_files(spark, src, sink, ckpt, installed_since=INSTALLATION_UTC)
    out = spark.read.parquet(sink)
    return out.select("sensor_id", "datum_uhrzeit", "parameter", r6("messwert").alias("messwert"))


ORACLE["stream_ingest"] = "WITH " + _LOGGER_LONG + """
SELECT sensor_id, datum_uhrzeit, parameter, round(messwert, 6) AS messwert FROM l
WHERE datum_uhrzeit >= TIMESTAMP '2024-01-15 00:00:00'
"""


# --- C-01 / S-02 / S-03 / P-14 / A-01 / T-02 -------------------------------------------------
@register("sensor_ingest_stats")
def sensor_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "loggers")
    stage_logger_files(t, root)
    raw = SR.read_sensor_files(spark, root, root=root)
    st = C.sensor_stats_flow(C.sensor_long_from_raw(raw))
    st = sort_rank(st, ["sensor_id", "parameter"], "rn")
    return st.select("sensor_id", "parameter", "datetime_min", "datetime_max",
                     *[r6(c).alias(c) for c in STAT_COLS], "number_of_samples", "rn")


ORACLE["sensor_ingest_stats"] = "WITH " + _LOGGER_LONG + """
, c AS (SELECT sensor_id, datum_uhrzeit, parameter,
               CASE WHEN parameter = 'Leitfaehigkeit' AND messwert > 20000 THEN NULL ELSE messwert END AS v FROM l)
SELECT sensor_id, parameter, min(datum_uhrzeit) AS datetime_min, max(datum_uhrzeit) AS datetime_max,
       round(min(v), 6) AS "min", round(quantile_cont(v, 0.1), 6) AS q10, round(avg(v), 6) AS mean,
       round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS q90,
       round(max(v), 6) AS "max", count(*) AS number_of_samples,
       row_number() OVER (ORDER BY sensor_id, parameter) AS rn
FROM c GROUP BY sensor_id, parameter
"""


# --- K-03 + CSV scan ------------------------------------------------------------------------------
@register("roundtrip_csv")
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    path = K.write_german_csv(t.orders.select("o_orderkey", "o_totalprice"), scratch_path(spark, "german-csv"))
    back = spark.read.schema("o_orderkey bigint, o_totalprice string").option("header", True).option("sep", ";").csv(path)
    return back.select("o_orderkey", r6(S.to_number(F.replace("o_totalprice", F.lit(","), F.lit(".")))).alias("o_totalprice"))


ORACLE["roundtrip_csv"] = "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders"


# --- K-01 / K-02 / K-04 / K-05 / S-05 ------------------------------------------------------------------
@register("roundtrip_tables")
def roundtrip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    long = t.events.select(
        F.lit("events").alias("file"), F.col("user_id").cast("int").alias("sensor_id"),
        F.col("ts").alias("datum_uhrzeit"), F.col("event_type").alias("parameter"), F.col("value").alias("messwert"),
    )
    root = scratch_path(spark, "export")
    path = K.write_sensor_data(long, root)
    stats = C.sensor_stats_flow(long)
    K.save_tables({"stats": stats}, root)
    K.write_side_tables({"stats": stats}, root, postfix="side")
    back = SR.read_accumulated(spark, path)
    missing = SR.read_accumulated(spark, root + "/does-not-exist")
    return back.unionByName(missing)


ORACLE["roundtrip_tables"] = """
SELECT 'events' AS file, CAST(user_id AS INTEGER) AS sensor_id, ts AS datum_uhrzeit, event_type AS parameter,
       value AS messwert FROM events
"""


# --- C-02 -------------------------------------------------------------------------------------------------
def well_operation(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    j = o.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select(
        F.concat(F.lit("FRIK"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit("-A-1998V"))
        .alias("name_der_messstelle_gms"),
        F.col("o_orderdate").alias("bwb_datum"),
        (F.col("o_totalprice") / 250).alias("menge_summe_m3"),
    )


@register("well_operation_series")
def well_operation_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = C.well_operation_daily(well_operation(Tables(spark, sf_dir)))
    return x.select("is_field", dbl("brunnen_nummer").alias("brunnen_nummer"), ts("bwb_datum").alias("bwb_datum"), "n",
                    r6("volume").alias("volume"), r6("roll_7").alias("roll_7"), r6("roll_10").alias("roll_10"))


ORACLE["well_operation_series"] = """
WITH w AS (
  SELECT CAST(o_orderdate AS DATE) AS bwb_datum, c_nationkey AS brunnen_nummer, o_totalprice / 250 AS menge
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice / 250 < 2000),
d AS (
  SELECT bwb_datum, brunnen_nummer, count(*) AS n, coalesce(sum(menge), 0) AS volume,
         grouping(brunnen_nummer) = 1 AS is_field
  FROM w GROUP BY GROUPING SETS ((bwb_datum, brunnen_nummer), (bwb_datum)))
SELECT is_field, CAST(brunnen_nummer AS DOUBLE) AS brunnen_nummer, CAST(bwb_datum AS TIMESTAMP) AS bwb_datum, n,
  round(volume, 6) AS volume,
  round(CASE WHEN count(*) OVER w7 = 7 AND count(volume) OVER w7 = 7 THEN avg(volume) OVER w7 END, 6) AS roll_7,
  round(CASE WHEN count(*) OVER w10 = 10 AND count(volume) OVER w10 = 10 THEN avg(volume) OVER w10 END, 6) AS roll_10
FROM d
WINDOW w7 AS (PARTITION BY is_field, brunnen_nummer ORDER BY bwb_datum ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w10 AS (PARTITION BY is_field, brunnen_nummer ORDER BY bwb_datum ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
"""


# --- C-05 / C-06 ---------------------------------------------------------------------------------------------
def archive_lookups(t: Tables):
    p = t.part
    plen = F.length("p_name")
    lookup_para = p.select(
        F.col("p_name").alias("VariableName_org"), F.when(~F.col("p_name").contains("ring"), plen).alias("para_id")
    ).distinct()
    parameters = p.select(plen.alias("para_id")).distinct().select(
        "para_id",
        F.concat(F.lit("len_"), F.col("para_id").cast("string")).alias("para_kurzname"),
        F.concat(F.lit("L"), F.col("para_id").cast("string")).alias("para_kuerzel"),
    )
    sites = t.nation.select(
        F.col("n_nationkey").alias("interne_nr"),
        F.concat(F.lit("W"), F.col("n_regionkey").cast("string")).alias("werk"),
        F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("galerie"),
        F.when(F.col("n_regionkey") < 3, F.lit("Rohwasser")).otherwise(F.lit("Reinwasser")).alias("prufgegenstand"),
    )
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    abstraction = o.groupBy(
        F.concat(F.lit("W"), F.col("n_regionkey").cast("string")).alias("werk"), F.year("o_orderdate").alias("year")
    ).agg(F.sum("o_totalprice").alias("Foerdermenge_m3"))
    return lookup_para, parameters, sites, abstraction


def archive_series(t: Tables) -> DataFrame:
    long = CL.gather_with_header(lab_cells(t, 2), CL.HEADER_2, kept_map=False)
    lookup_para, parameters, sites, _ = archive_lookups(t)
    return C.archive_timeseries(long, lookup_para, parameters, sites)


@register("lab_archive_yearly")
def lab_archive_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    abstraction = archive_lookups(t)[3]
    x = C.lab_archive_yearly(archive_series(t), abstraction, "Rohwasser")
    return x.withColumns({"mean_value": r6("mean_value"), "Foerdermenge_m3": r6("Foerdermenge_m3")})


_ARCHIVE_CTE = """
b AS (
  SELECT 'lab_' || l_returnflag || '.xlsx' AS file_name, CAST(s_nationkey AS VARCHAR) || ' ' || n_name AS sheet_name,
         s_nationkey, l_orderkey, l_partkey, sum(l_quantity) AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey IS NOT DISTINCT FROM n_nationkey
  GROUP BY ALL),
lp AS (SELECT DISTINCT p_name AS VariableName_org,
              CASE WHEN NOT contains(p_name, 'ring') THEN length(p_name) END AS para_id FROM part),
x AS (SELECT b.*, CAST(o_orderdate AS DATE) AS d, lp.para_id, 'len_' || CAST(lp.para_id AS VARCHAR) AS para_kurzname,
             'L' || CAST(lp.para_id AS VARCHAR) AS para_kuerzel
      FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
           JOIN lp ON p_name = lp.VariableName_org WHERE lp.para_id IS NOT NULL),
y AS (SELECT x.*, 'W' || CAST(n_regionkey AS VARCHAR) AS werk, 'G' || CAST(n_nationkey AS VARCHAR) AS galerie,
             CASE WHEN n_regionkey < 3 THEN 'Rohwasser' ELSE 'Reinwasser' END AS prufgegenstand
      FROM x LEFT JOIN nation ON CAST(n_nationkey AS DOUBLE) IS NOT DISTINCT FROM CAST(x.s_nationkey AS DOUBLE))
"""

ORACLE["lab_archive_yearly"] = "WITH " + _ARCHIVE_CTE + """
, m AS (SELECT para_kurzname, werk, CAST(year(d) AS INTEGER) AS "year", avg(q) AS mean_value
        FROM y WHERE prufgegenstand = 'Rohwasser' GROUP BY ALL),
a AS (SELECT 'W' || CAST(n_regionkey AS VARCHAR) AS werk, CAST(year(o_orderdate) AS INTEGER) AS "year",
             sum(o_totalprice) AS Foerdermenge_m3
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT m.para_kurzname, m.werk, m."year", round(m.mean_value, 6) AS mean_value,
       round(a.Foerdermenge_m3, 6) AS Foerdermenge_m3
FROM m LEFT JOIN a ON m.werk IS NOT DISTINCT FROM a.werk AND m."year" IS NOT DISTINCT FROM a."year"
"""


@register("lab_archive_merged")
def lab_archive_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-1 and header-2 workbooks with a 'Datum' and header-4 workbooks with a 'Probenahme' as one
    archive, then the yearly means.  The lookup has no names of header-1 columns, so the inner join leaves these out."""
    t = Tables(spark, sf_dir)
    cells = archive_cells(t)
    renamed = (F.col("file_name") == "lab_N.xlsx") & (F.col("row_idx") == 1) & (F.col("col_idx") == 1)
    cells = cells.withColumn("value", F.when(renamed, F.lit("Probenahme")).otherwise(F.col("value")))
    long = C.read_archive(cells, header4_files=["lab_N.xlsx"], kept=("Datum", "Probenahme"), kept_map=False, meta_map=False)
    lookup_para, parameters, sites, abstraction = archive_lookups(t)
    series = C.archive_timeseries(long, lookup_para, parameters, sites)
    x = C.lab_archive_yearly(series, abstraction, "Rohwasser")
    return x.withColumns({"mean_value": r6("mean_value"), "Foerdermenge_m3": r6("Foerdermenge_m3")})


ORACLE["lab_archive_merged"] = replaced(
    ORACLE["lab_archive_yearly"],
    ("WHERE prufgegenstand = 'Rohwasser'", "WHERE prufgegenstand = 'Rohwasser' AND file_name IN ('lab_A.xlsx', 'lab_N.xlsx')"),
)


@register("availability_report")
def availability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = C.availability_report(archive_series(Tables(spark, sf_dir)), "W1")
    return x.withColumns({
        "date_min": ts("date_min"), "date_max": ts("date_max"), "period_days": F.col("period_days").cast("long"),
    })


ORACLE["availability_report"] = "WITH " + _ARCHIVE_CTE + """
SELECT para_id, para_kuerzel, para_kurzname, werk, galerie,
       CAST(min(d) AS TIMESTAMP) AS date_min, CAST(max(d) AS TIMESTAMP) AS date_max, count(*) AS number_of_samples,
       CAST(date_diff('day', min(d), max(d)) AS BIGINT) AS period_days,
       CAST(round_even(date_diff('day', min(d), max(d)) / count(*), 0) AS DOUBLE) AS mean_sampling_interval_days
FROM y WHERE prufgegenstand = 'Rohwasser' AND werk = 'W1'
GROUP BY para_id, para_kuerzel, para_kurzname, werk, galerie
"""


# --- C-10 / U-01 / P-08 / P-10 / P-11 / P-20 / J-11 / H-14 / A-06 -----------------------------------------------
def survey_sheets(t: Tables) -> dict[str, DataFrame]:
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    site = F.concat(F.lit("GF,Br"), F.col("doc_id").cast("string"))
    datum = F.date_format(F.date_add(F.make_date(F.lit(1991), F.lit(1), F.lit(1)), F.col("doc_id").cast("int")), "yy/MM/dd")
    clean = F.lower("source")
    a = d.where(F.col("lang") == "en").select(
        clean.alias("ods_names_clean"), site.alias("messstelle"), datum.alias("datum"),
        F.col("n_chars").cast("double").alias("lf"),
    )
    b = d.where(F.col("lang") != "en").select(
        clean.alias("ods_names_clean"), site.alias("messstelle"),
        F.when(F.col("lang") == "fr", F.lit("Datum")).otherwise(datum).alias("datum"),
        F.col("n_chars").cast("double").alias("el_lf"), F.col("lang").alias("progr"),
    )
    return {"sheet_en": a, "sheet_other": b}


@register("survey_counts")
def survey_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    plan = SR.import_plan(survey_paths(t)).select("ods_names_clean", "skip_rows")
    x = C.survey_table(survey_sheets(t), plan)
    out = x.groupBy("ods_names_clean", "skip_rows", F.year("datum").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("lf").alias("lf_sum")
    )
    return out.withColumn("skip_rows", dbl("skip_rows"))


ORACLE["survey_counts"] = r"""
WITH d AS (SELECT doc_id, lang, source, n_chars, lower(source) AS ods_names_clean,
                  'GF,Br' || CAST(doc_id AS VARCHAR) AS messstelle,
                  strftime(DATE '1991-01-01' + CAST(doc_id AS INTEGER), '%y/%m/%d') AS datum FROM documents),
s AS (SELECT ods_names_clean, messstelle, datum, CAST(n_chars AS DOUBLE) AS lf FROM d WHERE lang = 'en'
      UNION ALL
      SELECT ods_names_clean, messstelle, CASE WHEN lang = 'fr' THEN 'Datum' ELSE datum END, CAST(n_chars AS DOUBLE)
      FROM d WHERE lang <> 'en'),
k AS (SELECT * FROM s WHERE datum <> 'Datum' AND messstelle IS NOT NULL),
fn AS (SELECT DISTINCT CASE source WHEN 'src0' THEN 'cl25' WHEN 'src1' THEN 'GWNMITTE_91' WHEN 'src2' THEN 'K1_ost'
                                   WHEN 'src3' THEN 'B2-west' ELSE source END AS fname FROM documents),
plan AS (SELECT regexp_replace(lower(regexp_replace(fname, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g')
                  AS ods_names_clean,
                CASE WHEN regexp_matches(fname || '.ods',
                       '^(B[0-9]|EWGES|EWMITTEL|GWBR|JURA|K[0-9]|KREIDE|PRAERUP|UF|GF-GM|GWMGUETE)') THEN 1
                     WHEN regexp_matches(fname || '.ods', '^(GWNMITTE|GWNHOCH|GWNTIEF|Q13)') THEN 2 ELSE 0 END
                  AS skip_rows
         FROM fn),
p AS (SELECT * FROM plan WHERE NOT coalesce(ods_names_clean IN ('cl25', 'clliste', 'rupelauf', 'salzlast'), false)),
j AS (SELECT k.ods_names_clean, p.skip_rows, CAST(try_strptime('19' || k.datum, '%Y/%m/%d') AS DATE) AS datum, k.lf
      FROM p RIGHT JOIN k ON p.ods_names_clean IS NOT DISTINCT FROM k.ods_names_clean)
SELECT ods_names_clean, CAST(skip_rows AS DOUBLE) AS skip_rows, CAST(year(datum) AS INTEGER) AS "year",
       count(*) AS n, sum(lf) AS lf_sum
FROM j GROUP BY ALL
"""


@register("survey_sheets_mixed")
def survey_sheets_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet without a date, one that calls its sites ``messstellen``; file names that meet
    every skip rule of the plan."""
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    name = F.lower("source")
    for source, clean in SURVEY_CLEAN_NAMES.items():
        name = F.when(F.col("source") == source, F.lit(clean)).otherwise(name)
    site = F.concat(F.lit("GF,Br"), F.col("doc_id").cast("string"))
    datum = F.date_format(F.date_add(F.make_date(F.lit(1991), F.lit(1), F.lit(1)), F.col("doc_id").cast("int")), "yy/MM/dd")
    a = d.where(F.col("lang") == "en").select(name.alias("ods_names_clean"), site.alias("messstelle"), F.col("n_chars").cast("double").alias("lf"))
    b = d.where(F.col("lang") != "en").select(
        name.alias("ods_names_clean"), site.alias("messstellen"),
        F.when(F.col("lang") == "fr", F.lit("Datum")).otherwise(datum).alias("datum"),
        F.col("n_chars").cast("double").alias("el_lf"),
    )
    plan = SR.import_plan(survey_paths(t)).select("ods_names_clean", "skip_rows")
    x = C.survey_table({"undated": a, "other_name": b}, plan)
    out = x.groupBy("ods_names_clean", "skip_rows", F.year("datum").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("lf").alias("lf_sum")
    )
    return out.withColumns({"skip_rows": dbl("skip_rows"), "year": dbl("year")})


SURVEY_CLEAN_NAMES = {"src0": "cl25", "src1": "gwnmitte_91", "src2": "k1_ost", "src3": "b2_west"}
ORACLE["survey_sheets_mixed"] = replaced(
    ORACLE["survey_counts"],
    (
        "lower(source) AS ods_names_clean",
        "CASE source WHEN 'src0' THEN 'cl25' WHEN 'src1' THEN 'gwnmitte_91' WHEN 'src2' THEN 'k1_ost'"
        " WHEN 'src3' THEN 'b2_west' ELSE lower(source) END AS ods_names_clean",
    ),
    (
        "messstelle, datum, CAST(n_chars AS DOUBLE) AS lf FROM d WHERE lang = 'en'",
        "messstelle, NULL AS datum, CAST(n_chars AS DOUBLE) AS lf FROM d WHERE lang = 'en'",
    ),
    ('CAST(year(datum) AS INTEGER) AS "year"', 'CAST(year(datum) AS DOUBLE) AS "year"'),
    ("WHERE datum <> 'Datum' AND", "WHERE coalesce(datum, '') <> 'Datum' AND"),
)
