"""Composed flows from files and cells as delivered (T-01, T-02, C-02, C-03, C-07, C-09, C-10, C-11,
J-03 / J-04 / K-06, S-04, S-09 ... S-11, R-11, H-24, H-25, Q-A ... Q-I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cells as CL
from ..operators import filters as P
from ..operators import quality as Q
from ..session import cut_lineage, scratch_path
from ..sources import readers as SR
from ..sources import sinks as K
from ..streaming.ingest import ingest_new_files, stats_from_state
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE, replaced
from .queries import dbl, r6, register, ts
from .queries_cells import _B, _cell, _union, lab_cells
from .queries_io import _LOGGER_LONG, STAT_COLS, well_operation
from .queries_lab import _CUR_COLS, _CUR_CTE, current_lab_df, current_lab_wide, isotope_sheet
from .queries_text import abstraction_sheet


# --- T-01: a run with files that do not fit ------------------------------------------------------
def stage_mixed_loggers(t: Tables, root: str) -> str:
    """Logger files in four folders: good ones (K09), columns swapped (K10), a time that is none (K11), a fifth column (K12)."""
    e = t.events.select(
        (F.col("event_id") % 8).alias("part"),
        F.col("user_id").cast("int").alias("Geraet"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("DatumUhrzeit"),
        (F.col("value") * 100).alias("Leitfaehigkeit"),
        (F.col("value") / 10).alias("Temperatur"),
    )
    swapped = ["Geraet", "DatumUhrzeit", "Temperatur", "Leitfaehigkeit"]
    late = F.when(F.col("Geraet") % 2 == 0, F.lit("kaputt")).otherwise(F.col("DatumUhrzeit"))
    folders = {
        "K09": e.where("part < 5").drop("part"),
        "K10": e.where("part = 5").select(*swapped),
        "K11": e.where("part = 6").drop("part").withColumn("DatumUhrzeit", late),
        "K12": e.where("part = 7").drop("part").withColumn("Bemerkung", F.lit("x")),
    }
    for folder, df in folders.items():
        df.write.option("header", True).csv(f"{root}/{folder}")
    return root


def ingest_mixed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    src = stage_mixed_loggers(Tables(spark, sf_dir), scratch_path(spark, "loggers"))
    sink = scratch_path(spark, "sensor-sink")
    ingest_new_files(spark, src, sink, scratch_path(spark, "sensor-ckpt"))
    return sink, f"{sink}_quarantine"


@register("stream_quarantine")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is set aside, by folder."""
    _, quarantine = ingest_mixed(spark, sf_dir)
    folder = F.regexp_extract("file", "/([^/]*)/[^/]*$", 1)
    out = spark.read.parquet(quarantine).groupBy(folder.alias("folder"), "reason")
    return out.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_misfits").alias("n_misfits"))


# A header with the names in another order is a row that does not fit, one in each file; so are the rows below it only
# where their own cells do not fit the schema.
ORACLE["stream_quarantine"] = """
SELECT 'K11' AS folder, 'rows do not fit' AS reason, count(*) AS n_rows, count(*) FILTER (user_id % 2 = 0) AS n_misfits
FROM events WHERE event_id % 8 = 6
UNION ALL
SELECT 'K10', 'header does not fit', count(*) + 1, 1 FROM events WHERE event_id % 8 = 5
UNION ALL
SELECT 'K12', 'header does not fit', count(*) + 1, count(*) + 1 FROM events WHERE event_id % 8 = 7
"""


@register("stream_good_files")
def stream_good_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the good files of the same run."""
    sink, _ = ingest_mixed(spark, sf_dir)
    return spark.read.parquet(sink).select("sensor_id", "datum_uhrzeit", "parameter", r6("messwert").alias("messwert"))


ORACLE["stream_good_files"] = "WITH " + replaced(_LOGGER_LONG, ("FROM events", "FROM events WHERE event_id % 8 < 5")) + """
SELECT sensor_id, datum_uhrzeit, parameter, round(messwert, 6) AS messwert FROM l
"""


# --- T-02: statistics kept as a state --------------------------------------------------------------
#: Means of values with four digits often end in half a unit of the sixth; both sides round them up, in
#: whatever order their sums were made.
MEAN_SHIFT = 1e-9


@register("incremental_stats")
def incremental_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with files of their own; the statistics come from the value counts both left."""
    t = Tables(spark, sf_dir)
    src = scratch_path(spark, "loggers")
    sink, state, ckpt = (scratch_path(spark, f"sensor-{n}") for n in ("sink", "state", "ckpt"))
    for run in range(2):
        e = t.events.where(F.col("event_id") % 2 == run).select(
            F.col("user_id").cast("int").alias("Geraet"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("DatumUhrzeit"),
            (F.col("value") * 100).alias("Leitfaehigkeit"),
            (F.col("value") / 10).alias("Temperatur"),
        )
        e.write.option("header", True).csv(f"{src}/run{run}")
        ingest_new_files(spark, src, sink, ckpt, state_dir=state)
    st = stats_from_state(spark, state)
    st = st.withColumn("mean", F.col("mean") + MEAN_SHIFT)
    return st.select("sensor_id", "parameter", "datetime_min", "datetime_max", *[r6(c).alias(c) for c in STAT_COLS], "number_of_samples")


ORACLE["incremental_stats"] = "WITH " + _LOGGER_LONG + """
, c AS (SELECT sensor_id, datum_uhrzeit, parameter,
               CASE WHEN parameter = 'Leitfaehigkeit' AND messwert > 20000 THEN NULL ELSE messwert END AS v FROM l)
SELECT sensor_id, parameter, min(datum_uhrzeit) AS datetime_min, max(datum_uhrzeit) AS datetime_max,
       round(min(v), 6) AS "min", round(quantile_cont(v, 0.1), 6) AS q10, round(avg(v) + 1e-9, 6) AS mean,
       round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS q90,
       round(max(v), 6) AS "max", count(*) AS number_of_samples
FROM c GROUP BY sensor_id, parameter
"""


# --- C-07 / S-09: the lab workbook as delivered --------------------------------------------------------
LAB_KEY_HEADER = {"probe_nr": "Probe-Nr.", "messstelle": "Messstelle", "probenahme_datum": "Probenahme Datum"}


def lab_workbook(t: Tables, wide: DataFrame) -> DataFrame:
    """``wide`` as the sheet 'Analysen': titles in rows 1 to 4, the header in row 5, the last two columns at
    210 and 211, a column that is not read at 60; beside it the master data sheet of all sites."""
    wide = cut_lineage(wide).withColumns({"file_name": F.lit("labor.xlsx"), "sheet_name": F.lit("Analysen")})
    names = [c for c in wide.columns if c not in ("file_name", "sheet_name")]
    place = {n: i + 1 for i, n in enumerate(names[:-2])} | {n: 210 + i for i, n in enumerate(names[-2:])}
    row = F.col("probe_nr").cast("long") + 6
    body = wide.select(
        "file_name", "sheet_name", row.alias("row_idx"),
        F.inline(F.array(
            *[F.struct(F.lit(c).cast("long").alias("col_idx"), F.col(f"`{n}`").cast("string").alias("value")) for n, c in place.items()],
            F.struct(F.lit(60).cast("long").alias("col_idx"), F.lit("12").alias("value")),
        )),
    ).where("value is not null")
    sheet = wide.select("file_name", "sheet_name").distinct()
    head = [_cell(sheet, 5, c, LAB_KEY_HEADER.get(n, n)) for n, c in place.items()]
    head += [_cell(sheet, 5, 60, "Kalium@IC@K@mg/l"), _cell(sheet, 1, 1, "Labor"), _cell(sheet, 3, 210, "x@y@z@mg/l")]
    site = t.supplier.select(
        F.lit("labor.xlsx").alias("file_name"), F.lit("Stammdaten").alias("sheet_name"), (F.col("s_suppkey") + 2).alias("row_idx"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("name"), F.concat(F.lit("W"), F.col("s_nationkey").cast("string")).alias("werk"),
    )
    one = site.select("file_name", "sheet_name").distinct()
    sites = [_cell(one, 1, 1, "Name"), _cell(one, 1, 2, "Werk"), _cell(site, F.col("row_idx"), 1, F.col("name")), _cell(site, F.col("row_idx"), 2, F.col("werk"))]
    return cut_lineage(_union([body.select(*CL.CELL_COLUMNS), *head, *sites]))


@register("current_lab_cells")
def current_lab_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    x = C.lab_table_from_cells(lab_workbook(t, current_lab_wide(t)))
    x = x.withColumn("probe_nr", F.col("probe_nr").cast("long"))
    return x.select(*[r6(c).alias(c) if c == "numeric_value" else c for c in _CUR_COLS])


ORACLE["current_lab_cells"] = ORACLE["current_lab_table"]


# --- C-09: two labs, master data, solver input -----------------------------------------------------------
def hydrochemistry_df(t: Tables) -> DataFrame:
    lab = current_lab_df(t)
    lab = lab.withColumn("probenahme_datum", CL.S.parse_date("probenahme_datum", "yyyy-MM-dd"))
    isotopes = C.isotopes_long(isotope_sheet(t).withColumn("site_id", F.concat(F.lit("S"), "lab_id")), "crew_1", "lab_B")
    master = C.master_sites(lab_workbook(t, current_lab_wide(t)), ["werk"])
    return C.hydrochemistry(lab, isotopes, master)


@register("hydrochemistry")
def hydrochemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = hydrochemistry_df(Tables(spark, sf_dir))
    return x.select(
        "probe_nr", "messstelle", ts("probenahme_datum").alias("probenahme_datum"), "par_name", "par_name_phreeqc",
        "par_val_org", r6("numeric_value").alias("numeric_value"), "unit", "labor", "probenahme", "werk",
    )


_ISOTOPES = replaced(ORACLE["isotopes_long"], ("CAST(s_nationkey AS VARCHAR) AS messstelle", "'S' || CAST(s_suppkey AS VARCHAR) AS messstelle"))
ORACLE["hydrochemistry"] = _CUR_CTE + ", iso AS (" + _ISOTOPES + """),
m AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS messstelle, 'W' || CAST(s_nationkey AS VARCHAR) AS werk FROM supplier),
u AS (
  SELECT CAST(probe_nr AS VARCHAR) AS probe_nr, messstelle, CAST(CAST(probenahme_datum AS DATE) AS TIMESTAMP) AS probenahme_datum,
         par_name, par_name_phreeqc, par_val_org, round(numeric_value, 6) AS numeric_value, unit, labor, NULL AS probenahme FROM cur
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, par_name, NULL, par_val_org, numeric_value, NULL, labor, probenahme FROM iso)
SELECT u.*, m.werk FROM u LEFT JOIN m ON u.messstelle = m.messstelle
"""

SOLVER_COLUMNS = ("Cl", "Na", "pH", "temp")


@register("solver_wide")
def solver_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lab and isotopes to the solver's wide input; the samples have every name once."""
    wide, _ = C.solver_wide(C.solver_data(hydrochemistry_df(Tables(spark, sf_dir))), SOLVER_COLUMNS)
    return wide.select("solution", *[r6(n).alias(n) for n in SOLVER_COLUMNS])


ORACLE["solver_wide"] = _CUR_CTE + """
SELECT CAST(probe_nr AS VARCHAR) AS solution, """ + ", ".join(
    f"round(max(CASE WHEN par_name_phreeqc = '{n}' THEN numeric_value END), 6) AS \"{n}\"" for n in SOLVER_COLUMNS
) + """
FROM cur WHERE coalesce(length(par_name_phreeqc), 0) > 0 GROUP BY probe_nr
"""


@register("solver_left_out")
def solver_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solver names that the wide input has no column for."""
    return C.solver_wide(C.solver_data(hydrochemistry_df(Tables(spark, sf_dir))), SOLVER_COLUMNS)[1]


ORACLE["solver_left_out"] = _CUR_CTE + """
SELECT par_name_phreeqc, count(*) AS n FROM cur
WHERE coalesce(length(par_name_phreeqc), 0) > 0 AND par_name_phreeqc NOT IN ('Cl', 'Na', 'pH', 'temp') GROUP BY par_name_phreeqc
"""


# --- C-02 / C-03 -------------------------------------------------------------------------------------------
def well_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(series, sensor metadata, files): a sensor per user, a file per nation and a well per file."""
    kind = F.when(F.col("event_type") == "view", F.lit("Leitfaehigkeit")).otherwise(F.lit("Temperatur"))
    long = t.events.select(
        F.concat(F.lit("K/"), (F.col("user_id") % 25).cast("string"), F.lit(".csv")).alias("file"),
        F.col("user_id").cast("int").alias("sensor_id"),
        F.col("ts").alias("datum_uhrzeit"),
        kind.alias("parameter"),
        (F.col("value") * 100).alias("messwert"),
    )
    metadata = t.customer.select(
        F.col("c_custkey").cast("int").alias("sensor_id"), F.col("c_nationkey").alias("brunnen_nummer"),
        (F.col("c_nationkey") + 20.5).alias("einbau_sensor_muGOK"),
    )
    files = t.nation.select(
        F.concat(F.lit("K/"), F.col("n_nationkey").cast("string"), F.lit(".csv")).alias("sftp_path"),
        F.lit("K").alias("galerie"), F.col("n_nationkey").alias("brunnen_nummer"),
    )
    return long, metadata, files


def _well_9(t: Tables) -> tuple[DataFrame, DataFrame]:
    return C.well_with_operation(*well_inputs(t), well_operation(t), 9, "Leitfaehigkeit", "2024-01-10", "2024-01-25")


@register("well_series")
def well_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, _ = _well_9(Tables(spark, sf_dir))
    return series.select("file", "sensor_id", "datum_uhrzeit", "parameter", r6("messwert").alias("messwert"), "einbau_sensor_muGOK", "galerie", "brunnen_nummer")


ORACLE["well_series"] = """
WITH e AS (SELECT 'K/' || CAST(user_id % 25 AS VARCHAR) || '.csv' AS file, CAST(user_id AS INTEGER) AS sensor_id, ts AS datum_uhrzeit,
                  'Leitfaehigkeit' AS parameter, CASE WHEN value * 100 > 20000 THEN NULL ELSE value * 100 END AS messwert
           FROM events WHERE event_type = 'view')
SELECT e.file, e.sensor_id, e.datum_uhrzeit, e.parameter, round(e.messwert, 6) AS messwert,
       CAST(c_nationkey + 20.5 AS DOUBLE) AS "einbau_sensor_muGOK", 'K' AS galerie, CAST(9 AS INTEGER) AS brunnen_nummer
FROM e LEFT JOIN customer ON c_custkey = sensor_id
WHERE file = 'K/9.csv' AND datum_uhrzeit >= TIMESTAMP '2024-01-10' AND datum_uhrzeit < TIMESTAMP '2024-01-26'
"""


@register("well_volumes")
def well_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily volumes of well 9 and of the field with their rolling means, in a window of days."""
    t = Tables(spark, sf_dir)
    _, volumes = C.well_with_operation(*well_inputs(t), well_operation(t), 9, "Leitfaehigkeit", "1995-03-01", "1996-09-30")
    return volumes.select("is_field", dbl("brunnen_nummer").alias("brunnen_nummer"), ts("bwb_datum").alias("bwb_datum"), "n",
                          r6("volume").alias("volume"), r6("roll_7").alias("roll_7"), r6("roll_10").alias("roll_10"))


ORACLE["well_volumes"] = (
    "SELECT * FROM (" + ORACLE["well_operation_series"] + """)
WHERE bwb_datum BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1996-09-30' AND (is_field OR brunnen_nummer = 9)
"""
)


@register("chain_titles")
def chain_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-03: plots by well and parameter with title, file name and the number of their values since installation."""
    long, metadata, _ = well_inputs(Tables(spark, sf_dir))
    x = C.titled_series(long, metadata, since="2024-01-15 00:00:00")
    return x.where("title is not null").groupBy("title", "plot_name", "unit").agg(F.count(F.lit(1)).alias("n"))


ORACLE["chain_titles"] = """
SELECT 'Parameter: ' || p || ', Brunnen: K' || CAST(c_nationkey AS VARCHAR) AS title,
       p || '_K' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS plot_name,
       CASE p WHEN 'Leitfaehigkeit' THEN 'µS/cm' ELSE '°C' END AS unit, count(*) AS n
FROM (SELECT CASE event_type WHEN 'view' THEN 'Leitfaehigkeit' ELSE 'Temperatur' END AS p, user_id FROM events
      WHERE ts >= TIMESTAMP '2024-01-15')
     JOIN customer ON user_id = c_custkey
GROUP BY ALL
"""


# --- C-10: survey sheets from cells -------------------------------------------------------------------------
SURVEY_FILES = {"src0": "GWNMITTE_91", "src1": "K1_ost", "src2": "B2-west", "src3": "sued"}


def survey_cells(t: Tables) -> DataFrame:
    """One sheet per source: skipped rows with the programme, the header, a row per document and, in one
    of them, header repeats; dates and the name of the site column differ."""
    name = F.col("source")
    for source, file in SURVEY_FILES.items():
        name = F.when(F.col("source") == source, F.lit(file)).otherwise(name)
    skip = F.when(name.startswith("GWNMITTE"), 2).when(name.rlike("^(K[0-9]|B[0-9])"), 1).otherwise(0)
    d = t.documents.select(
        F.concat(name, F.lit(".ods")).alias("file_name"), F.lit("Tabelle1").alias("sheet_name"), skip.alias("skip"), "doc_id", "lang",
        F.col("n_chars").cast("string").alias("lf"), F.concat(F.lit("GF,Br"), F.col("doc_id").cast("string")).alias("site"),
        F.date_format(F.date_add(F.make_date(F.lit(1991), F.lit(1), F.lit(1)), F.col("doc_id").cast("int")), "yy/MM/dd").alias("datum"),
    )
    sheets = d.select("file_name", "sheet_name", "skip").distinct()
    undated = F.col("file_name") == "sued.ods"
    header = F.col("skip") + 1
    site_name = F.when(F.col("file_name") == "K1_ost.ods", F.lit("Messstellen")).otherwise(F.lit("Messstelle"))
    head = [_cell(sheets, header, 1, site_name), _cell(sheets, header, 3, "El. LF"), _cell(sheets.where(~undated), header, 2, "Datum")]
    programme = [_cell(sheets.where(F.col("skip") >= i), i, 1, f"Programm {i}") for i in (1, 2)]
    row = header + 1 + F.col("doc_id")
    body = [
        _cell(d.where(F.col("lang") != "de"), row, 1, F.col("site")),
        _cell(d.where(~undated), row, 2, F.when(F.col("lang") == "fr", F.lit("Datum")).otherwise(F.col("datum"))),
        _cell(d, row, 3, F.col("lf")),
    ]
    return cut_lineage(_union([*head, *programme, *body]))


@register("survey_from_cells")
def survey_from_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = survey_cells(Tables(spark, sf_dir))
    plan = SR.import_plan(cells.select(F.col("file_name").alias("ods_paths")).distinct())
    x = C.survey_from_cells(cells, plan, ["lf", "el_lf"])
    return x.select("ods_names_clean", "skip_rows", "messprogramm", "messstelle", ts("datum").alias("datum"), "lf")


ORACLE["survey_from_cells"] = r"""
WITH d AS (SELECT doc_id, lang, n_chars, CASE source WHEN 'src0' THEN 'GWNMITTE_91' WHEN 'src1' THEN 'K1_ost' WHEN 'src2' THEN 'B2-west'
                                               WHEN 'src3' THEN 'sued' ELSE source END AS f FROM documents),
x AS (SELECT *, CASE WHEN f = 'GWNMITTE_91' THEN 2 WHEN f IN ('K1_ost', 'B2-west') THEN 1 ELSE 0 END AS skip FROM d),
k AS (SELECT *, strftime(DATE '1991-01-01' + CAST(doc_id AS INTEGER), '%y/%m/%d') AS t FROM x
      WHERE lang <> 'de' AND (f = 'sued' OR lang <> 'fr'))
SELECT trim(regexp_replace(lower(f), '[^a-z0-9]+', '_', 'g'), '_') AS ods_names_clean, CAST(skip AS INTEGER) AS skip_rows,
       CASE skip WHEN 2 THEN 'Programm 1@Programm 2' WHEN 1 THEN 'Programm 1' END AS messprogramm,
       'GF,Br' || CAST(doc_id AS VARCHAR) AS messstelle,
       CASE WHEN f <> 'sued' THEN CAST(CAST(try_strptime('19' || t, '%Y/%m/%d') AS DATE) AS TIMESTAMP) END AS datum,
       CAST(n_chars AS VARCHAR) AS lf
FROM k
"""


# --- C-11: one waterworks as German CSV ----------------------------------------------------------------------
@register("waterworks_csv")
def waterworks_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = P.rename_columns(abstraction_sheet(Tables(spark, sf_dir)), {f"NATION_{k}": f"FRIEDRICH_{k}" for k in (3, 17)})
    x = C.waterworks_abstraction(sheet, "FRI")
    path = K.write_german_csv(x, scratch_path(spark, "waterworks"))
    return spark.read.option("header", True).option("sep", ";").schema(
        "year int, Wasserwerk string, Foerdermenge_m3 string, werk string, Foerdermenge_Mio_m3 string"
    ).csv(path)


ORACLE["waterworks_csv"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year", replace(n_name, 'NATION', 'FRIEDRICH') AS Wasserwerk,
       replace(printf('%.2f', sum(o_totalprice)), '.', ',') AS Foerdermenge_m3, 'FRI' AS werk,
       replace(printf('%.2f', sum(o_totalprice) / 1e6), '.', ',') AS Foerdermenge_Mio_m3
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_3', 'NATION_17')
GROUP BY ALL
"""


# --- J-03 / J-04 / K-06 / S-10: lookup or template ------------------------------------------------------------
def parameter_workbook(t: Tables) -> DataFrame:
    """The sheet 'nur Parameterliste': a row per length of part names."""
    sizes = t.part.select(F.length("p_name").alias("n")).distinct().select(
        F.lit("parameter.xlsx").alias("file_name"), F.lit("nur Parameterliste").alias("sheet_name"), "n"
    )
    sheet = sizes.select("file_name", "sheet_name").distinct()
    row = F.col("n") + 2
    return _union([
        _cell(sheet, 1, 1, "Para Id"), _cell(sheet, 1, 2, "Para Kurzname"),
        _cell(sizes, row, 1, F.col("n").cast("string")), _cell(sizes, row, 2, F.concat(F.lit("len_"), F.col("n").cast("string"))),
    ])


def lookup_run(spark: SparkSession, sf_dir: str, with_lookup: bool) -> tuple[DataFrame, str]:
    """The flow over part names; the lookup maps those without 'ring', or its file is missing."""
    t = Tables(spark, sf_dir)
    data = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", F.col("p_name").alias("VariableName_org"))
    path, template = scratch_path(spark, "lookup"), scratch_path(spark, "template")
    if with_lookup:
        known = t.part.where(~F.col("p_name").contains("ring")).select(F.col("p_name").alias("VariableName_org"), F.length("p_name").alias("para_id"))
        known.distinct().write.option("header", True).csv(path)
    parameters = C.parameter_list(parameter_workbook(t), ["para_id", "para_kurzname"])
    mapped, written = C.parameters_or_template(data, path, parameters, template)
    return mapped, written


@register("lookup_flow")
def lookup_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_run(spark, sf_dir, True)[0]


ORACLE["lookup_flow"] = """
SELECT l_orderkey, l_linenumber, p_name AS VariableName_org, CAST(length(p_name) AS INTEGER) AS para_id,
       'len_' || CAST(length(p_name) AS VARCHAR) AS para_kurzname
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE NOT contains(p_name, 'ring')
"""


@register("lookup_missing_template")
def lookup_missing_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a lookup file every name is in the template that is written."""
    path = lookup_run(spark, sf_dir, False)[1]
    return spark.read.schema("VariableName_org string, para_id string").option("header", True).csv(path)


ORACLE["lookup_missing_template"] = """
SELECT DISTINCT p_name AS VariableName_org, CAST(NULL AS VARCHAR) AS para_id FROM lineitem JOIN part ON l_partkey = p_partkey
"""


# --- S-04 / Q-B ------------------------------------------------------------------------------------------------
def logger_paths(t: Tables) -> DataFrame:
    """Paths of logger files, one per customer; every tenth has a name that is none."""
    key = F.col("c_custkey").cast("string")
    good = F.concat(F.lit("LF_"), F.lpad(key, 7, "4"), F.lit("-2023-05-10-1100.csv"))
    folder = F.concat(F.lit("/data/loggers/K"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("/"))
    return t.customer.select(F.concat(folder, F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("readme"), key, F.lit(".csv"))).otherwise(good)).alias("path"))


@register("logger_inventory")
def logger_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = SR.logger_inventory(logger_paths(Tables(spark, sf_dir)), "/data/loggers")
    watched = x.withColumn("is_bad", Q.is_bad_logger_name())
    return watched.select("sftp_path", "galerie", dbl("brunnen_nummer").alias("brunnen_nummer"), dbl("sensor_id").alias("sensor_id"), "is_bad")


ORACLE["logger_inventory"] = """
SELECT CASE WHEN c_custkey % 10 = 0 THEN 'K' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '/readme' || CAST(c_custkey AS VARCHAR) || '.csv'
            ELSE 'K' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '/LF_' || lpad(CAST(c_custkey AS VARCHAR), 7, '4') || '-2023-05-10-1100.csv' END
         AS sftp_path,
       'K' AS galerie, CAST(c_nationkey AS DOUBLE) AS brunnen_nummer,
       CASE WHEN c_custkey % 10 <> 0 THEN CAST(lpad(CAST(c_custkey AS VARCHAR), 7, '4') AS DOUBLE) END AS sensor_id,
       c_custkey % 10 = 0 AS is_bad
FROM customer
"""
