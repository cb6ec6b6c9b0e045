"""Text parsing, reshaping, lookup and quality queries over the driver tables
(H-01 ... H-07, H-21 ... H-25, A-06, O-01, O-03, U-02, R-07, R-08, J-05, J-09,
J-11, S-12, Q-A, Q-H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import stats as A
from ..operators.ranking import sort_rank
from ..sources.readers import import_plan
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE
from .queries import dbl, r6, register, sensor_series, ts

PAT = S.LOGGER_FILE_PATTERN


def padded(name: str, width: int):
    """A number as text with leading zeros; a longer number keeps all its digits."""
    text = F.col(name).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


# --- H-01 ... H-04 / Q-B: logger file names -----------------------------------------
def logger_paths(t: Tables) -> DataFrame:
    o = t.orders
    folder = F.concat(F.upper(F.substring("o_orderstatus", 1, 1)), (F.year("o_orderdate") - 1990).cast("string"))
    stem = F.when(F.col("o_orderstatus") == "P", F.lit("readme")).otherwise(
        F.concat(
            F.when(F.col("o_orderpriority") < "3", F.lit("LF_")).otherwise(F.lit("")),
            padded("o_orderkey", 7),
            F.when(F.col("o_totalprice") > 200000, F.lit("-")).otherwise(F.lit("_")),
            F.date_format("o_orderdate", "yyyy-MM-dd-HHmm"),
        )
    )
    return o.select(F.concat(folder, F.lit("/"), stem, F.lit(".csv")).alias("sftp_path"))


@register("file_names")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = logger_paths(Tables(spark, sf_dir))
    x = x.withColumns({"folder": S.path_folder("sftp_path"), "file": S.path_file("sftp_path")})
    x = x.withColumns({
        "galerie": S.gallery_of_folder("folder"),
        "brunnen_nummer": S.well_of_folder("folder"),
        "file_stem": S.drop_extension("file"),
    })
    parts = S.logger_parts("file_stem")
    return x.select(
        "sftp_path", "folder", "file", "galerie", "brunnen_nummer", parts["prefix"].alias("prefix"),
        dbl(parts["sensor_id"]).alias("sensor_id"), dbl(parts["sensor_endnummer"]).alias("sensor_endnummer"),
        parts["datum_uhrzeit"].alias("datum_uhrzeit"),
        F.coalesce(F.col("file_stem").rlike(PAT), F.lit(False)).alias("is_valid"),
    )


ORACLE["file_names"] = rf"""
WITH p AS (
  SELECT upper(substr(o_orderstatus, 1, 1)) || CAST(year(o_orderdate) - 1990 AS VARCHAR) || '/' ||
         CASE WHEN o_orderstatus = 'P' THEN 'readme'
              ELSE (CASE WHEN o_orderpriority < '3' THEN 'LF_' ELSE '' END)
                   || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, len(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')
                   || CASE WHEN o_totalprice > 200000 THEN '-' ELSE '_' END
                   || strftime(o_orderdate, '%Y-%m-%d-%H%M') END || '.csv' AS sftp_path
  FROM orders),
f AS (SELECT sftp_path, regexp_extract(sftp_path, '^(.*)/[^/]*$', 1) AS folder,
             regexp_extract(sftp_path, '([^/]*)$', 1) AS file FROM p),
g AS (SELECT *, substr(folder, 1, 1) AS galerie, TRY_CAST(substr(folder, 2) AS INTEGER) AS brunnen_nummer,
             regexp_replace(file, '\.[^./]*$', '') AS stem FROM f),
h AS (SELECT *, coalesce(regexp_matches(stem, '{PAT}'), false) AS ok FROM g)
SELECT sftp_path, folder, file, galerie, brunnen_nummer,
       CASE WHEN ok THEN regexp_extract(stem, '{PAT}', 1) END AS prefix,
       CAST(CASE WHEN ok THEN CAST(regexp_extract(stem, '{PAT}', 2) AS INTEGER) END AS DOUBLE) AS sensor_id,
       CAST(CASE WHEN ok THEN CAST(regexp_extract(stem, '{PAT}', 3) AS INTEGER) END AS DOUBLE) AS sensor_endnummer,
       CASE WHEN ok THEN strptime(regexp_extract(stem, '{PAT}', 4), '%Y-%m-%d-%H%M') - INTERVAL 1 HOUR END
         AS datum_uhrzeit,
       ok AS is_valid
FROM h
"""


# --- H-05 / J-05 ------------------------------------------------------------------------
@register("site_ids")
def site_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")).otherwise(
        F.concat_ws(" ", F.col("c_nationkey").cast("string"), "c_mktsegment")
    )
    df = t.customer.select("c_custkey", text.alias("sheet_text")).withColumn("site_id", S.site_id("sheet_text"))
    sites = t.nation.select(F.col("n_nationkey").alias("interne_nr"), "n_name")
    return J.add_site_metadata(df, sites)


ORACLE["site_ids"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment
                                  ELSE CAST(c_nationkey AS VARCHAR) || ' ' || c_mktsegment END AS sheet_text
           FROM customer),
s AS (SELECT c_custkey, sheet_text, CAST(nullif(regexp_extract(sheet_text, '^[0-9]{1,4}'), '') AS DOUBLE) AS site_id
      FROM c)
SELECT s.c_custkey, s.sheet_text, s.site_id, n_name
FROM s LEFT JOIN nation ON CAST(n_nationkey AS DOUBLE) IS NOT DISTINCT FROM s.site_id
"""


# --- H-06 / H-07 -------------------------------------------------------------------------
@register("well_codes")
def well_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Tables(spark, sf_dir).supplier
    letter = F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.col("s_nationkey") + 1, F.lit(1))
    code = F.concat(
        F.lit("FRI"), letter, padded("s_suppkey", 4), F.lit("-"),
        F.when(F.col("s_acctbal") >= 0, F.lit("A")).otherwise(F.lit("B")), F.lit("-"),
        (F.col("s_nationkey") + 1990).cast("string"), F.lit("V"),
    )
    x = s.select("s_suppkey", "s_name", code.alias("code"))
    return x.withColumns(S.well_code_parts("code")).withColumn("werk", S.waterworks_code("s_name")).drop("s_name")


ORACLE["well_codes"] = """
WITH c AS (
  SELECT s_suppkey, s_name,
         'FRI' || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', s_nationkey + 1, 1) || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, len(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0')
         || '-' || CASE WHEN s_acctbal >= 0 THEN 'A' ELSE 'B' END || '-' || CAST(s_nationkey + 1990 AS VARCHAR)
         || 'V' AS code
  FROM supplier)
SELECT s_suppkey, code,
       replace(substr(code, 1, 3), '-', '') AS wasserwerk,
       upper(replace(substr(code, 4, 1), '-', '')) AS galerie,
       TRY_CAST(replace(substr(code, 5, 5), '-', '') AS INTEGER) AS brunnen_nummer,
       replace(substr(code, 10, 1), '-', '') AS unbekannter_buchstabe,
       TRY_CAST(replace(substr(code, 12, 4), '-', '') AS INTEGER) AS brunnen_baujahr,
       replace(substr(code, 16, 1), '-', '') AS brunnen_bauart,
       upper(substr(s_name, 1, 3)) AS werk
FROM c
"""


# --- H-21 ... H-23 / A-06 (survey site names) ----------------------------------------------
def survey_texts(t: Tables) -> DataFrame:
    p = t.part
    ptype, size = F.col("p_type"), F.col("p_size").cast("string")
    objekt = (
        F.when(ptype == "ECONOMY", F.concat(F.lit("GF,Br"), size))
        .when(ptype == "STANDARD", F.concat(F.lit("K-Gal.,Br"), size))
        .when(ptype == "SMALL", F.concat(F.lit("GO,,"), size))
        .when(ptype == "LARGE", F.lit("Go"))
        .otherwise(F.concat(F.lit("GE,Br0"), size))
    )
    bhrgs = F.concat(F.col("p_partkey").cast("string"), F.lit("/"), F.substr(F.col("p_brand"), F.lit(7)))
    rohr = F.when(F.col("p_size") < 10, F.concat(F.lit("0"), size)).otherwise(size)
    ms = F.concat(objekt, F.lit(" "), bhrgs, F.when(ptype == "MEDIUM", F.lit("")).otherwise(F.concat(F.lit("  "), rohr)))
    return p.select("p_partkey", ms.alias("messstelle"))


_SURVEY_CTE = r"""
WITH m AS (
  SELECT p_partkey,
         CASE p_type WHEN 'ECONOMY' THEN 'GF,Br' || CAST(p_size AS VARCHAR)
                     WHEN 'STANDARD' THEN 'K-Gal.,Br' || CAST(p_size AS VARCHAR)
                     WHEN 'SMALL' THEN 'GO,,' || CAST(p_size AS VARCHAR)
                     WHEN 'LARGE' THEN 'Go'
                     ELSE 'GE,Br0' || CAST(p_size AS VARCHAR) END
         || ' ' || CAST(p_partkey AS VARCHAR) || '/' || substr(p_brand, 7)
         || CASE WHEN p_type = 'MEDIUM' THEN ''
                 ELSE '  ' || CASE WHEN p_size < 10 THEN '0' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END
            END AS messstelle
  FROM part),
s AS (SELECT *, string_split_regex(messstelle, '\s{1,9}') AS l FROM m),
t AS (SELECT p_partkey, messstelle, coalesce(l[1], '') AS objekt, coalesce(l[2], '') AS bhrgs_nr_jahr,
             coalesce(l[3], '') AS rohr_raw FROM s),
u AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(objekt,
                'GF|F-Gal.', 'Gal_F', 'g'), 'GE|E-Gal', 'Gal_E', 'g'), 'GI|I-Gal.', 'Gal_I', 'g'),
                'GG|G-Gal.|G-Gal', 'Gal_G', 'g'), 'GK|K-Gal.', 'Gal_K', 'g'), '^Go$', 'Gal_O', 'g'),
                'GH|H-Gal.', 'Gal_H', 'g'), 'GO', 'Gal_O', 'g'), 'GL|L-Gal.', 'Gal_L', 'g'),
                'GM|M-Gal.', 'Gal_M', 'g'), ',,', ',', 'g') AS ms FROM t),
sites AS (
  SELECT p_partkey, messstelle, objekt, bhrgs_nr_jahr,
         string_split(bhrgs_nr_jahr, '/')[1] AS bhrgs_nr, string_split(bhrgs_nr_jahr, '/')[2] AS jahr,
         regexp_replace(rohr_raw, '^0', 'O') AS rohr,
         split_part(ms, ',', 1) AS brunnen_galerie,
         regexp_replace(CASE WHEN strpos(ms, ',') > 0 THEN substr(ms, strpos(ms, ',') + 1) ELSE '' END, '^Br', '')
           AS brunnen_id
  FROM u)
"""


@register("site_names")
def site_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.survey_sites(survey_texts(Tables(spark, sf_dir)))


ORACLE["site_names"] = _SURVEY_CTE + "SELECT * FROM sites"


@register("site_counts")
def site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.count_by(C.survey_sites(survey_texts(Tables(spark, sf_dir))), ["brunnen_galerie", "rohr"], "n")


ORACLE["site_counts"] = _SURVEY_CTE + "SELECT brunnen_galerie, rohr, count(*) AS n FROM sites GROUP BY ALL"


# --- O-01 / O-03 / H-25 / J-01 / C-03 ------------------------------------------------------------
PARAMETER_NAMES = {"view": "Leitfaehigkeit", "click": "Temperatur"}


def chain_long(t: Tables) -> DataFrame:
    s = sensor_series(t)
    name = F.col("parameter")
    for k, v in PARAMETER_NAMES.items():
        name = F.when(F.col("parameter") == k, F.lit(v)).otherwise(name)
    return s.withColumn("parameter", name)


def sensor_metadata(t: Tables) -> DataFrame:
    """Sensor metadata (F-1 shape) from ``customer``: sensor = customer key."""
    return t.customer.select(
        F.col("c_custkey").alias("sensor_id"),
        F.col("c_nationkey").alias("brunnen_nummer"),
        (F.col("c_nationkey").cast("double") + F.lit(20.5)).alias("einbau_sensor_muGOK"),
    )


@register("series_labels")
def series_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    x = C.chain_series(chain_long(t), sensor_metadata(t))
    x = sort_rank(x, ["parameter", "sensor_id", "datum_uhrzeit", "event_id"], "rn")
    return x.select("event_id", "sensor_id", "parameter", "datum_uhrzeit", "messwert", "label", "unit", "rn")


ORACLE["series_labels"] = """
WITH e AS (
  SELECT event_id, user_id AS sensor_id,
         CASE event_type WHEN 'view' THEN 'Leitfaehigkeit' WHEN 'click' THEN 'Temperatur' ELSE event_type END
           AS parameter, ts AS datum_uhrzeit, value AS messwert FROM events)
SELECT event_id, sensor_id, parameter, datum_uhrzeit, messwert,
       CAST(CAST(c_nationkey AS DOUBLE) + 20.5 AS VARCHAR) || ' m uGOK (' || CAST(sensor_id AS VARCHAR) || ')' AS label,
       CASE parameter WHEN 'Leitfaehigkeit' THEN 'µS/cm' WHEN 'Temperatur' THEN '°C' END AS unit,
       row_number() OVER (ORDER BY parameter, sensor_id, datum_uhrzeit, event_id) AS rn
FROM e LEFT JOIN customer ON sensor_id IS NOT DISTINCT FROM c_custkey
"""


# --- U-02 ---------------------------------------------------------------------------------------------
@register("append_sorted")
def append_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")
    out = R.append_strict(li.where(F.col("l_linestatus") == "O"), li.where(F.col("l_linestatus") == "F"))
    return sort_rank(out, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"], "rn")


ORACLE["append_sorted"] = """
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus) AS rn
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM lineitem WHERE l_linestatus = 'O'
      UNION ALL
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM lineitem WHERE l_linestatus = 'F')
"""


# --- R-07 / J-08 / H-07 / P-03 and R-08 / H-26 / C-11 -----------------------------------------------------
def _orders_by_nation(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    j = J.keyed_join(o, t.customer, ["o_custkey"], ["c_custkey"], columns=["c_nationkey"])
    return J.keyed_join(j, t.nation, ["c_nationkey"], ["n_nationkey"], columns=["n_name"])


def _nation_names(t: Tables) -> list[str]:
    # The column list of a wide sheet: names of a lookup table (bounded).
    return sorted(r[0] for r in t.nation.select("n_name").distinct().collect())


def abstraction_sheet(t: Tables) -> DataFrame:
    """Waterworks sheet: one row per year, one column per waterworks, plus
    an unnamed '..n' column."""
    names = _nation_names(t)
    wide = _orders_by_nation(t).groupBy(F.year("o_orderdate").alias("Jahr")).pivot("n_name", names).agg(
        F.sum("o_totalprice")
    )
    return wide.withColumn(f"..{len(names) + 2}", F.lit(None).cast("double"))


@register("abstraction_long")
def abstraction_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = R.abstraction_long(abstraction_sheet(Tables(spark, sf_dir)), "Jahr")
    return x.withColumn("Foerdermenge_m3", r6("Foerdermenge_m3"))


ORACLE["abstraction_long"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year", n_name AS Wasserwerk,
       round(sum(o_totalprice), 6) AS Foerdermenge_m3, upper(substr(n_name, 1, 3)) AS werk
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL
"""


def gallery_sheet(t: Tables) -> DataFrame:
    names = _nation_names(t)
    x = _orders_by_nation(t).withColumn("gal", F.concat(F.lit("FRI "), "n_name"))
    wide = x.groupBy(F.year("o_orderdate").alias("year")).pivot("gal", [f"FRI {n}" for n in names]).agg(
        F.sum("o_totalprice")
    )
    total = x.groupBy(F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("Summe"))
    return wide.join(total, "year")


@register("gallery_long")
def gallery_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = C.gallery_abstraction(gallery_sheet(Tables(spark, sf_dir)))
    return x.withColumns({
        "date": ts("date"),
        "foerdermenge_m3": r6("foerdermenge_m3"),
        "foerdermenge_mio_m3": r6("foerdermenge_mio_m3"),
    })


ORACLE["gallery_long"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year",
       CAST(make_date(CAST(year(o_orderdate) AS INTEGER), 12, 31) AS TIMESTAMP) AS date,
       n_name AS galerie, round(sum(o_totalprice), 6) AS foerdermenge_m3, 'FRI' AS werk,
       round(sum(o_totalprice) / 1e6, 6) AS foerdermenge_mio_m3
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY ALL
"""


# --- J-05 / J-09 / J-12 / J-15 with NULL keys ----------------------------------------------------------
@register("lookup_joins")
def lookup_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cust = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_nationkey")).alias("nationkey"),
    )
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    unknown = t.nation.agg(F.lit(None).cast("int").alias("nationkey"), F.lit("UNKNOWN").alias("n_name"))
    lookup = nations.unionByName(unknown)
    o = J.keyed_join(t.orders.select("o_orderkey", "o_custkey"), cust, ["o_custkey"], ["c_custkey"])
    o = J.keyed_join(o, lookup, ["nationkey"])
    return o.withColumn("nationkey", dbl("nationkey"))


ORACLE["lookup_joins"] = """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS nationkey
           FROM customer),
lk AS (SELECT n_nationkey AS nationkey, n_name FROM nation UNION ALL SELECT NULL, 'UNKNOWN')
SELECT o_orderkey, o_custkey, CAST(c.nationkey AS DOUBLE) AS nationkey, lk.n_name
FROM orders LEFT JOIN c ON o_custkey IS NOT DISTINCT FROM c.c_custkey
            LEFT JOIN lk ON c.nationkey IS NOT DISTINCT FROM lk.nationkey
"""


# --- J-11 / S-12 ---------------------------------------------------------------------------------------
SOURCE_FILE_NAMES = {"src0": "cl25", "src1": "GWNMITTE_91", "src2": "K1_ost", "src3": "B2-west"}


def survey_paths(t: Tables) -> DataFrame:
    src = F.col("source")
    name = src
    for k, v in SOURCE_FILE_NAMES.items():
        name = F.when(src == k, F.lit(v)).otherwise(name)
    return t.documents.select(F.concat(F.lit("/data/survey/"), name, F.lit(".ods")).alias("ods_paths")).distinct()


@register("plan_right_join")
def plan_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    plan = import_plan(survey_paths(t))
    src = F.col("source")
    clean = F.lower(src)
    for k, v in SOURCE_FILE_NAMES.items():
        clean = F.when(src == k, F.lit(v.lower().replace("-", "_"))).otherwise(clean)
    data = t.documents.select("doc_id", "lang", clean.alias("ods_names_clean"))
    out = J.keyed_join(plan, data, ["ods_names_clean"], how="right")
    return out.withColumn("skip_rows", dbl("skip_rows"))


ORACLE["plan_right_join"] = r"""
WITH d AS (
  SELECT doc_id, lang, source,
         CASE source WHEN 'src0' THEN 'cl25' WHEN 'src1' THEN 'GWNMITTE_91' WHEN 'src2' THEN 'K1_ost'
                     WHEN 'src3' THEN 'B2-west' ELSE source END AS fname
  FROM documents),
plan AS (
  SELECT DISTINCT '/data/survey/' || fname || '.ods' AS ods_paths, fname || '.ods' AS ods_files,
         regexp_replace(lower(regexp_replace(fname, '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g') AS ods_names_clean,
         CASE WHEN regexp_matches(fname || '.ods', '^(B[0-9]|EWGES|EWMITTEL|GWBR|JURA|K[0-9]|KREIDE|PRAERUP|UF|GF-GM|GWMGUETE)')
              THEN 1
              WHEN regexp_matches(fname || '.ods', '^(GWNMITTE|GWNHOCH|GWNTIEF|Q13)') THEN 2 ELSE 0 END AS skip_rows
  FROM d),
p AS (SELECT * FROM plan WHERE NOT coalesce(ods_names_clean IN ('cl25', 'clliste', 'rupelauf', 'salzlast'), false))
SELECT p.ods_paths, p.ods_files, coalesce(p.ods_names_clean, x.ods_names_clean) AS ods_names_clean,
       CAST(p.skip_rows AS DOUBLE) AS skip_rows,
       x.doc_id, x.lang
FROM p RIGHT JOIN (SELECT doc_id, lang, lower(replace(fname, '-', '_')) AS ods_names_clean FROM d) x
  ON p.ods_names_clean IS NOT DISTINCT FROM x.ods_names_clean
"""


# --- Q-A / Q-H / Q-I -------------------------------------------------------------------------------------------
def _supplier_files(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_suppkey").alias("file"), "l_orderkey", "l_linenumber")


@register("quality_status")
def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _supplier_files(Tables(spark, sf_dir))
    Q.require_rows(x, "lineitem")
    dup = Q.duplicated_samples(x, ["file", "l_orderkey", "l_linenumber"])
    return Q.group_status(x, "file", {"dup": dup})


ORACLE["quality_status"] = """
WITH d AS (SELECT l_suppkey AS file, l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1),
s AS (SELECT l_suppkey AS file, count(*) AS n_rows FROM lineitem GROUP BY 1),
v AS (SELECT file, count(*) AS n_dup FROM d GROUP BY 1)
SELECT s.file, s.n_rows, CAST(coalesce(v.n_dup, 0) AS BIGINT) AS n_dup,
       CASE WHEN coalesce(v.n_dup, 0) > 0 THEN 'failed' ELSE 'ok' END AS status
FROM s LEFT JOIN v ON s.file = v.file
"""


@register("good_groups")
def good_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _supplier_files(Tables(spark, sf_dir))
    dup = Q.duplicated_samples(x, ["file", "l_orderkey", "l_linenumber"])
    return Q.keep_good_groups(x, Q.group_status(x, "file", {"dup": dup}), "file")


ORACLE["good_groups"] = """
WITH bad AS (SELECT DISTINCT l_suppkey AS file FROM lineitem GROUP BY l_suppkey, l_orderkey, l_linenumber
             HAVING count(*) > 1)
SELECT l_suppkey AS file, l_orderkey, l_linenumber FROM lineitem
WHERE l_suppkey NOT IN (SELECT file FROM bad)
"""
