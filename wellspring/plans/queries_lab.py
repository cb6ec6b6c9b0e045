"""Lab, isotope and solver queries (C-07, C-08, C-09, H-08 ... H-11, R-09 ... R-12,
U-03, Q-C) over the driver tables, each with its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import reshape as R
from ..session import dealt
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE
from .queries import r6, register, ts

LAB_VALUE_SQL_PATTERN = r"^\s*([<>]?)\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
SOLVER_NAMES = ["Cl", "Na", "S(6)", "pH", "temp"]


def f2(c) -> F.Column:
    """Two-decimal text of a value with at most two decimals (decimal cast:
    exact here, and much cheaper than a formatter)."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)").cast("string")


def comma(c) -> F.Column:
    return F.replace(c, F.lit("."), F.lit(","))


# --- per-lineitem lab values ---------------------------------------------------
def lab_long(t: Tables) -> DataFrame:
    """One lab value per lineitem: parameter by line number, raw text in the
    styles seen in lab exports ('<0,05', 'n. b.', '> 0,07', '1,5', '5d')."""
    li = t.lineitem
    ln, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    par = (
        F.when(ln == 1, "Cl").when(ln == 2, "Na").when(ln == 3, "SO4").when(ln == 4, "Ca")
        .when(ln == 5, "Mg").when(ln == 6, "K")
        .otherwise(F.when(status == "O", "Geruch").otherwise("Trübung"))
    )
    phreeqc = (
        F.when(ln == 1, "Cl").when(ln == 2, "Na").when(ln == 3, "S(6)").when(ln == 4, "Ca")
        .when(ln == 5, "pH").when(ln == 6, "temp")
    )
    unit = (
        F.when((ln == 7) & (status == "O"), None).when(flag == "R", "µg/l")
        .when((ln == 4) & (status == "F"), None).otherwise("mg/l")
    )
    raw = (
        F.when(ln == 1, F.concat(F.lit("<"), comma(f2("l_discount"))))
        .when(ln == 2, F.when(flag == "R", "n. b.").when(flag == "A", "n.a.").otherwise(f2("l_tax")))
        .when(ln == 3, F.concat(F.lit("> "), comma(f2("l_tax"))))
        .when(ln == 4, f2("l_quantity"))
        .when(ln == 5, comma(f2("l_extendedprice")))
        .when(ln == 6, F.concat(f2("l_quantity"), F.lit("d")))
        .otherwise(F.when(flag == "N", None).otherwise("ohne"))
    )
    return li.select(
        F.col("l_orderkey").alias("probe_nr"), "l_linenumber",
        par.alias("par_name"), phreeqc.alias("par_name_phreeqc"), unit.alias("unit_org"), raw.alias("par_val_org"),
    )


_LAB_CTE = rf"""
WITH base AS (
  SELECT l_orderkey AS probe_nr, l_linenumber,
    CASE l_linenumber WHEN 1 THEN 'Cl' WHEN 2 THEN 'Na' WHEN 3 THEN 'SO4' WHEN 4 THEN 'Ca'
         WHEN 5 THEN 'Mg' WHEN 6 THEN 'K'
         ELSE CASE WHEN l_linestatus = 'O' THEN 'Geruch' ELSE 'Trübung' END END AS par_name,
    CASE l_linenumber WHEN 1 THEN 'Cl' WHEN 2 THEN 'Na' WHEN 3 THEN 'S(6)' WHEN 4 THEN 'Ca'
         WHEN 5 THEN 'pH' WHEN 6 THEN 'temp' END AS par_name_phreeqc,
    CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'R' THEN 'µg/l'
         WHEN l_linenumber = 4 AND l_linestatus = 'F' THEN NULL ELSE 'mg/l' END AS unit_org,
    CASE l_linenumber
      WHEN 1 THEN '<' || replace(CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
      WHEN 2 THEN CASE l_returnflag WHEN 'R' THEN 'n. b.' WHEN 'A' THEN 'n.a.' ELSE CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) END
      WHEN 3 THEN '> ' || replace(CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
      WHEN 4 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 5 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
      WHEN 6 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) || 'd'
      ELSE CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'ohne' END END AS par_val_org
  FROM lineitem),
v AS (SELECT *, CASE WHEN regexp_matches(par_val_org, 'n\.\s{{0,10}}(a|b)\.') THEN NULL ELSE par_val_org END AS v0 FROM base),
w AS (SELECT *, CASE WHEN regexp_matches(v0, '[<>]') THEN regexp_replace(v0, '^([^,]*),', '\1.') ELSE v0 END AS par_val FROM v),
x AS (SELECT *, coalesce(regexp_matches(par_val, '{LAB_VALUE_SQL_PATTERN}'), false) AS ok FROM w),
y AS (SELECT *, CASE WHEN ok THEN regexp_extract(par_val, '{LAB_VALUE_SQL_PATTERN}', 1) END AS out_of_limit,
             CASE WHEN ok THEN TRY_CAST(regexp_extract(par_val, '{LAB_VALUE_SQL_PATTERN}', 2) AS DOUBLE) END AS num0
      FROM x),
z AS (SELECT *, CASE WHEN out_of_limit = '<' THEN num0 * 0.5 ELSE num0 END AS num1 FROM y),
lab AS (
  SELECT probe_nr, l_linenumber, par_name, par_name_phreeqc, unit_org, par_val_org, out_of_limit,
         CASE WHEN unit_org = 'µg/l' THEN num1 * 0.001 WHEN unit_org IS NOT NULL THEN num1 END AS numeric_value,
         CASE WHEN unit_org = 'µg/l' THEN 'mg/l' ELSE unit_org END AS unit,
         CASE WHEN par_name IN ('Farbe', 'Trübung', 'Geruch', 'Bodensatz') THEN par_val_org END AS character_value,
         'BWB' AS labor,
         coalesce(par_name IN ('Farbe', 'Trübung', 'Geruch', 'Bodensatz'), false) AS is_text
  FROM z),
labv AS (SELECT * EXCLUDE (is_text) FROM lab
         WHERE (is_text AND par_val_org IS NOT NULL) OR (NOT is_text AND numeric_value IS NOT NULL))
"""

_LAB_COLS = ("probe_nr", "l_linenumber", "par_name", "par_name_phreeqc", "unit_org", "par_val_org",
             "character_value", "numeric_value", "out_of_limit", "unit", "labor")


def lab_values_df(t: Tables) -> DataFrame:
    return C.clean_lab_values(lab_long(t))


@register("lab_values")
def lab_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = lab_values_df(Tables(spark, sf_dir))
    return x.select(*[r6(c).alias(c) if c == "numeric_value" else c for c in _LAB_COLS])


ORACLE["lab_values"] = _LAB_CTE + """
SELECT probe_nr, l_linenumber, par_name, par_name_phreeqc, unit_org, par_val_org, character_value,
       round(numeric_value, 6) AS numeric_value, out_of_limit, unit, labor FROM labv
"""


@register("unit_violations")
def unit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = Q.unit_violations(lab_values_df(Tables(spark, sf_dir)))
    return x.select("probe_nr", "l_linenumber", "par_name", "par_name_phreeqc", "unit")


ORACLE["unit_violations"] = _LAB_CTE + """
SELECT probe_nr, l_linenumber, par_name, par_name_phreeqc, unit FROM labv
WHERE NOT coalesce(par_name_phreeqc IN ('temp', 'pH'), false) AND (unit IS NULL OR unit <> 'mg/l')
"""


# --- R-09 / H-19: lab matrix with 'a@b@c@d' column names ------------------------------
MATRIX_COLUMNS = (
    ("Cl@DIN 38405@Cl@mg/l", "l_quantity"),
    ("Na@ICP@Na@µg/l", "l_extendedprice"),
    ("pH@@pH@", "l_tax"),
    ("Temp@x", "l_returnflag"),
    ("a@b@c@d@e", "l_linestatus"),
)


def lab_matrix(t: Tables) -> DataFrame:
    li = t.lineitem
    vals = []
    for name, src in MATRIX_COLUMNS:
        c = f2(src) if dict(li.dtypes)[src] == "double" else F.col(src)
        vals.append(c.alias(name))
    return li.select(F.col("l_orderkey").alias("probe_nr"), F.col("l_linenumber").alias("lfd"), *vals)


@register("lab_matrix_long")
def lab_matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.lab_matrix_long(lab_matrix(Tables(spark, sf_dir)))


ORACLE["lab_matrix_long"] = """
SELECT l_orderkey AS probe_nr, l_linenumber AS lfd, 'Cl' AS par_name, 'DIN 38405' AS method,
       'Cl' AS par_name_phreeqc, 'mg/l' AS unit_org, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS par_val_org FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'Na', 'ICP', 'Na', 'µg/l', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'pH', '', 'pH', '', CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'Temp', 'x', NULL, NULL, l_returnflag FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'a', 'b', 'c', 'd', l_linestatus FROM lineitem
"""


# --- R-11 -----------------------------------------------------------------------------------
WIDE_NAMES = [f"L{i}" for i in range(1, 8)]


@register("lab_wide")
def lab_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by sample: values, names and the wide rows of a sample are made where its lines are
    li = dealt(Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey")
    per = li.groupBy(
        F.col("l_orderkey").alias("probe_nr"),
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("par_name_phreeqc"),
    ).agg(F.sum("l_quantity").alias("numeric_value"))
    wide = R.to_wide(per, ["probe_nr"], "par_name_phreeqc", "numeric_value", WIDE_NAMES)
    return wide.select("probe_nr", *[r6(n).alias(n) for n in WIDE_NAMES])


ORACLE["lab_wide"] = "SELECT l_orderkey AS probe_nr, " + ", ".join(
    f"round(sum(CASE WHEN l_linenumber = {i} THEN l_quantity END), 6) AS L{i}" for i in range(1, 8)
) + " FROM lineitem GROUP BY l_orderkey"


# --- C-07: current lab table per sample (order) --------------------------------------------
def current_lab_wide(t: Tables) -> DataFrame:
    """Lab matrix with one row per sample (order) and 'name@method@phreeqc@unit'
    value columns built from the order's lines."""
    g = dealt(t.lineitem, "l_orderkey").groupBy(F.col("l_orderkey").alias("probe_nr")).agg(
        F.sum("l_quantity").alias("q"), F.max("l_discount").alias("d"), F.max("l_tax").alias("tx"),
        F.count(F.lit(1)).alias("n"), F.min("l_linestatus").alias("st"), F.max("l_extendedprice").alias("ep"),
        F.min("l_quantity").alias("qmin"), F.min("l_suppkey").alias("supp"), F.max("l_shipdate").alias("sd"),
    )
    return g.select(
        "probe_nr",
        F.concat(F.lit("S"), F.col("supp").cast("string")).alias("messstelle"),
        F.date_format("sd", "yyyy-MM-dd").alias("probenahme_datum"),
        f2("q").alias("Cl@DIN 38405-1@Cl@mg/l"),
        F.when(F.col("d") < 0.05, F.concat(F.lit("<"), comma(f2("d")))).otherwise(f2("d")).alias("Na@ICP-MS@Na@µg/l"),
        f2(F.col("tx") * 100).alias("pH@DIN 38404@pH@"),
        F.when(F.col("n") > 4, F.lit("ohne")).otherwise(F.lit("n. b.")).alias("Geruch@sensorisch@@"),
        F.when(F.col("st") == "F", F.lit("n.a.")).otherwise(f2("ep")).alias("SO4@IC@S(6)@mg/l"),
        f2("qmin").alias("Temp@Feld@temp@°C"),
    )


def current_lab_df(t: Tables) -> DataFrame:
    return C.lab_table(current_lab_wide(t), "probe_nr")


_CUR_COLS = ("probe_nr", "messstelle", "probenahme_datum", "par_name", "method", "par_name_phreeqc", "unit_org",
             "par_val_org", "character_value", "numeric_value", "out_of_limit", "unit", "labor")


@register("current_lab_table")
def current_lab_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = current_lab_df(Tables(spark, sf_dir))
    return x.select(*[r6(c).alias(c) if c == "numeric_value" else c for c in _CUR_COLS])


_CUR_CTE = rf"""
WITH g AS (
  SELECT l_orderkey AS probe_nr, sum(l_quantity) AS q, max(l_discount) AS d, max(l_tax) AS tx, count(*) AS n,
         min(l_linestatus) AS st, max(l_extendedprice) AS ep, min(l_quantity) AS qmin, min(l_suppkey) AS supp,
         max(l_shipdate) AS sd
  FROM lineitem GROUP BY l_orderkey),
k AS (SELECT probe_nr, 'S' || CAST(supp AS VARCHAR) AS messstelle, strftime(sd, '%Y-%m-%d') AS probenahme_datum,
             q, d, tx, n, st, ep, qmin FROM g),
long AS (
  SELECT probe_nr, messstelle, probenahme_datum, 'Cl' AS par_name, 'DIN 38405-1' AS method, 'Cl' AS par_name_phreeqc,
         'mg/l' AS unit_org, CAST(CAST(q AS DECIMAL(18,2)) AS VARCHAR) AS par_val_org FROM k
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, 'Na', 'ICP-MS', 'Na', 'µg/l',
         CASE WHEN d < 0.05 THEN '<' || replace(CAST(CAST(d AS DECIMAL(18,2)) AS VARCHAR), '.', ',') ELSE CAST(CAST(d AS DECIMAL(18,2)) AS VARCHAR) END FROM k
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, 'pH', 'DIN 38404', 'pH', '', CAST(CAST(tx * 100 AS DECIMAL(18,2)) AS VARCHAR) FROM k
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, 'Geruch', 'sensorisch', '', '',
         CASE WHEN n > 4 THEN 'ohne' ELSE 'n. b.' END FROM k
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, 'SO4', 'IC', 'S(6)', 'mg/l',
         CASE WHEN st = 'F' THEN 'n.a.' ELSE CAST(CAST(ep AS DECIMAL(18,2)) AS VARCHAR) END FROM k
  UNION ALL
  SELECT probe_nr, messstelle, probenahme_datum, 'Temp', 'Feld', 'temp', '°C', CAST(CAST(qmin AS DECIMAL(18,2)) AS VARCHAR) FROM k),
v AS (SELECT *, CASE WHEN regexp_matches(par_val_org, 'n\.\s{{0,10}}(a|b)\.') THEN NULL ELSE par_val_org END AS v0 FROM long),
w AS (SELECT *, CASE WHEN regexp_matches(v0, '[<>]') THEN regexp_replace(v0, '^([^,]*),', '\1.') ELSE v0 END AS par_val FROM v),
x AS (SELECT *, coalesce(regexp_matches(par_val, '{LAB_VALUE_SQL_PATTERN}'), false) AS ok FROM w),
y AS (SELECT *, CASE WHEN ok THEN regexp_extract(par_val, '{LAB_VALUE_SQL_PATTERN}', 1) END AS out_of_limit,
             CASE WHEN ok THEN TRY_CAST(regexp_extract(par_val, '{LAB_VALUE_SQL_PATTERN}', 2) AS DOUBLE) END AS num0
      FROM x),
z AS (SELECT *, CASE WHEN out_of_limit = '<' THEN num0 * 0.5 ELSE num0 END AS num1 FROM y),
lab AS (
  SELECT probe_nr, messstelle, probenahme_datum, par_name, method, par_name_phreeqc, unit_org, par_val_org,
         CASE WHEN par_name IN ('Farbe', 'Trübung', 'Geruch', 'Bodensatz') THEN par_val_org END AS character_value,
         CASE WHEN unit_org = 'µg/l' THEN num1 * 0.001 WHEN unit_org IS NOT NULL THEN num1 END AS numeric_value,
         out_of_limit, CASE WHEN unit_org = 'µg/l' THEN 'mg/l' ELSE unit_org END AS unit, 'BWB' AS labor,
         coalesce(par_name IN ('Farbe', 'Trübung', 'Geruch', 'Bodensatz'), false) AS is_text
  FROM z),
cur AS (SELECT * EXCLUDE (is_text) FROM lab
        WHERE (is_text AND par_val_org IS NOT NULL) OR (NOT is_text AND numeric_value IS NOT NULL))
"""

ORACLE["current_lab_table"] = _CUR_CTE + """
SELECT probe_nr, messstelle, probenahme_datum, par_name, method, par_name_phreeqc, unit_org, par_val_org,
       character_value, round(numeric_value, 6) AS numeric_value, out_of_limit, unit, labor FROM cur
"""


# --- C-09 / R-12 / P-09 / Q-C -------------------------------------------------------------------
@register("solver_long")
def solver_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = C.solver_data(current_lab_df(Tables(spark, sf_dir)))
    # the driver rows hold several values of a sample and name; the flow refuses such
    # data, so this query makes them unique first
    once = dealt(data, "probe_nr", "par_name_phreeqc").groupBy("probe_nr", "par_name_phreeqc").agg(F.avg("numeric_value").alias("numeric_value"))
    out = C.solver_long(once)
    return out.select("solution", "units", "par_name_phreeqc", r6("numeric_value").alias("numeric_value"))


ORACLE["solver_long"] = _CUR_CTE + """
, d AS (SELECT probe_nr, par_name_phreeqc, avg(numeric_value) AS v FROM cur
        WHERE coalesce(length(par_name_phreeqc), 0) > 0 GROUP BY probe_nr, par_name_phreeqc)
SELECT probe_nr AS solution, 'ppm' AS units, par_name_phreeqc, round(v, 6) AS numeric_value
FROM d WHERE v IS NOT NULL
"""


# --- C-08 / R-10 / P-02 -----------------------------------------------------------------------------
def isotope_sheet(t: Tables) -> DataFrame:
    """Isotope export (clean names) derived from the supplier table."""
    s = t.supplier
    day = F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0")
    return s.select(
        F.col("s_suppkey").cast("string").alias("lab_id"),
        F.col("s_nationkey").cast("string").alias("site_id"),
        F.concat(day, F.lit(".03.2021")).alias("sampling_date"),
        (F.col("s_acctbal") / 100).alias("fuk_masl"),
        F.when(F.col("s_acctbal") < 0, F.concat(F.lit("<"), f2(-F.col("s_acctbal")))).otherwise(f2("s_acctbal")).alias("x2h"),
        f2(F.col("s_nationkey").cast("double")).alias("x18o"),
        F.concat(F.lit(" "), F.col("s_suppkey").cast("string")).alias("cond_field"),
    )


@register("isotopes_long")
def isotopes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = C.isotopes_long(isotope_sheet(Tables(spark, sf_dir)), "crew_1", "lab_B")
    return x.withColumns({"probenahme_datum": ts("probenahme_datum"), "numeric_value": r6("numeric_value")})


ORACLE["isotopes_long"] = rf"""
WITH s AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS probe_nr, CAST(s_nationkey AS VARCHAR) AS messstelle,
         CAST(CAST(strptime(lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0') || '.03.2021', '%d.%m.%Y') AS DATE) AS TIMESTAMP)
           AS probenahme_datum,
         CASE WHEN s_acctbal < 0 THEN '<' || CAST(CAST(-s_acctbal AS DECIMAL(18,2)) AS VARCHAR) ELSE CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS isotope_2h,
         CAST(CAST(CAST(s_nationkey AS DOUBLE) AS DECIMAL(18,2)) AS VARCHAR) AS isotope_18o,
         ' ' || CAST(s_suppkey AS VARCHAR) AS cond_field
  FROM supplier),
l AS (
  SELECT probe_nr, messstelle, probenahme_datum, 'isotope_2h' AS par_name, isotope_2h AS par_val_org FROM s
  UNION ALL SELECT probe_nr, messstelle, probenahme_datum, 'isotope_18o', isotope_18o FROM s
  UNION ALL SELECT probe_nr, messstelle, probenahme_datum, 'cond_field', cond_field FROM s),
x AS (SELECT *, coalesce(regexp_matches(par_val_org, '{LAB_VALUE_SQL_PATTERN}'), false) AS ok FROM l),
y AS (SELECT *, CASE WHEN ok THEN regexp_extract(par_val_org, '{LAB_VALUE_SQL_PATTERN}', 1) END AS out_of_limit,
             CASE WHEN ok THEN TRY_CAST(regexp_extract(par_val_org, '{LAB_VALUE_SQL_PATTERN}', 2) AS DOUBLE) END AS num0
      FROM x)
SELECT probe_nr, messstelle, probenahme_datum, par_name, par_val_org,
       round(CASE WHEN out_of_limit = '<' THEN num0 * 0.5 ELSE num0 END, 6) AS numeric_value,
       out_of_limit, 'crew_1' AS probenahme, 'lab_B' AS labor
FROM y
"""


# --- U-03 ----------------------------------------------------------------------------------------------
@register("two_labs")
def two_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    lab1 = t.lineitem.select(F.col("l_orderkey").alias("probe_nr"), F.lit("menge").alias("par_name"),
                             F.col("l_quantity").alias("par_val_org"), "l_returnflag")
    lab2 = t.orders.select(F.col("o_orderkey").alias("probe_nr"), F.lit("preis").alias("par_name"),
                           F.col("o_totalprice").alias("par_val_org"), "o_orderpriority")
    return R.bind_as_text([lab1, lab2], ["probe_nr", "par_val_org"])


ORACLE["two_labs"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS probe_nr, 'menge' AS par_name, CAST(l_quantity AS VARCHAR) AS par_val_org,
       l_returnflag FROM lineitem
UNION ALL BY NAME
SELECT CAST(o_orderkey AS VARCHAR) AS probe_nr, 'preis' AS par_name, CAST(o_totalprice AS VARCHAR) AS par_val_org,
       o_orderpriority FROM orders
"""

