"""Registered queries over the driver tables (one per operator group).

The driver tables stand in for the reference's inputs: ``events`` is a
sensor stream (sensor = user_id, parameter = event_type, time = ts, value =
value), ``orders`` / ``customer`` are abstraction volumes per well (nation),
``lineitem`` / ``part`` feed lab values and workbook cells.  Every query
reads whole tables; none filters by id ranges or caps rows.  Each returns a
DataFrame whose columns equal those of its oracle SQL (``oracle.py``).
Doubles are rounded to 6 decimals on both sides; visible sort orders are a
``rn`` column computed by the skew-safe ``sort_rank``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.geo import utm_to_lonlat
from ..functions.names import rename_regex
from ..operators import filters as P
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import stats as A
from ..operators.ranking import mark_repeats, sort_rank
from ..tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def ts(c: str | Column) -> Column:
    """Dates leave the queries as TIMESTAMP_NTZ (midnight), so that every
    client (pandas, Arrow, Python rows) sees one type on both sides."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def dbl(c: str | Column) -> Column:
    """Integer columns that can hold NULL leave as DOUBLE for the same reason."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# --- shared derived tables ----------------------------------------------------------
def sensor_series(t: Tables) -> DataFrame:
    """events as the long sensor table of the reference (F-2 output)."""
    return t.events.select(
        "event_id",
        F.col("user_id").alias("sensor_id"),
        F.col("event_type").alias("parameter"),
        F.col("ts").alias("datum_uhrzeit"),
        F.col("value").alias("messwert"),
    )


def well_volumes(t: Tables) -> DataFrame:
    """orders as daily well operation: day, well (customer nation), volume."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = J.keyed_join(o, c, ["o_custkey"], ["c_custkey"], how="left")
    return j.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("bwb_datum"),
        F.col("c_nationkey").alias("well"),
        F.col("o_totalprice").alias("menge"),
    )


def stats_table(t: Tables) -> DataFrame:
    return A.measurement_stats(sensor_series(t))


# --- A-01 / O-02 ---------------------------------------------------------------------
@register("sensor_stats")
def sensor_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stats_table(Tables(spark, sf_dir))
    st = sort_rank(st, ["sensor_id", "parameter"], "rn")
    return st.select(
        "sensor_id", "parameter", "datetime_min", "datetime_max",
        *[r6(c).alias(c) for c in ("min", "q10", "mean", "median", "q90", "max")],
        "number_of_samples", "rn",
    )


# --- A-02 --------------------------------------------------------------------------------
@register("overall_period")
def overall_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.period_of(sensor_series(Tables(spark, sf_dir)))


# --- R-01 ---------------------------------------------------------------------------------
@register("sensor_long")
def sensor_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return R.to_long(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"], "parameter", "messwert")


# --- P-07 / H-12 ----------------------------------------------------------------------------
INSTALLATION_UTC = "2024-01-15 00:00:00"


@register("since_installation")
def since_installation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Filter on the raw UTC+1 column (pushed into the parquet scan), then convert.
    s = sensor_series(Tables(spark, sf_dir))
    s = P.remove_before(s, "datum_uhrzeit", S.utc_bound_as_local_plus_one(INSTALLATION_UTC))
    return s.withColumn("datum_uhrzeit", S.local_plus_one_to_utc("datum_uhrzeit"))


# --- P-14 ---------------------------------------------------------------------------------------
@register("null_implausible")
def null_implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sensor_series(Tables(spark, sf_dir)).select("event_id", "parameter", "messwert")
    return P.null_implausible(s, "parameter", "messwert", "purchase", 250.0)


# --- A-03 ------------------------------------------------------------------------------------------
@register("well_daily")
def well_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = A.daily_totals(well_volumes(Tables(spark, sf_dir)), "bwb_datum", "well", "menge", levels="well")
    return d.select(ts("bwb_datum").alias("bwb_datum"), dbl("well").alias("well"), "n", r6("volume").alias("volume"))


def _daily_both(t: Tables) -> DataFrame:
    return A.daily_totals(well_volumes(t), "bwb_datum", "well", "menge", levels="both")


@register("field_daily")
def field_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _daily_both(Tables(spark, sf_dir))
    return d.select(ts("bwb_datum").alias("bwb_datum"), dbl("well").alias("well"), "n",
                    r6("volume").alias("volume"), "is_field")


# --- W-01 -------------------------------------------------------------------------------------------
@register("rolling_7_10")
def rolling_7_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _daily_both(Tables(spark, sf_dir))
    out = A.rolling_means(d, ["is_field", "well"], "bwb_datum", "volume", {"roll_7": 7, "roll_10": 10})
    return out.select(
        "is_field", dbl("well").alias("well"), ts("bwb_datum").alias("bwb_datum"), r6("volume").alias("volume"),
        r6("roll_7").alias("roll_7"), r6("roll_10").alias("roll_10"),
    )


# --- J-01 / J-02 ---------------------------------------------------------------------------------------
@register("meta_join")
def meta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return J.keyed_join(t.supplier, t.nation, ["s_nationkey"], ["n_nationkey"], columns=["n_name", "n_regionkey"])


@register("file_join")
def file_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey")
    return J.keyed_join(o, t.customer, ["o_custkey"], ["c_custkey"], columns=["c_nationkey", "c_mktsegment"])


# --- J-03 -----------------------------------------------------------------------------------------------
@register("natural_join")
def natural_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    left = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    right = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority", "o_orderstatus")
    return J.natural_join(left, right)


# --- J-04 -----------------------------------------------------------------------------------------------
def parameter_lookups(t: Tables) -> tuple[DataFrame, DataFrame]:
    lookup = t.part.select(
        F.col("p_partkey").cast("string").alias("VariableName_org"),
        F.when(F.col("p_size") <= 25, F.col("p_size")).alias("para_id"),
    )
    params = t.part.select(
        F.col("p_size").alias("para_id"),
        F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("para_kurzname"),
    ).distinct()
    return lookup, params


@register("map_parameters")
def map_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    data = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("VariableName_org")
    )
    lookup, params = parameter_lookups(t)
    return J.add_parameter_metadata(data, lookup, params)


# --- K-06 / O-04 -------------------------------------------------------------------------------------------
@register("unmapped_template")
def unmapped_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    names = li.select(F.concat_ws("-", "l_returnflag", "l_linestatus").alias("VariableName_org"))
    return sort_rank(J.unmapped_template(names), ["VariableName_org"], "rn")


# --- A-04 / J-10 / H-15 ----------------------------------------------------------------------------------------
@register("yearly_mean_abstraction")
def yearly_mean_abstraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    li = J.keyed_join(
        t.lineitem.select("l_suppkey", "l_shipdate", "l_extendedprice"),
        t.supplier, ["l_suppkey"], ["s_suppkey"], columns=["s_nationkey"],
    ).withColumnRenamed("s_nationkey", "werk")
    means = A.yearly_mean(li, ["werk"], "l_shipdate", "l_extendedprice")
    vol = well_volumes(t).groupBy(F.col("well").alias("werk"), F.year("bwb_datum").alias("year")).agg(
        F.sum("menge").alias("foerdermenge")
    )
    out = J.keyed_join(means, vol, ["werk", "year"])
    return out.select("werk", "year", r6("mean_value").alias("mean_value"), r6("foerdermenge").alias("foerdermenge"))


# --- A-05 -------------------------------------------------------------------------------------------------------
@register("sampling_stats")
def sampling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderpriority", "o_orderdate")
    j = J.keyed_join(o, t.customer, ["o_custkey"], ["c_custkey"], columns=["c_nationkey"])
    s = A.sampling_stats(j, ["o_orderpriority", "c_nationkey"], "o_orderdate")
    return s.withColumns({
        "period_days": F.col("period_days").cast("long"),
        "date_min": ts("date_min"),
        "date_max": ts("date_max"),
    })


# --- J-13 / U-04 ------------------------------------------------------------------------------------------------
@register("new_files")
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    candidates = li.where(F.col("l_returnflag") == "R")
    seen = li.where(F.col("l_returnflag") == "A")
    return J.unseen(candidates, seen, "l_orderkey")


# --- U-01 ---------------------------------------------------------------------------------------------------------
@register("union_fill")
def union_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cust = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"),
    )
    supp = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return R.union_fill({"customer": cust, "supplier": supp}, "source")


# --- P-20 ----------------------------------------------------------------------------------------------------------
@register("remap_synonyms")
def remap_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    docs = t.documents.select(
        "doc_id", "lang",
        F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("quality_est"),
        F.when(F.col("lang") == "en", 0).otherwise(1).alias("toxic_flag"),
    )
    joined = J.keyed_join(docs, t.labels, ["doc_id"], columns=["quality", "toxic"])
    return P.remap_synonyms(joined, [("quality", "quality_est"), ("toxic", "toxic_flag")])


# --- A-11 / W-02 -------------------------------------------------------------------------------------------------------
@register("duplicates")
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicate_ids(Tables(spark, sf_dir).lineitem, ["l_orderkey"], "n")


@register("duplicate_marks")
def duplicate_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return mark_repeats(li, ["l_orderkey"], ["l_linenumber", "l_partkey"], "is_duplicate")


# --- A-07 ---------------------------------------------------------------------------------------------------------------
@register("distinct_keys")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_rows(Tables(spark, sf_dir).customer, ["c_nationkey", "c_mktsegment"])


# --- S-13 / W-03 ---------------------------------------------------------------------------------------------------------
@register("latest_rows")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return A.latest_rows(o, "o_orderdate")


# --- A-08 / A-09 ---------------------------------------------------------------------------------------------------------
@register("labels_units")
def labels_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    n = A.count_distinct_by(p, ["p_type"], "p_brand", "n_brands")
    txt = A.joined_distinct_text(p, ["p_type"], "p_brand", "brands")
    return n.join(txt, "p_type")


# --- P-01 ... P-06 ----------------------------------------------------------------------------------------------------------
@register("projection")
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    out = P.rename_columns(li, {"l_partkey": "l_part", "no_such_column": "ignored"})
    out = rename_regex(out, "^l_", "item_")
    out = P.drop_prefixed(out, "item_t")
    out = P.with_constants(out, {"labor": "lab_A", "probenahme": "crew_1"})
    return out.select("labor", "probenahme", "item_orderkey", "item_part", "item_quantity",
                      "item_extendedprice", "item_discount")


# --- P-12 / P-13 / P-16 / P-18 -------------------------------------------------------------------------------------------------
@register("predicates")
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    o = P.exclude_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    o = o.where(F.col("o_totalprice") < 300000)
    o = P.exclude_regex(o, "o_orderstatus", "P")
    o = P.within(o, "o_orderdate", "1996-01-01", "1998-12-31")
    return o.select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")


# --- K-03 --------------------------------------------------------------------------------------------------------------------------
@register("german_csv")
def german_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", S.decimal_comma("o_totalprice", 2).alias("totalprice_de"))


# --- H-17 ---------------------------------------------------------------------------------------------------------------------------
@register("period_label")
def period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sensor_series(Tables(spark, sf_dir))
    agg = s.groupBy("parameter").agg(F.min("datum_uhrzeit").alias("t0"), F.max("datum_uhrzeit").alias("t1"))
    return agg.select("parameter", S.period_text("t0").alias("period_start"), S.period_text("t1").alias("period_end"))


# --- H-13 / Q-G -----------------------------------------------------------------------------------------------------------------------
@register("utc_text")
def utc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).events
    txt = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("Z")),
    )
    e = e.select("event_id", txt.alias("utc_text"))
    return e.select("event_id", "utc_text", S.parse_utc_text("utc_text").alias("datum_uhrzeit"),
                    S.is_utc_text("utc_text").alias("is_valid"))


# --- H-16 / J-14 ------------------------------------------------------------------------------------------------------------------------
@register("numbers")
def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    price = F.format_string("%.2f", "o_totalprice")
    txt = (
        F.when(F.col("o_orderstatus") == "F", price)
        .when(F.col("o_orderstatus") == "O", F.concat(price, F.lit("d")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("NaN"))
        .otherwise(F.concat(F.lit(" "), price, F.lit(" ")))
    )
    o = o.select("o_orderkey", txt.alias("txt"))
    return o.withColumn("number", S.to_number("txt"))


# --- P-19 / H-14 / H-15 --------------------------------------------------------------------------------------------------------------------
@register("first_date")
def first_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    d1 = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yyyy"))
    d2 = F.when(F.year("o_orderdate") < 2000, F.date_format("o_orderdate", "yy/MM/dd"))
    o = o.select("o_orderkey", d1.alias("datum_text"), d2.alias("survey_text"))
    date = P.first_present(S.parse_date("datum_text", "d.M.yyyy"), S.survey_date("survey_text"))
    return o.withColumn("datum", date).withColumn("year", dbl(F.year("datum"))).withColumn("datum", ts("datum"))


# --- P-08 ... P-11 --------------------------------------------------------------------------------------------------------------------------
@register("clean_rows")
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    blank = F.col("l_linenumber") == 7
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.when(blank, None).when(F.col("l_linenumber") == 1, F.lit("Datum"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("datum"),
        F.when(blank, None).when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_returnflag")).alias("comment"),
        F.when(blank, None).otherwise(F.col("l_quantity")).alias("qty"),
    )
    out = P.drop_empty_rows(raw, ["datum", "comment", "qty"])
    out = P.drop_header_repeats(out, "datum", "Datum")
    out = P.keep_text(out, "comment")
    return P.drop_missing(out, ["qty"])


# --- H-27 ------------------------------------------------------------------------------------------------------------------------------------
@register("utm_to_wgs84")
def utm_to_wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Tables(spark, sf_dir).supplier.select(
        "s_suppkey",
        (F.lit(350000.0) + F.col("s_acctbal") * 20).alias("easting"),
        (F.lit(5750000.0) + F.col("s_nationkey") * 2000.0 + F.col("s_suppkey")).alias("northing"),
    )
    lon, lat = utm_to_lonlat("easting", "northing")
    return s.select("s_suppkey", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))
