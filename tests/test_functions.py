"""Column functions on a handful of literal rows (SURVEY §5 (1))."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wellspring.functions import geo
from wellspring.functions import scalars as S
from wellspring.functions.names import clean_name, clean_names, split_columns


def one(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_not_analysed_markers(spark):
    vals = ["19.2", "n.b.", "n. b.", "n.  b.", "n.a.", "n. a.", "n.  a.", None]
    assert one(spark, vals, "s string", S.null_if_not_analysed("s")) == ["19.2"] + [None] * 7
    assert one(spark, vals, "s string", S.blank_if_not_analysed("s")) == ["19.2"] + [""] * 6 + [None]


def test_limit_comma(spark):
    vals = ["<0,05", "1,5", ">1,5,3", None, "< 2"]
    assert one(spark, vals, "s string", S.limit_comma_to_point("s")) == ["<0.05", "1,5", ">1.5,3", None, "< 2"]


def test_lab_value(spark):
    df = spark.createDataFrame(
        [("<0.05",), (">1.5",), ("1,5",), ("5d",), (" 12 ",), ("> 3",), (None,), ("-2e1",)], "s string"
    )
    out = S.with_lab_value(df, "s").collect()
    got = [(r.numeric_value, r.out_of_limit) for r in out]
    assert got == [(0.025, "<"), (1.5, ">"), (None, None), (None, None), (12.0, ""), (3.0, ">"),
                   (None, None), (-20.0, "")]


def test_micro_to_milli(spark):
    df = spark.createDataFrame([("µg/l", 5.0), (None, 5.0), ("mg/l", 5.0)], "u string, v double")
    conv = S.micro_to_milli("u", "v")
    out = df.select(conv["unit"].alias("unit"), conv["numeric_value"].alias("v")).collect()
    assert [(r.unit, r.v) for r in out] == [("mg/l", 0.005), (None, None), ("mg/l", 5.0)]


def test_site_id(spark):
    vals = ["66 KAU Rein 1999-2000", "Info", "12345x", None]
    assert one(spark, vals, "s string", S.site_id("s")) == [66.0, None, 1234.0, None]


def test_well_code(spark):
    df = spark.createDataFrame([("FRIK0009-A-1998V",)], "c string")
    r = df.select(*[v.alias(k) for k, v in S.well_code_parts("c").items()]).first()
    assert tuple(r) == ("FRI", "K", 9, "A", 1998, "V")


def test_logger_parts_and_paths(spark):
    df = spark.createDataFrame(
        [("K09/LF_4182018-2023-05-10-1100.csv",), ("K10/4182001_2023-05-10-1100.csv",), ("K10/readme.csv",),
         ("top.csv",)], "p string"
    )
    x = df.select(S.path_folder("p").alias("folder"), S.path_file("p").alias("file"))
    x = x.withColumn("stem", S.drop_extension("file")).withColumns(S.logger_parts("stem"))
    x = x.withColumns({"g": S.gallery_of_folder("folder"), "w": S.well_of_folder("folder")})
    rows = x.collect()
    assert [r.folder for r in rows] == ["K09", "K10", "K10", "."]
    assert rows[0].prefix == "LF_" and rows[0].sensor_id == 4182018 and rows[0].sensor_endnummer == 8
    assert rows[0].datum_uhrzeit == dt.datetime(2023, 5, 10, 10, 0)  # 11:00 at UTC+1
    assert rows[1].prefix == "" and rows[1].sensor_id == 4182001
    assert rows[2].sensor_id is None and rows[2].prefix is None
    assert (rows[0].g, rows[0].w) == ("K", 9)


def test_header_key_and_split(spark):
    df = spark.createDataFrame(
        [("Cl", None, "mg/l", None), ("Datum", None, None, None), ("Na", "ICP", None, None)],
        "a string, b string, c string, d string",
    )
    assert [r[0] for r in df.select(S.header_key(["a", "b", "c", "d"])).collect()] == [
        "Cl@NA@mg/l@NA", "Datum", "Na@ICP@NA@NA"]
    assert [r[0] for r in df.select(S.header_key(["a", "b"])).collect()] == ["Cl", "Datum", "Na@ICP"]
    k = spark.createDataFrame([("a@b",), ("a@b@c@d@e",)], "k string")
    parts = S.split_key("k", ["p1", "p2", "p3", "p4"])
    out = [tuple(r) for r in k.select(*[v.alias(n) for n, v in parts.items()]).collect()]
    assert out == [("a", "b", None, None), ("a", "b", "c", "d")]


def test_to_number(spark):
    vals = ["1.5d", "NaN", " 2.5 ", "1e3", "abc", None, "-4", "Infinity"]
    assert one(spark, vals, "s string", S.to_number("s")) == [None, None, 2.5, 1000.0, None, None, -4.0, None]


def test_times(spark):
    df = spark.createDataFrame([("2022-09-27 11:00:00",)], "s string")
    r = df.select(S.local_plus_one_to_utc("s").alias("u")).first().u
    assert r == dt.datetime(2022, 9, 27, 10, 0)
    r2 = df.select(S.period_text(S.local_plus_one_to_utc("s")).alias("p")).first().p
    assert r2 == "20220927-110000TZ+01"
    u = spark.createDataFrame([("2024-01-01T00:00:07Z",), ("2024-01-01T00:00:07",)], "s string")
    got = [(r.v, r.ok) for r in u.select(S.parse_utc_text("s").alias("v"), S.is_utc_text("s").alias("ok")).collect()]
    assert got == [(dt.datetime(2024, 1, 1, 0, 0, 7), True), (None, False)]


def test_dates(spark):
    assert one(spark, ["91/05/17", "bad"], "s string", S.survey_date("s")) == [dt.date(1991, 5, 17), None]
    assert one(spark, ["5.3.1996", "31.12.1999", "x"], "s string", S.parse_date("s", "d.M.yyyy")) == [
        dt.date(1996, 3, 5), dt.date(1999, 12, 31), None]
    assert one(spark, [2001], "y int", S.year_end("y")) == [dt.date(2001, 12, 31)]


def test_survey_text(spark):
    vals = ["GF,Br12", "Go", "GO,,5", "K-Gal.,Br3", "GE,Br07"]
    assert one(spark, vals, "s string", S.substitute_all("s", S.GALLERY_SUBSTITUTIONS)) == [
        "Gal_F,Br12", "Gal_O", "Gal_O,5", "Gal_K,Br3", "Gal_E,Br07"]
    df = spark.createDataFrame([("GF,Br12 34/56  07",), ("Go 5",)], "s string")
    parts = S.split_fixed("s", r"\s{1,9}", 3)
    assert [tuple(r) for r in df.select(*parts).collect()] == [("GF,Br12", "34/56", "07"), ("Go", "5", "")]


def test_null_rules(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "s string")
    assert [r.s for r in df.where(S.not_in("s", ["a"])).collect()] == [None, "b"]
    assert [r.s for r in df.where(S.has_text("s")).collect()] == ["a", "b"]
    n = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in n.select(S.nan_to_null("v")).collect()] == [None, 1.0]


def test_labels_and_units(spark):
    df = spark.createDataFrame([(21.5, 4182018, "Leitfaehigkeit"), (None, 1, "Temperatur"), (1.0, 2, "x")],
                               "d double, s int, p string")
    out = df.select(S.depth_label("d", "s").alias("l"), S.parameter_unit("p").alias("u")).collect()
    assert [(r.l, r.u) for r in out] == [("21.5 m uGOK (4182018)", "µS/cm"), (None, "°C"), ("1.0 m uGOK (2)", None)]
    assert one(spark, [1234.5], "v double", S.decimal_comma("v")) == ["1234,50"]


def test_utm_to_lonlat(spark):
    df = spark.createDataFrame([(500000.0, 0.0), (400000.0, 5800000.0)], "e double, n double")
    lon, lat = geo.utm_to_lonlat("e", "n")
    rows = df.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert math.isclose(rows[0].lon, 15.0, abs_tol=1e-9) and math.isclose(rows[0].lat, 0.0, abs_tol=1e-9)
    assert math.isclose(rows[1].lon, 13.5321218, abs_tol=1e-6)
    assert math.isclose(rows[1].lat, 52.3411753, abs_tol=1e-6)


def test_names():
    assert clean_name("Prüfgegenstand") == "prufgegenstand"
    assert clean_name("Interne Nr.") == "interne_nr"
    assert clean_name("2H") == "x2h"
    assert clean_names(["a b", "A-B", "x"]) == ["a_b", "a_b_2", "x"]
    kept, gathered = split_columns(["Datum", "Probe-Nr.", "Cl", "Meßstelle", "Na"])
    assert kept == ["Datum", "Probe-Nr.", "Meßstelle"] and gathered == ["Cl", "Na"]


@pytest.mark.parametrize("text,expected", [("Probe@NA", "Probe")])
def test_header_key_two(spark, text, expected):
    df = spark.createDataFrame([(text.split("@")[0], None)], "a string, b string")
    assert df.select(S.header_key(["a", "b"])).first()[0] == expected


def test_ordered_join(spark):
    df = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("s", 3, "c")], "k string, r int, v string")
    assert df.groupBy("k").agg(S.ordered_join("r", "v").alias("p")).first().p == "a@b@c"


def test_no_python_udfs_in_functions(spark):
    df = spark.createDataFrame([("<0,05",)], "s string")
    plan = S.with_lab_value(df.withColumn("s", S.limit_comma_to_point("s")), "s")._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert F is not None
