"""Operators on literal rows: joins, reshape, filters, cells, stats, quality, IO."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellspring.operators import cells as CL
from wellspring.operators import filters as P
from wellspring.operators import joins as J
from wellspring.operators import quality as Q
from wellspring.operators import reshape as R
from wellspring.operators import stats as A
from wellspring.plans import composites as C
from wellspring.session import scratch_path
from wellspring.sources import readers as SR
from wellspring.sources import sinks as K


def test_null_safe_lookup(spark):
    data = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, v string")
    lookup = spark.createDataFrame([(1, "one"), (None, "unknown")], "k int, name string")
    out = sorted((r.v, r.name) for r in J.keyed_join(data, lookup, ["k"]).collect())
    assert out == [("x", "one"), ("y", "unknown"), ("z", None)]


def test_natural_join_requires_common(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError):
        J.natural_join(a, b)


def test_add_parameter_metadata(spark):
    df = spark.createDataFrame([("Cl", 1.0), ("Na", 2.0), ("X", 3.0)], "VariableName_org string, v double")
    lk = spark.createDataFrame([("Cl", 10), ("Na", None)], "VariableName_org string, para_id int")
    par = spark.createDataFrame([(10, "Chlorid")], "para_id int, para_kurzname string")
    out = J.add_parameter_metadata(df, lk, par).collect()
    assert [(r.VariableName_org, r.para_kurzname) for r in out] == [("Cl", "Chlorid")]
    with pytest.raises(ValueError):
        J.add_parameter_metadata(df, lk.where("para_id is null"))


def test_unseen(spark):
    a = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "f string")
    b = spark.createDataFrame([("p1",)], "f string")
    assert [r.f for r in J.unseen(a, b, "f").collect()] == ["p2"]


def test_union_fill_mixed_types(spark):
    a = spark.createDataFrame([(1, 2.5)], "k int, v double")
    b = spark.createDataFrame([(2, "n.b.", "x")], "k int, v string, extra string")
    out = R.union_fill({"a": a, "b": b}).orderBy("k").collect()
    assert [(r.k, r.v, r.extra, r.source) for r in out] == [(1, "2.5", None, "a"), (2, "n.b.", "x", "b")]


def test_long_keeps_null_and_wide_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0)], "id int, a double, b double")
    long = R.to_long(df, ["id"], ["a", "b"], "name", "value")
    assert long.count() == 4
    wide = R.to_wide(long, ["id"], "name", "value", ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, df.collect()))


def test_lab_matrix_long(spark):
    df = spark.createDataFrame([(1, "0.5", "7")], "probe_nr int, `Cl@DIN@Cl@mg/l` string, `pH@x` string")
    out = {r.par_name: r for r in R.lab_matrix_long(df).collect()}
    assert (out["Cl"].method, out["Cl"].unit_org, out["pH"].par_name_phreeqc) == ("DIN", "mg/l", None)


def test_filters(spark):
    df = spark.createDataFrame(
        [("Datum", "a", 1.0), (None, None, None), ("2020-01-01", "", 2.0), ("2020-01-02", "b", None)],
        "datum string, txt string, q double",
    )
    assert P.drop_empty_rows(df).count() == 3
    assert P.drop_header_repeats(df, "datum", "Datum").count() == 2
    assert P.keep_text(df, "txt").count() == 2
    s = spark.createDataFrame([("K1", "GWW2"), ("K2", None), ("K3", "x")], "k string, g string")
    assert [r.k for r in P.exclude_regex(s, "g", "GWW").collect()] == ["K3"]
    long = spark.createDataFrame([("Leitfaehigkeit", 25000.0), ("Temperatur", 25000.0)], "p string, v double")
    out = P.null_implausible(long, "p", "v", "Leitfaehigkeit", 20000.0).collect()
    assert [r.v for r in out] == [None, 25000.0]
    syn = spark.createDataFrame([(None, 5.0, "x")], "lf double, el_lf double, other string")
    r = P.remap_synonyms(syn).first()
    assert r.lf == 5.0 and "el_lf" not in r.asDict()


def test_daily_totals_grouping_sets(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 1, 10.0), (dt.date(2020, 1, 1), None, 5.0), (dt.date(2020, 1, 1), 2, None)],
        "d date, w int, v double",
    )
    out = {(r.w, r.is_field): (r.n, r.volume) for r in A.daily_totals(df, "d", "w", "v").collect()}
    assert out[(None, True)] == (3, 15.0)
    assert out[(None, False)] == (1, 5.0)  # a NULL well is not the field
    assert out[(2, False)] == (1, 0.0)  # empty sum is 0


def test_sampling_stats_half_even(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 1, 6))], "k string, d date")
    r = A.sampling_stats(df, ["k"], "d").first()
    assert (r.period_days, r.number_of_samples, r.mean_sampling_interval_days) == (5, 2, 2.0)


def test_measurement_stats_counts_nulls(spark):
    df = spark.createDataFrame(
        [(1, "p", dt.datetime(2020, 1, 1), v) for v in (1.0, 2.0, 4.0, 8.0, None)],
        "sensor_id int, parameter string, datum_uhrzeit timestamp_ntz, messwert double",
    )
    r = A.measurement_stats(df).first()
    assert r.number_of_samples == 5 and r.median == 3.0 and abs(r.q10 - 1.3) < 1e-9 and r.max == 8.0
    ra = A.measurement_stats(df, approximate=True).first()
    assert ra.median in (2.0, 4.0, 3.0)


def test_latest_rows_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7)], "id int, t int")
    assert sorted(r.id for r in A.latest_rows(df, "t").collect()) == [2, 3]


def _grid(spark, rows):
    cells = [("f.xlsx", s, r, c, v) for s, r, c, v in rows if v is not None]
    return spark.createDataFrame(cells, "file_name string, sheet_name string, row_idx long, col_idx long, value string")


def test_header2_gather_no_fanout(spark):
    rows = [
        ("66 KAU", 1, 1, "Datum"), ("66 KAU", 1, 2, "Cl"), ("66 KAU", 2, 2, "mg/l"),
        ("66 KAU", 1, 3, "Cl"), ("66 KAU", 2, 3, "mg/l"),  # duplicate header
        ("66 KAU", 3, 1, "2020-01-01"), ("66 KAU", 3, 2, "1.5"), ("66 KAU", 3, 3, "1.6"),
        ("66 KAU", 4, 1, "2020-02-01"), ("66 KAU", 4, 2, "2.5"),
    ]
    out = CL.gather_with_header(_grid(spark, rows), CL.HEADER_2).collect()
    assert len(out) == 3  # one row per value cell
    assert {r.key for r in out} == {"Cl@mg/l"}
    assert {(r.Datum, r.DataValue) for r in out} == {("2020-01-01", "1.5"), ("2020-01-01", "1.6"), ("2020-02-01", "2.5")}
    assert {r.site_id for r in out} == {66.0}


def test_header4_partial_key(spark):
    rows = [("1 X", 1, 1, "Cl"), ("1 X", 3, 1, "mg/l"), ("1 X", 5, 1, "3")]
    out = CL.gather_with_header(_grid(spark, rows), CL.HEADER_4).collect()
    assert [r.key for r in out] == ["Cl@NA@mg/l@NA"]


def test_header1_with_meta(spark):
    rows = [
        ("META", 1, 1, "Sheet"), ("META", 1, 2, "OriginalName"), ("META", 1, 3, "Name"),
        ("META", 2, 1, "S1"), ("META", 2, 2, "Datum der Probe"), ("META", 2, 3, "Datum"),
        ("META", 3, 1, "S1"), ("META", 3, 2, "Chlorid [mg/l]"), ("META", 3, 3, "Cl"),
        ("S1", 1, 1, "Datum der Probe"), ("S1", 1, 2, "Chlorid [mg/l]"),
        ("S1", 2, 1, "2020-01-01"), ("S1", 2, 2, "12"),
    ]
    out = CL.gather_with_meta(_grid(spark, rows)).collect()
    assert [(r.Datum, r.VariableName_org, r.DataValue, r.OriginalName) for r in out] == [
        ("2020-01-01", "Cl", "12", "Chlorid [mg/l]")]


def test_cells_to_table_and_layouts(spark):
    rows = [("Stammdaten", 1, 1, "Interne Nr."), ("Stammdaten", 1, 2, "Prüfgegenstand"),
            ("Stammdaten", 2, 1, "7"), ("Stammdaten", 2, 2, "Rohwasser")]
    t = CL.cells_to_table(_grid(spark, rows), ["interne_nr", "prufgegenstand"]).first()
    assert (t.interne_nr, t.prufgegenstand) == ("7", "Rohwasser")
    sheets = spark.createDataFrame([("a", "META"), ("a", "12 X"), ("b", "3 Y"), ("c", "Info")],
                                   "file_name string, sheet_name string")
    lay = {r.file_name: r.layout for r in CL.sheet_layouts(sheets).collect()}
    assert lay == {"a": "header1", "b": "header2", "c": "none"}
    missing = Q.missing_sheets(sheets, ["META"]).collect()
    assert sorted(r.file_name for r in missing) == ["b", "c"]


def test_type_census(spark):
    rows = [("s", 2, 1, "2020-01-01"), ("s", 2, 2, "1.5"), ("s", 2, 3, "abc"), ("s", 3, 2, "2")]
    out = {r.type: r.n for r in CL.type_census(_grid(spark, rows)).collect()}
    assert out == {"date": 1, "numeric": 1, "text": 1}


def test_quality(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 1), ("f2", 2)], "file string, id int")
    dup = Q.duplicated_samples(df, ["file", "id"])
    with pytest.raises(Q.QualityError):
        Q.check(dup, "duplicates")
    status = Q.group_status(df, "file", {"dup": dup})
    assert {r.file: r.status for r in status.collect()} == {"f1": "failed", "f2": "ok"}
    assert [r.file for r in Q.keep_good_groups(df, status, "file").collect()] == ["f2"]


def test_clean_lab_values(spark):
    df = spark.createDataFrame(
        [("Cl", "mg/l", "<0,05"), ("Na", "µg/l", "120"), ("K", "mg/l", "n. b."), ("Geruch", None, "ohne"),
         ("Mg", None, "3"), ("Ca", "mg/l", "1,5")],
        "par_name string, unit_org string, par_val_org string",
    )
    out = {r.par_name: r for r in C.clean_lab_values(df).collect()}
    assert set(out) == {"Cl", "Na", "Geruch"}
    assert (out["Cl"].numeric_value, out["Cl"].out_of_limit) == (0.025, "<")
    assert (out["Na"].numeric_value, out["Na"].unit) == (0.12, "mg/l")
    assert out["Geruch"].character_value == "ohne"


def test_sinks_and_sources_roundtrip(spark):
    long = spark.createDataFrame(
        [("f", 1, dt.datetime(2020, 1, 1, 10), "Temperatur", 1.5), ("f", 1, dt.datetime(2020, 1, 2, 10), "Leitfaehigkeit", 900.0)],
        SR.SENSOR_LONG_SCHEMA,
    )
    root = scratch_path(spark, "test-export")
    path = K.write_sensor_data(long, root)
    assert path.endswith("20200101-110000TZ+01_20200102-110000TZ+01")
    back = SR.read_accumulated(spark, path)
    assert sorted(map(tuple, back.select(long.columns).collect())) == sorted(map(tuple, long.collect()))
    assert SR.read_accumulated(spark, root + "/nothing").count() == 0
    g = K.write_german_csv(spark.createDataFrame([(1, 2.5)], "k int, v double"), root + "/de")
    assert spark.read.option("header", True).option("sep", ";").csv(g).first().v == "2,50"


def test_sensor_csv_sink_gzip(spark):
    long = spark.createDataFrame(
        [("f", 1, dt.datetime(2020, 1, 1, 10), "Temperatur", 1.5)], SR.SENSOR_LONG_SCHEMA
    )
    path = K.write_sensor_data(long, scratch_path(spark, "test-csv"), fmt="csv")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()
    assert any(r.path.endswith(".csv.gz") for r in files)
    back = spark.read.option("header", True).csv(path).first()
    assert (back.parameter, float(back.messwert)) == ("Temperatur", 1.5)


def test_set_ops_and_distinct_labels(spark):
    a = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "f string")
    b = spark.createDataFrame([("p2",), ("p3",)], "f string")
    assert [r.f for r in R.set_difference(a, b).collect()] == ["p1"]
    assert [r.f for r in R.set_intersection(a, b).collect()] == ["p2"]
    units = spark.createDataFrame([("Cl", "mg/l"), ("Cl", "µg/l"), ("Cl", "mg/l"), ("Cl", None), ("Na", None)],
                                  "p string, u string")
    n = {r.p: r.n for r in A.count_distinct_by(units, ["p"], "u", "n").collect()}
    txt = {r.p: r.units for r in A.joined_distinct_text(units, ["p"], "u", "units").collect()}
    # a group without any value counts 0 and does not vanish
    assert n == {"Cl": 2, "Na": 0} and txt == {"Cl": "mg/l, µg/l", "Na": ""}


def test_transform_hook_and_require_rows(spark):
    df = spark.createDataFrame([(None, 5.0)], "lf double, el_lf double")
    # SURVEY §2.12: any DataFrame -> DataFrame callable plugs into df.transform
    out = df.transform(P.remap_synonyms).transform(P.with_constants, {"labor": "BWB"}).first()
    assert (out.lf, out.labor) == (5.0, "BWB")
    with pytest.raises(Q.QualityError):
        Q.require_rows(df.where("false"), "lookup")
