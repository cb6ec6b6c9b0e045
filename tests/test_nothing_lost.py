"""Inputs that the driver tables never hold: no row, column, sheet or group may vanish unreported."""

import pytest

from wellspring.functions import scalars as S
from wellspring.operators import cells as CL
from wellspring.operators import quality as Q
from wellspring.operators import stats as A
from wellspring.plans import composites as C
from wellspring.sources import readers as SR
from wellspring.streaming.ingest import sensor_stream


def _grid(spark, rows):
    return spark.createDataFrame([("f.xlsx", *r) for r in rows], "file_name string, sheet_name string, row_idx long, col_idx long, value string")


def test_undescribed_columns_and_more_meta_columns(spark):
    rows = [
        ("META", 1, 1, "Sheet"), ("META", 1, 2, "OriginalName"), ("META", 1, 3, "Name"), ("META", 1, 4, "Unit"),
        ("META", 2, 1, "S1"), ("META", 2, 2, "Chlorid"), ("META", 2, 3, "Cl"), ("META", 2, 4, "mg/l"),
        ("S1", 1, 1, "Chlorid"), ("S1", 1, 2, "Kalium"), ("S1", 1, 3, "Datum"),
        ("S1", 2, 1, "12"), ("S1", 2, 2, "3"), ("S1", 2, 3, "2020-01-01"),
    ]
    out = CL.gather_with_meta(_grid(spark, rows), fields=[*CL.META_FIELDS, "Unit"]).collect()
    assert {(r.Datum, r.VariableName_org, r.Name, r.Unit, r.DataValue) for r in out} == {
        ("2020-01-01", "Cl", "Cl", "mg/l", "12"), ("2020-01-01", "Kalium", None, None, "3")}


def test_left_out_columns_are_reported_and_other_kept_names_stay(spark):
    rows = [
        ("66 K", 1, 1, "Datum"), ("66 K", 1, 2, "Datum"), ("66 K", 1, 3, "Ort"), ("66 K", 1, 4, "Cl"),
        ("66 K", 3, 1, "2020-01-01"), ("66 K", 3, 2, "2021-01-01"), ("66 K", 3, 3, "here"), ("66 K", 3, 4, "1"), ("66 K", 3, 5, "lost"),
    ]
    cells = _grid(spark, rows)
    (row,) = CL.gather_with_header(cells).collect()
    assert (row.Datum, row.Probe_Nr, row.DataValue) == ("2020-01-01", None, "1")
    assert row.kept == {"Datum": "2020-01-01", "Ort": "here"}
    report = {(r.col_idx, r.reason, r.n_cells) for r in CL.dropped_columns(cells).collect()}
    assert report == {(2, "second kept column", 1), (5, "no header", 1)}


def test_sheets_with_different_headers(spark):
    rows = [("A", 1, 1, "Werk"), ("A", 1, 2, "Werk"), ("A", 2, 1, "x"), ("A", 2, 2, "y"),
            ("B", 1, 1, "9 Nr."), ("B", 2, 1, "1"), ("B", 3, 1, "2")]
    out = CL.cells_to_table(_grid(spark, rows), ["werk", "werk_2", "x9_nr"], rest=True).collect()
    assert {(r.sheet_name, r.row_idx, r.werk, r.werk_2, r.x9_nr) for r in out} == {
        ("A", 2, "x", "y", None), ("B", 2, None, None, "1"), ("B", 3, None, None, "2")}
    assert sum(len(r["values"]) for r in out) == 4


def test_empty_columns_are_no_numbers(spark):
    cells = _grid(spark, [("s", 2, 1, None), ("s", 2, 2, "1")])
    assert {r.type: r.n for r in CL.type_census(cells).collect()} == {"empty": 1, "numeric": 1}


def test_survey_sheets_without_date_or_with_another_site_name(spark):
    a = spark.createDataFrame([("s1", "GF,Br1 1/61 0", "Datum"), ("s1", "GF,Br1 1/61 0", "91/05/03"), ("s1", None, "91/05/03")], "ods_names_clean string, messstelle string, datum string")
    b = spark.createDataFrame([("s2", "GE,Br2 2/62 0", "7")], "ods_names_clean string, messstelle string, lf string")
    c = spark.createDataFrame([("s3", "GO,,3 3/63 0", "91/06/04")], "ods_names_clean string, messstellen string, datum string")
    plan = spark.createDataFrame([("s1", 0), ("s2", 1), ("s3", 2)], "ods_names_clean string, skip_rows int")
    out = C.survey_table({"a": a, "b": b, "c": c}, plan).collect()
    assert sorted((r.sheet, r.messstelle, str(r.datum), r.skip_rows) for r in out) == [
        ("a", "GF,Br1 1/61 0", "1991-05-03", 0), ("b", "GE,Br2 2/62 0", "None", 1), ("c", "GO,,3 3/63 0", "1991-06-04", 2)]


def test_solver_keeps_every_name_and_refuses_repeats(spark):
    data = spark.createDataFrame([("a", "Cl", 1.0), ("a", "K", 2.0), ("b", "Cl", None)], "probe_nr string, par_name_phreeqc string, numeric_value double")
    assert {(r.solution, r.par_name_phreeqc, r.numeric_value) for r in C.solver_long(data).collect()} == {("a", "Cl", 1.0), ("a", "K", 2.0)}
    with pytest.raises(Q.QualityError):
        C.solver_long(data.union(data))


def test_null_group_fails_too(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("g", 2)], "file string, id int")
    status = Q.group_status(df, "file", {"dup": Q.duplicated_samples(df, ["file", "id"])})
    assert {r.file: r.status for r in status.collect()} == {None: "failed", "g": "ok"}
    assert [r.file for r in Q.keep_good_groups(df, status, "file").collect()] == ["g"]


def test_times_in_a_daylight_saving_gap_and_malformed_times(spark):
    df = spark.createDataFrame([("2023-03-26-0230", "2023-03-26 02:30:00", "2023-03-26T02:30:00Z"), ("x", "not a time", "2023-03-26 02:30")], "a string, b string, c string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = df.select(
            S.local_plus_one_to_utc("a", "yyyy-MM-dd-HHmm").cast("string"),
            S.local_plus_one_to_utc("b").cast("string"),
            S.parse_utc_text("c").cast("string"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [("2023-03-26 01:30:00", "2023-03-26 01:30:00", "2023-03-26 02:30:00"), (None, None, None)]


def test_survey_files_of_one_clean_name_and_leading_digits(spark):
    paths = spark.createDataFrame([("d/91GWN.ods",), ("d/B2-west.ods",), ("d/B2 west.ods",)], "ods_paths string")
    assert sorted(r.ods_names_clean for r in SR.import_plan(paths).collect()) == ["b2_west", "b2_west_2", "x91gwn"]


def test_encoded_file_names_and_swapped_stream_columns(spark, tmp_path):
    folder = tmp_path / "K 09 ä+"
    folder.mkdir()
    (folder / "a.csv").write_text("Geraet,DatumUhrzeit,Leitfaehigkeit,Temperatur\n4182018,2023-01-01 00:00:00,900,11.5\n")
    assert SR.read_sensor_files(spark, str(folder), str(tmp_path)).first().file == "K 09 ä+/a.csv"
    (folder / "b.csv").write_text("Geraet,DatumUhrzeit,Temperatur,Leitfaehigkeit\n4182018,2023-01-01 00:00:00,11.5,900\n")
    query = sensor_stream(spark, str(tmp_path)).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        query.awaitTermination()


def test_all_null_groups_count_zero(spark):
    df = spark.createDataFrame([("a", None)], "k string, v string")
    assert A.count_distinct_by(df, ["k"], "v", "n").first().n == 0


def test_no_machine_local_scratch_on_a_cluster():
    from wellspring.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
