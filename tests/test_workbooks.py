"""Workbooks with faults and of several layouts; the lab and survey workbooks as delivered."""

import pytest

from wellspring.operators import cells as CL
from wellspring.operators import quality as Q
from wellspring.plans import composites as C


def _cells(spark, rows):
    return spark.createDataFrame(rows, "file_name string, sheet_name string, row_idx long, col_idx long, value string")


def sheet(file, name, *rows):
    """Cells of a sheet given as rows of values (None: no cell)."""
    return [(file, name, i, j, v) for i, row in enumerate(rows, 1) for j, v in enumerate(row, 1) if v is not None]


META = sheet("one.xlsx", "META", ("Sheet", "OriginalName", "Name"), ("S1", "Chlorid", "Cl"), ("S1", "Datum", "Datum"), ("S2", "Kalium", "K"))
S1 = sheet("one.xlsx", "S1", ("Datum", "Chlorid", "Ort"), ("2020-01-01", "12", "here"), ("2020-01-02", "13", None))
S2 = sheet("one.xlsx", "S2", ("Datum", "Kalium"), ("2021-01-01", "5"))
TWO = sheet("two.xlsx", "66 KAU", ("Datum", "Cl", None), (None, "mg/l", None), ("2020-02-02", "1", "lost"), (None, "2", None))
FOUR = sheet("four.xlsx", "7 X", ("Datum", "Cl"), (None, "DIN"), (None, "mg/l"), (None, "250"), ("2020-03-03", "9"))
INFO = sheet("two.xlsx", "Info", ("Datum", "Cl"), ("x", "y"))
GOOD = META + S1 + S2 + TWO + FOUR + INFO


def values(df):
    return sorted((r.layout, r.file_name, r.sheet_name, str(r.Datum), r.VariableName_org, r.DataValue) for r in df.collect())


def test_layouts_in_one_table(spark):
    out = C.read_archive(_cells(spark, GOOD), header4_files=["four.xlsx"])
    assert values(out) == sorted([
        ("header1", "one.xlsx", "S1", "2020-01-01", "Cl", "12"), ("header1", "one.xlsx", "S1", "2020-01-02", "Cl", "13"),
        ("header1", "one.xlsx", "S2", "2021-01-01", "K", "5"), ("header2", "two.xlsx", "66 KAU", "2020-02-02", "Cl", "1"),
        ("header2", "two.xlsx", "66 KAU", "None", "Cl", "2"), ("header4", "four.xlsx", "7 X", "2020-03-03", "Cl", "9"),
    ])
    rows = {r.file_name: r for r in out.where("row_idx > 1").collect()}
    assert (rows["four.xlsx"].key, rows["four.xlsx"].Method, rows["four.xlsx"].UnitName_org, rows["four.xlsx"].Limit_TrinkWV) == ("Cl@DIN@mg/l@250", "DIN", "mg/l", "250")
    assert (rows["two.xlsx"].key, rows["two.xlsx"].site_id, rows["one.xlsx"].site_id) == ("Cl@mg/l", 66.0, None)


def test_bodies_are_read_once(spark, tmp_path):
    """The plan has one scan of all cells; the header table is a table of its own."""
    _cells(spark, GOOD).write.parquet(str(tmp_path / "cells"))
    plan = C.read_archive(spark.read.parquet(str(tmp_path / "cells")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path / "cells")) == 1


FAULTS = {
    "repeated body cell": ([("two.xlsx", "66 KAU", 3, 2, "0")], {("two.xlsx", "66 KAU", "repeated cell", 1)}, {"66 KAU"}),
    "repeated kept cell": ([("one.xlsx", "S1", 2, 1, "1999-01-01")], {("one.xlsx", "S1", "repeated cell", 1)}, {"S1"}),
    "repeated header cell": ([("four.xlsx", "7 X", 3, 2, "g/l")], {("four.xlsx", "7 X", "repeated cell", 1)}, {"7 X"}),
    "name described twice": ([("one.xlsx", "META", 9, 1, "S2"), ("one.xlsx", "META", 9, 2, "Kalium"), ("one.xlsx", "META", 9, 3, "K+")], {("one.xlsx", "S2", "name described twice", 1)}, {"S2"}),
    "META column twice": ([("one.xlsx", "META", 1, 4, "Name")], {("one.xlsx", s, "META: META column twice", 1) for s in ("S1", "S2")}, {"S1", "S2"}),
    "two META sheets": (sheet("one.xlsx", "META 2", ("Sheet", "OriginalName", "Name")), {("one.xlsx", s, "META: more than one sheet", 1) for s in ("S1", "S2")}, {"S1", "S2"}),
}


@pytest.mark.parametrize("fault", list(FAULTS))
def test_a_bad_sheet_does_not_end_the_others(spark, fault):
    extra, problems, bad = FAULTS[fault]
    cells = _cells(spark, GOOD + extra)
    good = [v for v in values(C.read_archive(_cells(spark, GOOD), header4_files=["four.xlsx"])) if v[2] not in bad]
    out, report = C.import_archive(cells, header4_files=["four.xlsx"])
    assert values(out) == good
    assert {tuple(r) for r in report.select("file_name", "sheet_name", "problem", "n").collect()} == problems
    # without isolation one value counts for each cell, and no row is doubled
    everything = values(C.read_archive(cells, header4_files=["four.xlsx"]))
    assert len(everything) == 6 and len({v[:4] + v[4:5] for v in everything}) == 6


def test_defined_winners(spark):
    cells = _cells(spark, GOOD + FAULTS["repeated body cell"][0] + FAULTS["name described twice"][0])
    found = {v[2]: v for v in values(C.read_archive(cells))}
    assert found["S2"][4:] == ("K", "5")  # the first description
    assert ("header2", "two.xlsx", "66 KAU", "2020-02-02", "Cl", "0") in values(C.read_archive(cells))  # the smallest value
    out = CL.gather_with_meta(cells.where("file_name = 'one.xlsx'")).collect()
    assert sorted((r.VariableName_org, r.DataValue) for r in out) == [("Cl", "12"), ("Cl", "13"), ("K", "5")]


def test_repeated_names_and_cells_of_plain_tables(spark):
    cells = _cells(spark, sheet("f", "s", ("a", "a", "b"), ("1", "2", "3")) + [("f", "s", 2, 3, "0"), ("f", "s", 1, 3, "z")])
    (row,) = CL.cells_to_table(cells, ["a", "b"], clean=False).collect()
    assert (row.a, row.b) == ("1", "0")


def test_only_in_the_map(spark):
    cells = _cells(spark, sheet("f", "66 K", ("Datum", "Orthophosphat", "Cl"), (None, "mg/l", "mg/l"), ("2020-01-01", "7", "1")))
    report = CL.dropped_columns(cells, kept=CL.KEPT_NAMES).collect()
    assert [(r.col_idx, r.key, r.reason, r.n_cells) for r in report] == [(2, "Orthophosphat@mg/l", "only in the map", 1)]


def lab_cells(extra=()):
    rows = [
        ("labor.xlsx", "Stammdaten", 1, 1, "Name"), ("labor.xlsx", "Analysen", 1, 1, "Labor"),
        *[("labor.xlsx", "Analysen", 5, c, v) for c, v in ((1, "Probe-Nr."), (2, "Messstelle"), (3, "Probenahme Datum"), (4, "Cl@IC@Cl@mg/l"), (60, "K@IC@K@mg/l"), (210, "Na@ICP@Na@µg/l"))],
        *[("labor.xlsx", "Analysen", 6, c, v) for c, v in ((1, "p1"), (2, "S1"), (3, "2020-01-01"), (4, "<0,1"), (60, "9"), (210, "500"))],
        ("labor.xlsx", "Analysen", 8, 1, "p2"), ("labor.xlsx", "Analysen", 8, 4, "n. b."),
    ]
    return rows + list(extra)


def test_lab_workbook_as_delivered(spark):
    out = C.lab_table_from_cells(_cells(spark, lab_cells())).collect()
    assert sorted((r.probe_nr, r.messstelle, r.probenahme_datum, r.par_name, r.par_name_phreeqc, r.numeric_value, r.unit) for r in out) == [
        ("p1", "S1", "2020-01-01", "Cl", "Cl", 0.05, "mg/l"), ("p1", "S1", "2020-01-01", "Na", "Na", 0.5, "mg/l")]
    with pytest.raises(Q.QualityError, match="duplicated samples"):
        C.lab_table_from_cells(_cells(spark, lab_cells([("labor.xlsx", "Analysen", 9, 1, "p1"), ("labor.xlsx", "Analysen", 9, 4, "1")])))
    with pytest.raises(Q.QualityError, match="missing sheets"):
        C.lab_table_from_cells(_cells(spark, [r for r in lab_cells() if r[1] != "Stammdaten"]))


def test_survey_sheet_with_its_own_rows(spark):
    """One file has its header in row 2, its data in rows 6 to 7 and an abbreviated name; one has no dates."""
    a = sheet("GWNGUETE.ods", "t", ("title",), ("Messstelle", "Datum", "Kuppb."), (), (), (), ("GF,Br1", "91/05/03", "1"), ("GF,Br2", "91/05/04", "2"), ("GF,Br3", "91/05/05", "3"))
    b = sheet("B9.ods", "t", ("Programm B",), ("Messstellen", "LF"), ("GE,Br1", "5"), (None, "6"))
    cells = _cells(spark, a + b)
    plan = spark.createDataFrame([("GWNGUETE.ods", "gwnguete", 0, 2, 6, 7), ("B9.ods", "b9", 1, None, None, None)], "ods_files string, ods_names_clean string, skip_rows int, header_row int, first_row int, last_row int")
    out = C.survey_from_cells(cells, plan, ["ku_sto", "kupp_st", "lf"]).collect()
    assert sorted((r.ods_names_clean, r.messprogramm, r.messstelle, str(r.datum), r.ku_sto, r.lf) for r in out) == [
        ("b9", "Programm B", "GE,Br1", "None", None, "5"), ("gwnguete", None, "GF,Br1", "1991-05-03", "1", None), ("gwnguete", None, "GF,Br2", "1991-05-04", "2", None)]


def test_rules_are_counted_while_a_table_is_written(spark):
    df = spark.createDataFrame([("Cl", "mg/l"), ("pH", ""), ("Na", "g/l")], "par_name_phreeqc string, unit string")
    with pytest.raises(Q.QualityError, match="units: 1 rows"):
        Q.written_checked(df, {"units": Q.is_unit_violation(), "names": df.par_name_phreeqc.isNull()})
    assert Q.written_checked(df.where("unit <> 'g/l'"), {"units": Q.is_unit_violation()}).count() == 2
    with pytest.raises(Q.QualityError, match="lookup is empty"):
        Q.written_checked(df.limit(0), {}, required="lookup")


def test_solver_input_and_what_it_leaves_out(spark):
    lab = spark.createDataFrame([("a", "Cl", "mg/l", 1.0), ("a", "pH", "", 7.0), ("b", "Mg", "mg/l", 2.0), ("b", "", "x", 9.0)], "probe_nr string, par_name_phreeqc string, unit string, numeric_value double")
    wide, left_out = C.solver_wide(C.solver_data(lab), ["Cl", "pH"])
    assert sorted(map(tuple, wide.collect())) == [("a", 1.0, 7.0), ("b", None, None)]
    assert [tuple(r) for r in left_out.collect()] == [("Mg", 1)]
    with pytest.raises(Q.QualityError, match="twice"):
        C.solver_wide(C.solver_data(lab.union(lab)), ["Cl"])
    with pytest.raises(Q.QualityError, match="units"):
        C.solver_data(spark.createDataFrame([("a", "Cl", "g/l", 1.0)], lab.schema))
