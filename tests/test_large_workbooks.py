"""What keeps the time and the disk of large workbooks small: lookups whose size is known, rows that are moved once."""

import re
import time

import pytest
from pyspark.sql import functions as F

from wellspring import session
from wellspring.operators import cells as CL
from wellspring.operators import joins as J
from wellspring.plans import queries_cells as QC
from wellspring.tables import Tables

SCHEMA = "file_name string, sheet_name string, row_idx long, col_idx long, value string"


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that are written, in order."""
    plans = []
    was = session.cut_at

    def cut_at(df, *args, **more):
        plans.append((plan(df, "optimizedPlan"), plan(df)))
        return was(df, *args, **more)

    monkeypatch.setattr(session, "cut_at", cut_at)
    monkeypatch.setattr(QC, "cut_at", cut_at)
    return plans


def workbook(spark):
    two = [("two.xlsx", "66 K", r, c, f"{'nu'[r - 1]}{c}") for r in (1, 2) for c in range(3, 40)]
    kept = [(f, s, 1, 1, "Datum") for f, s in (("two.xlsx", "66 K"), ("one.xlsx", "S1"))]
    body = [("two.xlsx", "66 K", 3, c, str(c)) for c in range(3, 40)] + [("one.xlsx", "S1", 2, 2, "9"), ("one.xlsx", "S1", 1, 2, "x")]
    meta = [("one.xlsx", "META", r, c, v) for r, row in enumerate((CL.META_FIELDS, ("S1", "x", "clean")), 1) for c, v in enumerate(row, 1)]
    return spark.createDataFrame(two + kept + body + meta, SCHEMA)


def test_shuffle_files_are_given_back(spark):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    session.free_shuffles(spark)
    time.sleep(2)
    before = shuffles()
    for i in range(4):
        cut = session.cut_lineage(session.dealt(spark.range(100), "id").groupBy((F.col("id") % (i + 2)).alias("k")).count(), free=True)
        assert cut.count() == i + 2
    session.free_shuffles(spark)
    for _ in range(20):
        if shuffles() <= before + 1:
            return
        time.sleep(0.5)
    assert shuffles() <= before + 1


def test_only_header_1_columns_meet_meta(spark, written):
    """The others have no name to look up: in a join by it all of them were dealt by a null."""
    columns = CL.archive_columns(workbook(spark))
    assert columns.count() == 40 and columns.where("Name = 'clean'").count() == 1
    optimized = next(o for o, _ in written if "__original" in o and "Join LeftOuter" in o)
    assert optimized.index("Union") < optimized.index("Join LeftOuter")


def test_only_kept_columns_are_sorted(spark):
    found = CL.archive_columns(workbook(spark))
    kinds = {r["__role"]: r["count"] for r in found.groupBy("__role").count().collect()}
    assert kinds == {"v": 38, "k": 2}
    window = plan(found, "optimizedPlan")
    below = window[window.index("Window ") :]
    assert re.search(r"Filter .*__is_kept", below), window


def test_sorts_begin_with_numbers(spark):
    cells = workbook(spark)
    assert "Sort [col_idx" in plan(CL.header_rows(cells, 2))
    columns = CL._prepared(CL.header_metadata(cells, CL.HEADER_2), "key", 2, None)
    rows = CL.sheet_rows(cells, columns, ["Datum"], False)
    assert "keys=[row_idx" in plan(rows)
    out = CL.long_cells(rows, columns, ["key"])
    assert out.columns[:3] == ["file_name", "sheet_name", "col_idx"] and "[col_idx" in plan(out)


def test_rows_without_the_map_of_meta(spark):
    more = [("one.xlsx", "META", 3, 1, "S1"), ("one.xlsx", "META", 3, 2, "y"), ("one.xlsx", "META", 3, 2, "x2"), ("one.xlsx", "META", 3, 9, "no field")]
    more += [("one.xlsx", "META", 1, 4, "Name"), ("one.xlsx", "META", 3, 4, "right"), ("one.xlsx", "META", 4, 1, "S1"), ("one.xlsx", "META", 4, 2, "x"), ("one.xlsx", "META", 4, 3, None)]
    cells = workbook(spark).unionByName(spark.createDataFrame(more, SCHEMA))
    rows = CL.meta_rows(cells, meta_map=False)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, CL.meta_rows(cells).drop("meta").collect()))
    assert {(r.OriginalName, r.Name, r.n_described) for r in rows.collect()} == {("x", "clean", 2), ("x2", "right", 1)}


def test_lines_are_added_up_once(spark, sf_dir, written):
    cells = QC.archive_cells(Tables(spark, sf_dir))
    assert sum(executed.count("lineitem.parquet") for _, executed in written) == 1
    assert cells.where("sheet_name = 'META' AND row_idx = 1").count() == 3
    assert cells.where("value IS NULL").isEmpty()


def test_rows_and_columns_of_null_keys(spark):
    vals = spark.createDataFrame([("f", "1 a", None, 1), ("f", "1 a", 5, 2), ("f", "1 a", 5, 2)], "file_name string, sheet_name string, k long, n long")
    about = spark.createDataFrame([(None, "null"), (5, "five"), (5, "again")], "key long, what string")
    out = QC._keyed_rows(vals, "k", about, "key")
    assert sorted(map(str, (tuple(r) for r in out.select("k", "what").collect()))) == ["(5, 'again')", "(5, 'five')", "(None, 'null')"]


def test_lookup_moves_no_row(spark):
    data = spark.range(100).select(F.col("id").cast("string").alias("VariableName_org"))
    names = spark.range(3000).select(F.col("id").cast("string").alias("VariableName_org"), (F.col("id") % 7).alias("para_id")).distinct()
    parameters = spark.range(3000).select((F.col("id") % 7).alias("para_id"), F.lit("x" * 50).alias("kind")).distinct()
    out = J.add_parameter_metadata(data, names, parameters)
    assert "BroadcastHashJoin" in plan(out) and "Exchange hashpartitioning" not in plan(out)
    assert out.count() == 100
