"""Aggregations that merge few rows are dealt over all shuffle partitions, whatever AQE would merge."""

import pytest
from pyspark.sql import functions as F

from wellspring.operators import cells as CL
from wellspring.plans import queries_cells, queries_lab
from wellspring.session import dealt

SCHEMA = "file_name string, sheet_name string, row_idx long, col_idx long, value string"


class Lines:
    def __init__(self, **tables):
        self.__dict__.update(tables)


def spread(df):
    """Whether the rows lie in more partitions than there are cores."""
    return df.select(F.spark_partition_id()).distinct().count() > df.sparkSession.sparkContext.defaultParallelism


@pytest.fixture(autouse=True)
def more_partitions_than_cores(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3 * spark.sparkContext.defaultParallelism)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


def meta(spark, n):
    head = [("f", "META", 1, i + 1, v) for i, v in enumerate(CL.META_FIELDS)]
    body = [("f", "META", r, i + 1, v) for r in range(2, n) for i, v in enumerate(("1 a", f"n{r}", f"c{r}"))]
    unnamed = [("f", "META", 3, 9, "without a field"), ("f", "META", n, 9, "no row")]
    return spark.createDataFrame([*head, *body, *unnamed], SCHEMA)


def test_meta_rows_meet_their_header_in_blocks(spark, monkeypatch):
    cells = meta(spark, 400)
    whole = sorted(map(str, CL.meta_rows(cells).collect()))
    monkeypatch.setattr(CL, "META_BLOCK", 16)
    rows = CL.meta_rows(cells)
    assert sorted(map(str, rows.collect())) == whole and len(whole) == 398
    plan = rows._jdf.queryExecution().toString()
    assert "__block" in plan and "hashpartitioning(file_name" in plan
    assert rows.where("OriginalName = 'n3'").first().meta == {"Sheet": "1 a", "OriginalName": "n3", "Name": "c3"}


def test_dealt_partitions_are_not_merged(spark):
    few = spark.range(1000).withColumn("k", F.col("id"))
    assert spread(dealt(few, "k").groupBy("k").count())
    assert not spread(few.groupBy("k").count())


def test_header_and_sheet_rows_are_dealt(spark):
    head = [("f", "1 a", 1, c, f"h{c}") for c in range(1, 200)]
    body = [("f", "1 a", r, 1 + r % 199, str(r)) for r in range(2, 300)]
    cells = spark.createDataFrame(head + body, SCHEMA)
    assert spread(CL.header_rows(cells, 1))
    columns = CL.header_rows(cells, 1).select(*CL.SHEET, "col_idx", F.col("h1").alias("__name"), F.lit("v").alias("__role"), F.lit(1).alias("__depth"))
    rows = CL.sheet_rows(cells, columns, [], False)
    assert rows.count() == 298 and spread(rows)


def test_tables_of_samples_are_dealt(spark, tmp_path):
    lines = spark.range(300).selectExpr(
        "id div 3 AS l_orderkey", "id AS l_partkey", "1L AS l_suppkey", "CAST(id % 3 + 1 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity",
        "10D AS l_extendedprice", "0.04D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag", "'O' AS l_linestatus", "TIMESTAMP '2020-01-02' AS l_shipdate",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    wide = queries_lab.lab_wide(spark, str(tmp_path))
    assert wide.count() == 100 and wide.where("L1 + 1 = L2 AND L2 + 1 = L3 AND L4 IS NULL").count() == 100
    assert spread(wide)
    assert spread(queries_lab.solver_long(spark, str(tmp_path)))
    t = Lines(
        lineitem=spark.read.parquet(str(tmp_path / "lineitem.parquet")),
        supplier=spark.createDataFrame([(1, 4)], "s_suppkey long, s_nationkey int"),
        nation=spark.createDataFrame([(4, "N")], "n_nationkey int, n_name string"),
    )
    assert queries_cells.sheet_values(t).count() == 300 and spread(queries_cells.sheet_values(t))
    assert spread(queries_lab.current_lab_wide(t))
