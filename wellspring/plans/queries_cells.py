"""Workbook (cells relation) queries: S-07 ... S-11, R-02 ... R-06, J-06, J-07, P-17,
P-21, P-22, A-10, H-18, H-20, H-24, Q-D ... Q-F, C-04.

The cells relation is derived from the driver tables: one workbook per
return flag, one sheet per supplier nation ('<nationkey> <name>', a site
sheet), one row per order, one column per part.  Header rows come from
``part``; body values are the summed quantities.  Row and column indices are
BIGINT so they do not overflow at large scale factors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import gather_ignore_pattern
from ..operators import cells as CL
from ..operators import joins as J
from ..operators import quality as Q
from ..session import cut_at, cut_lineage, dealt, drop_scratch, scratch_path
from ..tables import Tables
from . import composites as C
from .oracle import ORACLE
from .queries import register

FIRST_PART_COL = 3  # columns 1 and 2 hold the date and the sample id
KEPT_COLUMNS = ("Datum", "Probe_Nr")
CELL_COLS = ("file_name", "sheet_name", "row_idx", "col_idx", "value")


def _cell(df: DataFrame, row, col, value) -> DataFrame:
    return df.select(
        "file_name", "sheet_name",
        (row if not isinstance(row, int) else F.lit(row)).cast("long").alias("row_idx"),
        (col if not isinstance(col, int) else F.lit(col)).cast("long").alias("col_idx"),
        (value if not isinstance(value, str) else F.lit(value)).cast("string").alias("value"),
    )


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def sheet_values(t: Tables) -> DataFrame:
    """(file, sheet, order, part, summed quantity, nation) -- one body cell each."""
    sup = J.keyed_join(
        t.supplier.select("s_suppkey", "s_nationkey"), t.nation, ["s_nationkey"], ["n_nationkey"], columns=["n_name"]
    ).select("s_suppkey", "s_nationkey", F.concat_ws(" ", F.col("s_nationkey").cast("string"), "n_name").alias("sheet_name"))
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    # written, so that its size is known when the join is planned: a small one moves no line
    b = J.keyed_join(li, cut_lineage(sup), ["l_suppkey"], ["s_suppkey"], how="inner")
    b = b.select(
        F.concat(F.lit("lab_"), "l_returnflag", F.lit(".xlsx")).alias("file_name"),
        "sheet_name", "s_nationkey", "l_orderkey", "l_partkey", "l_quantity",
    )
    return dealt(b, "l_orderkey", "l_partkey").groupBy("file_name", "sheet_name", "s_nationkey", "l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))


def _part_header_values(n_header: int):
    unit = F.when(F.col("p_size") >= 5, F.col("p_brand"))
    if n_header == 2:
        return [F.col("p_name"), unit]
    limit = F.when(F.col("p_size") > 40, F.col("p_size").cast("string"))
    return [F.col("p_name"), F.col("p_type"), unit, limit]


def lab_cells(t: Tables, n_header: int = 2, meta: bool = False) -> DataFrame:
    """Cells of header-n sheets (or header-1 sheets described by a META sheet),
    written once to the shared checkpoint folder: like a workbook export it
    is an input table that several stages read."""
    return _written_cells(t, sheet_values(t), [(None, n_header, meta)])


def _written_cells(t: Tables, vals: DataFrame, layouts: list[tuple[str | None, int, bool]]) -> DataFrame:
    spark = vals.sparkSession
    path = scratch_path(spark, "values")
    cells = cut_lineage(_cells_of(t, cut_at(vals, path, free=True), layouts), free=True)
    drop_scratch(spark, path)
    return cells


def _lab_cells(t: Tables, n_header: int, meta: bool) -> DataFrame:
    # several branches read other columns of the per-cell values: written, their lines are added up once for all
    return _cells_of(t, cut_lineage(sheet_values(t), free=True), [(None, n_header, meta)])


def _struct(sheet, row, col, value):
    """A cell of a file."""
    return F.struct(
        sheet.alias("sheet_name"),
        (F.lit(row) if isinstance(row, int) else row).cast("long").alias("row_idx"),
        (F.lit(col) if isinstance(col, int) else col).cast("long").alias("col_idx"),
        (F.lit(value) if isinstance(value, str) else value).cast("string").alias("value"),
    )


def _keyed_rows(vals: DataFrame, key: str, about: DataFrame, about_key: str) -> DataFrame:
    """``about`` for each (file, sheet, ``key``), also for a null key.  Dealt by the key alone, the rows meet
    ``about`` where they lie."""
    keys = vals.select("file_name", "sheet_name", key)
    known = dealt(keys.where(F.col(key).isNotNull()), key).distinct()
    unknown = keys.where(F.col(key).isNull()).distinct()
    found = J.keyed_join(known, about, [key], [about_key], null_safe=False)
    rest = J.keyed_join(unknown, about.where(F.col(about_key).isNull()), [key], [about_key])
    return found.unionByName(rest)


def _cells_of(t: Tables, vals: DataFrame, layouts: list[tuple[str | None, int, bool]]) -> DataFrame:
    """Cells of the workbooks with the values ``vals``.  ``layouts`` has (file, header rows, with a META sheet) of each
    file that ``vals`` has, or (None, ...) for all of them.  All cells of a row or column are made in one pass."""

    def by_file(make):
        if layouts[0][0] is None:
            return make(*layouts[0][1:])
        return F.coalesce(*[F.when(F.col("file_name") == file, make(n, meta)) for file, n, meta in layouts])

    with_meta = by_file(lambda n, meta: F.lit(meta))
    row = (F.col("l_orderkey") + by_file(lambda n, meta: F.lit(2 if meta else n + 1))).cast("long")
    col = (F.col("l_partkey") + FIRST_PART_COL).cast("long")
    sheet, meta_sheet = F.col("sheet_name"), F.lit("META")
    nat = F.regexp_substr(sheet, F.lit("^[0-9]+")).cast("long")
    original = F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" "), F.col("p_name"))
    clean = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    # META rows: 2.. for the kept columns of each sheet, 1000.. for parts;
    # unique per file because sheet codes are nation keys (< 32).
    part_row = F.col("l_partkey") * 32 + nat + 1000

    def part_cells(n, meta):
        if not meta:
            return F.array(*[_struct(sheet, i + 1, col, v) for i, v in enumerate(_part_header_values(n))])
        return F.array(
            _struct(sheet, 1, col, original),
            *[_struct(meta_sheet, part_row, i + 1, v) for i, v in enumerate((sheet, original, clean))],
        )

    def sheet_cells(n, meta):
        own = [_struct(sheet, 1, j + 1, name) for j, name in enumerate(KEPT_COLUMNS)]
        described = [
            _struct(meta_sheet, F.lit(2) + nat * 2 + j, i + 1, v)
            for j, name in enumerate(KEPT_COLUMNS)
            for i, v in enumerate((sheet, F.lit(name), F.lit(name)))
        ]
        return F.array(*own, *(described if meta else []))

    # two-decimal text of the (integral) summed quantity
    body = _cell(vals, row, col, F.col("q").cast("decimal(18,2)").cast("string"))
    # kept cells of a row (date, sample id) in one pass: one struct per cell
    rows = _keyed_rows(vals, "l_orderkey", t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
    row_cells = F.array(
        _struct(sheet, row, 1, F.date_format("o_orderdate", "yyyy-MM-dd")),
        _struct(sheet, row, 2, F.col("l_orderkey").cast("string")),
    )
    parts = _keyed_rows(vals, "l_partkey", t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "p_partkey")
    # empty header cells are absent; META workbooks have them
    part_head = parts.select("file_name", F.inline(by_file(part_cells))).where(F.col("value").isNotNull() | with_meta)
    sheets = vals.select("file_name", "sheet_name").distinct()
    frames = [
        sheets.select("file_name", F.inline(by_file(sheet_cells))),
        part_head,
        rows.select("file_name", F.inline(row_cells)),
        body,
    ]
    if any(meta for _, _, meta in layouts):
        files = vals.select("file_name").distinct().where(with_meta)
        frames.append(files.select("file_name", F.inline(F.array(*[_struct(meta_sheet, 1, i + 1, name) for i, name in enumerate(CL.META_FIELDS)]))))
    return _union([f.select(*CELL_COLS) for f in frames])


_B = """
b AS (
  SELECT 'lab_' || l_returnflag || '.xlsx' AS file_name, CAST(s_nationkey AS VARCHAR) || ' ' || n_name AS sheet_name,
         s_nationkey, l_orderkey, l_partkey, sum(l_quantity) AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey IS NOT DISTINCT FROM n_nationkey
  GROUP BY ALL)
"""


# --- R-03 / R-05 / R-06 / J-06 / H-18 (header-2) ------------------------------------
@register("header2_cells")
def header2_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.gather_with_header(lab_cells(Tables(spark, sf_dir), 2), CL.HEADER_2, kept_map=False)


ORACLE["header2_cells"] = "WITH " + _B + """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS Datum, CAST(l_orderkey AS VARCHAR) AS Probe_Nr,
       p_name || CASE WHEN p_size >= 5 THEN '@' || p_brand ELSE '' END AS "key",
       printf('%.2f', q) AS DataValue, p_name AS VariableName_org,
       CASE WHEN p_size >= 5 THEN p_brand END AS UnitName_org,
       file_name, sheet_name, CAST(s_nationkey AS DOUBLE) AS site_id,
       CAST(l_orderkey + 3 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx
FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


# --- R-04 (header-4) -----------------------------------------------------------------------
@register("header4_cells")
def header4_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.gather_with_header(lab_cells(Tables(spark, sf_dir), 4), CL.HEADER_4, kept_map=False)


ORACLE["header4_cells"] = "WITH " + _B + """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS Datum, CAST(l_orderkey AS VARCHAR) AS Probe_Nr,
       p_name || '@' || p_type || '@' || coalesce(CASE WHEN p_size >= 5 THEN p_brand END, 'NA') || '@'
         || coalesce(CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) END, 'NA') AS "key",
       printf('%.2f', q) AS DataValue, p_name AS VariableName_org, p_type AS Method,
       CASE WHEN p_size >= 5 THEN p_brand END AS UnitName_org,
       CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) END AS Limit_TrinkWV,
       file_name, sheet_name, CAST(s_nationkey AS DOUBLE) AS site_id,
       CAST(l_orderkey + 5 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx
FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


# --- R-02 / J-07 (header-1 with META sheet) -------------------------------------------------
@register("header1_cells")
def header1_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.gather_with_meta(lab_cells(Tables(spark, sf_dir), meta=True), kept_map=False, meta_map=False)


ORACLE["header1_cells"] = "WITH " + _B + """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS Datum, CAST(l_orderkey AS VARCHAR) AS Probe_Nr,
       'p' || CAST(l_partkey AS VARCHAR) AS VariableName_org, printf('%.2f', q) AS DataValue,
       'P' || CAST(l_partkey AS VARCHAR) || ' ' || p_name AS OriginalName, 'p' || CAST(l_partkey AS VARCHAR) AS Name,
       file_name, sheet_name, CAST(l_orderkey + 2 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx
FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


@register("header1_undescribed")
def header1_undescribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """META without the rows of every third part: those columns keep their original name."""
    cells = lab_cells(Tables(spark, sf_dir), meta=True)
    part = F.floor((F.col("row_idx") - 1000) / 32)
    gone = (F.col("sheet_name") == "META") & (F.col("row_idx") >= 1000) & (part % 3 == 0)
    return CL.gather_with_meta(cells.where(~gone), kept_map=False, meta_map=False)


ORACLE["header1_undescribed"] = "WITH " + _B + """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS Datum, CAST(l_orderkey AS VARCHAR) AS Probe_Nr,
       CASE WHEN l_partkey % 3 = 0 THEN 'P' || CAST(l_partkey AS VARCHAR) || ' ' || p_name
            ELSE 'p' || CAST(l_partkey AS VARCHAR) END AS VariableName_org, printf('%.2f', q) AS DataValue,
       'P' || CAST(l_partkey AS VARCHAR) || ' ' || p_name AS OriginalName,
       CASE WHEN l_partkey % 3 <> 0 THEN 'p' || CAST(l_partkey AS VARCHAR) END AS Name,
       file_name, sheet_name, CAST(l_orderkey + 2 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx
FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


SECOND_DATE_COL = 1 << 40


@register("dropped_columns_report")
def dropped_columns_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth part without a header and a second 'Datum' column in every sheet:
    the gathered cells and the report together hold every body cell."""
    cells = lab_cells(Tables(spark, sf_dir), 2)
    no_header = (F.col("row_idx") <= 2) & (F.col("col_idx") >= FIRST_PART_COL) & ((F.col("col_idx") - FIRST_PART_COL) % 5 == 0)
    second = cells.where(F.col("col_idx") == 1).withColumn("col_idx", F.lit(SECOND_DATE_COL))
    return CL.dropped_columns(cells.where(~no_header).unionByName(second))


ORACLE["dropped_columns_report"] = "WITH " + _B + f"""
SELECT file_name, sheet_name, CAST(l_partkey + 3 AS BIGINT) AS col_idx, CAST(NULL AS VARCHAR) AS "key",
       'no header' AS reason, count(*) AS n_cells
FROM b WHERE l_partkey % 5 = 0 GROUP BY ALL
UNION ALL
SELECT file_name, sheet_name, CAST({1 << 40} AS BIGINT), 'Datum', 'second kept column', count(DISTINCT l_orderkey)
FROM b GROUP BY ALL
"""


# --- A-10 ---------------------------------------------------------------------------------------
@register("type_census")
def type_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read once: no table is written, and the filter reaches the parts of the union
    cells = _lab_cells(Tables(spark, sf_dir), 2, False)
    return CL.type_census(cells.where(F.col("row_idx") > 2))


ORACLE["type_census"] = "WITH " + _B + """
, s AS (SELECT DISTINCT file_name, sheet_name FROM b),
  p AS (SELECT DISTINCT file_name, sheet_name, l_partkey FROM b)
SELECT 'numeric' AS "type", (SELECT count(*) FROM p) + (SELECT count(*) FROM s) AS n
UNION ALL
SELECT 'date' AS "type", (SELECT count(*) FROM s) AS n
"""


# --- P-17 -----------------------------------------------------------------------------------------
@register("column_split")
def column_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = CL.header_metadata(_lab_cells(Tables(spark, sf_dir), 2, False), CL.HEADER_2)
    keys = meta.select("key").distinct()
    return keys.withColumn("is_kept", F.coalesce(F.col("key").rlike(gather_ignore_pattern()), F.lit(False)))


ORACLE["column_split"] = "WITH " + _B + f"""
, k AS (SELECT DISTINCT p_name || CASE WHEN p_size >= 5 THEN '@' || p_brand ELSE '' END AS "key"
        FROM b JOIN part ON l_partkey = p_partkey
        UNION SELECT 'Datum' UNION SELECT 'Probe_Nr')
SELECT "key", coalesce(regexp_matches("key", '{gather_ignore_pattern()}'), false) AS is_kept FROM k
"""


# --- P-21 / P-22 / Q-E / Q-F / C-04 -------------------------------------------------------------------
def archive_sheets(t: Tables) -> DataFrame:
    """Sheet list of archive workbooks, one workbook per customer nation."""
    c = t.customer
    name = (
        F.when((F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"), F.lit("META"))
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"),
              F.concat(F.col("c_custkey").cast("string"), F.lit(" site")))
        .otherwise(F.concat(F.lit("Info_"), F.col("c_mktsegment")))
    )
    return c.select(F.concat(F.lit("archive_"), F.col("c_nationkey").cast("string")).alias("file_name"),
                    name.alias("sheet_name"))


_SHEETS = """
sh AS (SELECT DISTINCT 'archive_' || CAST(c_nationkey AS VARCHAR) AS file_name,
         CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'META'
              WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN CAST(c_custkey AS VARCHAR) || ' site'
              ELSE 'Info_' || c_mktsegment END AS sheet_name
       FROM customer)
"""


@register("sheet_layout")
def sheet_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = CL.sheet_layouts(archive_sheets(Tables(spark, sf_dir)))
    return lay.withColumns({
        "meta_violation": (F.col("n_meta_sheets") > 0) & (F.col("n_meta_sheets") != 1),
        "site_violation": (F.col("layout") != "header1") & (F.col("n_site_sheets") == 0),
    })


ORACLE["sheet_layout"] = "WITH " + _SHEETS + """
, f AS (SELECT file_name,
          count(CASE WHEN regexp_matches(sheet_name, 'META') THEN 1 END) AS n_meta_sheets,
          count(CASE WHEN regexp_matches(sheet_name, '^[0-9]{1,4}') THEN 1 END) AS n_site_sheets,
          count(CASE WHEN NOT regexp_matches(sheet_name, 'META') AND NOT regexp_matches(sheet_name, '^[0-9]{1,4}')
                     THEN 1 END) AS n_other_sheets
        FROM sh GROUP BY file_name)
SELECT *, CASE WHEN n_meta_sheets > 0 THEN 'header1' WHEN n_site_sheets > 0 THEN 'header2' ELSE 'none' END AS layout,
       n_meta_sheets > 0 AND n_meta_sheets <> 1 AS meta_violation,
       (CASE WHEN n_meta_sheets > 0 THEN 'header1' WHEN n_site_sheets > 0 THEN 'header2' ELSE 'none' END) <> 'header1'
         AND n_site_sheets = 0 AS site_violation
FROM f
"""


# --- Q-D -------------------------------------------------------------------------------------------------
@register("missing_sheets")
def missing_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing_sheets(archive_sheets(Tables(spark, sf_dir)), ["META", "Info_HOUSEHOLD"])


ORACLE["missing_sheets"] = "WITH " + _SHEETS + """
, need AS (SELECT DISTINCT file_name, x.sheet_name FROM sh, (VALUES ('META'), ('Info_HOUSEHOLD')) x(sheet_name))
SELECT file_name, sheet_name FROM need
EXCEPT SELECT file_name, sheet_name FROM sh
"""


# --- S-08 / S-11 / H-20 --------------------------------------------------------------------------------------
MASTER_HEADER = ("Interne Nr.", "Name der Messstelle", "Prüfgegenstand", "Werk")
MASTER_COLUMNS = ("interne_nr", "name_der_messstelle", "prufgegenstand", "werk")


def master_cells(t: Tables) -> DataFrame:
    """'Stammdaten' sheet: a header row and one row per customer."""
    c = t.customer.withColumn("file_name", F.lit("stammdaten.xlsx")).withColumn("sheet_name", F.lit("Stammdaten"))
    row = F.col("c_custkey") + 2
    head = c.select("file_name", "sheet_name").distinct()
    parts = [_cell(head, 1, i + 1, name) for i, name in enumerate(MASTER_HEADER)]
    for i, src in enumerate(("c_custkey", "c_name", "c_mktsegment", "c_nationkey")):
        parts.append(_cell(c, row, i + 1, F.col(src).cast("string")))
    return _union(parts)


@register("cells_to_table")
def cells_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.cells_to_table(cut_lineage(master_cells(Tables(spark, sf_dir))), MASTER_COLUMNS)


ORACLE["cells_to_table"] = """
SELECT 'stammdaten.xlsx' AS file_name, 'Stammdaten' AS sheet_name, CAST(c_custkey + 2 AS BIGINT) AS row_idx,
       CAST(c_custkey AS VARCHAR) AS interne_nr, c_name AS name_der_messstelle, c_mktsegment AS prufgegenstand,
       CAST(c_nationkey AS VARCHAR) AS werk
FROM customer
"""


@register("cells_to_table_sheets")
def cells_to_table_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sheets with different headers in the same columns become one table."""
    t = Tables(spark, sf_dir)
    s = t.supplier.withColumn("file_name", F.lit("stammdaten.xlsx")).withColumn("sheet_name", F.lit("Lieferanten"))
    head = s.select("file_name", "sheet_name").distinct()
    other = [_cell(head, 1, i + 1, name) for i, name in enumerate(("Werk", "Werk", "Interne Nr."))]
    for i, src in enumerate(("s_nationkey", "s_name", "s_suppkey")):
        other.append(_cell(s, F.col("s_suppkey") + 2, i + 1, F.col(src).cast("string")))
    cells = cut_lineage(_union([master_cells(t), *other]))
    return CL.cells_to_table(cells, [*MASTER_COLUMNS, "werk_2"])


ORACLE["cells_to_table_sheets"] = """
SELECT 'stammdaten.xlsx' AS file_name, 'Stammdaten' AS sheet_name, CAST(c_custkey + 2 AS BIGINT) AS row_idx,
       CAST(c_custkey AS VARCHAR) AS interne_nr, c_name AS name_der_messstelle, c_mktsegment AS prufgegenstand,
       CAST(c_nationkey AS VARCHAR) AS werk, CAST(NULL AS VARCHAR) AS werk_2
FROM customer
UNION ALL
SELECT 'stammdaten.xlsx', 'Lieferanten', CAST(s_suppkey + 2 AS BIGINT), CAST(s_suppkey AS VARCHAR), NULL, NULL,
       CAST(s_nationkey AS VARCHAR), s_name
FROM supplier
"""


# --- H-24 -------------------------------------------------------------------------------------------------------
@register("header_programme")
def header_programme(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _lab_cells(Tables(spark, sf_dir), 4, False)
    head = cells.where((F.col("row_idx") <= 4) & (F.col("col_idx") >= FIRST_PART_COL))
    return head.groupBy("file_name", "sheet_name", "col_idx").agg(
        CL.S.ordered_join("row_idx", "value", "@").alias("programme")
    )


ORACLE["header_programme"] = "WITH " + _B + """
, p AS (SELECT DISTINCT file_name, sheet_name, l_partkey FROM b)
SELECT file_name, sheet_name, CAST(l_partkey + 3 AS BIGINT) AS col_idx,
       concat_ws('@', p_name, p_type, CASE WHEN p_size >= 5 THEN p_brand END,
                 CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) END) AS programme
FROM p JOIN part ON l_partkey = p_partkey
"""



# --- C-04: archive of mixed layouts -------------------------------------------------------------
ARCHIVE_LAYOUTS = {"R": ("meta", 0), "A": ("header", 2), "N": ("header", 4)}


def archive_cells(t: Tables) -> DataFrame:
    """One archive: lab_R as a META (header-1) workbook, lab_A with 2 and
    lab_N with 4 header rows -- each workbook built from its own lines."""
    layouts = [(f"lab_{flag}.xlsx", n or 1, kind == "meta") for flag, (kind, n) in ARCHIVE_LAYOUTS.items()]
    return _written_cells(t, sheet_values(t).where(F.col("file_name").isin([file for file, _, _ in layouts])), layouts)


@register("archive_import")
def archive_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.read_archive(archive_cells(Tables(spark, sf_dir)), header4_files=["lab_N.xlsx"], kept_map=False, meta_map=False)


ORACLE["archive_import"] = "WITH " + _B + """
, x AS (SELECT b.*, strftime(o_orderdate, '%Y-%m-%d') AS Datum, CAST(l_orderkey AS VARCHAR) AS Probe_Nr,
               p_name, p_type, p_brand, p_size
        FROM b JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
SELECT Datum, Probe_Nr, 'p' || CAST(l_partkey AS VARCHAR) AS VariableName_org, CAST(CAST(q AS DECIMAL(18,2)) AS VARCHAR) AS DataValue,
       'P' || CAST(l_partkey AS VARCHAR) || ' ' || p_name AS OriginalName, 'p' || CAST(l_partkey AS VARCHAR) AS Name,
       file_name, sheet_name, CAST(l_orderkey + 2 AS BIGINT) AS row_idx, CAST(l_partkey + 3 AS BIGINT) AS col_idx,
       'header1' AS layout
FROM x WHERE file_name = 'lab_R.xlsx'
UNION ALL BY NAME
SELECT Datum, Probe_Nr, p_name || CASE WHEN p_size >= 5 THEN '@' || p_brand ELSE '' END AS "key",
       CAST(CAST(q AS DECIMAL(18,2)) AS VARCHAR) AS DataValue, p_name AS VariableName_org,
       CASE WHEN p_size >= 5 THEN p_brand END AS UnitName_org, file_name, sheet_name,
       CAST(s_nationkey AS DOUBLE) AS site_id, CAST(l_orderkey + 3 AS BIGINT) AS row_idx,
       CAST(l_partkey + 3 AS BIGINT) AS col_idx, 'header2' AS layout
FROM x WHERE file_name = 'lab_A.xlsx'
UNION ALL BY NAME
SELECT Datum, Probe_Nr,
       p_name || '@' || p_type || '@' || coalesce(CASE WHEN p_size >= 5 THEN p_brand END, 'NA') || '@'
         || coalesce(CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) END, 'NA') AS "key",
       CAST(CAST(q AS DECIMAL(18,2)) AS VARCHAR) AS DataValue, p_name AS VariableName_org, p_type AS Method,
       CASE WHEN p_size >= 5 THEN p_brand END AS UnitName_org,
       CASE WHEN p_size > 40 THEN CAST(p_size AS VARCHAR) END AS Limit_TrinkWV,
       file_name, sheet_name, CAST(s_nationkey AS DOUBLE) AS site_id, CAST(l_orderkey + 5 AS BIGINT) AS row_idx,
       CAST(l_partkey + 3 AS BIGINT) AS col_idx, 'header4' AS layout
FROM x WHERE file_name = 'lab_N.xlsx'
"""


# --- Q-H: bad sheets among good ones -------------------------------------------------------------
def faulty_archive(t: Tables) -> DataFrame:
    """``archive_cells`` with faults: in lab_A a body cell of every row of sheet '3 ...' a second time, in lab_N
    a header cell of sheet '4 ...', and in lab_R a second description of a name of sheet '5 ...'."""
    cells = archive_cells(t)
    file, sheet, row, col = (F.col(c) for c in ("file_name", "sheet_name", "row_idx", "col_idx"))
    body = cells.where((file == "lab_A.xlsx") & sheet.startswith("3 ") & (row > 2) & (col == 1))
    head = cells.where((file == "lab_N.xlsx") & sheet.startswith("4 ") & (row == 1) & (col == 1))
    described = cells.where((file == "lab_R.xlsx") & (sheet == "META") & (row == 2 + 5 * 2))
    return cells.unionByName(body.withColumn("value", F.lit("again"))).unionByName(head).unionByName(
        described.withColumn("row_idx", F.lit(900).cast("long"))
    )


@register("archive_good_sheets")
def archive_good_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    long, _ = C.import_archive(faulty_archive(Tables(spark, sf_dir)), header4_files=["lab_N.xlsx"], kept_map=False, meta_map=False)
    return long


ORACLE["archive_good_sheets"] = (
    "SELECT * FROM (" + ORACLE["archive_import"] + """) WHERE NOT (file_name = 'lab_A.xlsx' AND starts_with(sheet_name, '3 '))
  AND NOT (file_name = 'lab_N.xlsx' AND starts_with(sheet_name, '4 ')) AND NOT (file_name = 'lab_R.xlsx' AND starts_with(sheet_name, '5 '))
"""
)


@register("archive_problems")
def archive_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.import_archive(faulty_archive(Tables(spark, sf_dir)), header4_files=["lab_N.xlsx"], kept_map=False, meta_map=False)[1]


ORACLE["archive_problems"] = "WITH " + _B + """
SELECT file_name, sheet_name,
       CASE file_name WHEN 'lab_R.xlsx' THEN 'name described twice' ELSE 'repeated cell' END AS problem,
       CASE file_name WHEN 'lab_A.xlsx' THEN count(DISTINCT l_orderkey) ELSE 1 END AS n
FROM b
WHERE (file_name = 'lab_A.xlsx' AND s_nationkey = 3) OR (file_name = 'lab_N.xlsx' AND s_nationkey = 4)
   OR (file_name = 'lab_R.xlsx' AND s_nationkey = 5)
GROUP BY file_name, sheet_name
"""
