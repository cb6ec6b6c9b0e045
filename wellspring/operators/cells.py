"""Workbook tables on the cells relation (SURVEY §1.4, S-07 ... S-11, R-02 ... R-06,
P-21, P-22, A-10, H-24).

Input contract: ``cells(file_name, sheet_name, row_idx, col_idx, value)``,
1-based, one row per non-empty cell (parquet or CSV).  Header splitting,
gathering and joining of any number of workbooks is one distributed job:

* header rows -> one metadata row per (file, sheet, column) by conditional
  aggregation (no pivot discovery job);
* body cells join the header on (file, sheet, col_idx) -- by position, so
  duplicate header names cannot fan out (Q-7);
* kept columns (dates, sample ids) and value cells meet in one aggregation
  per (file, sheet, row) -- bounded by the sheet width -- so attaching the
  kept columns to every value costs a single shuffle of the body;
* sorts begin with the number of the row or column, not with the name of the file: a
  sort compares eight bytes of its first key before it compares whole rows.

A cell, column name or description that is there more than once never ends a job: one of
them counts by a stated rule, and ``sheet_problems`` names the sheet.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions.names import clean_names, gather_ignore_pattern
from ..session import cut_lineage, dealt

SHEET = ("file_name", "sheet_name")
CELL_COLUMNS = ("file_name", "sheet_name", "row_idx", "col_idx", "value")
HEADER_2 = ("VariableName_org", "UnitName_org")
HEADER_4 = ("VariableName_org", "Method", "UnitName_org", "Limit_TrinkWV")
META_SHEET_PATTERN = "META"
META_FIELDS = ("Sheet", "OriginalName", "Name")
META_BLOCK = 4096  # rows of a META sheet that meet its header in one task
# Kept columns that become columns of the long table; others stay in its map.
KEPT_NAMES = ("Datum", "Probe_Nr")


# S-07 / S-09 --------------------------------------------------------------------
def cell_range(
    cells: DataFrame,
    rows: tuple[int, int | None] = (1, None),
    col_ranges: Sequence[tuple[int, int | None]] = ((1, None),),
) -> DataFrame:
    """Rectangular (or multi-block) range; becomes a pushed parquet filter."""
    r0, r1 = rows
    row_ok = F.col("row_idx") >= r0
    if r1 is not None:
        row_ok = row_ok & (F.col("row_idx") <= r1)
    col_ok = F.lit(False)
    for c0, c1 in col_ranges:
        one = F.col("col_idx") >= c0
        if c1 is not None:
            one = one & (F.col("col_idx") <= c1)
        col_ok = col_ok | one
    return cells.where(row_ok & col_ok)


# R-05 / H-18 -------------------------------------------------------------------------
def header_rows(cells: DataFrame, n: int) -> DataFrame:
    """One row per (file, sheet, col_idx) with a cell in rows 1..n: the cells as ``h1`` ... ``hn`` (of
    repeated cells the smallest value) and ``repeated``, an array of how many too many each row has."""
    row, value = F.col("row_idx"), F.col("value")
    parts = [F.min(F.when(row == i, value)).alias(f"h{i}") for i in range(1, n + 1)]
    surplus = [F.greatest(F.count(F.when(row == i, 1)) - 1, F.lit(0)) for i in range(1, n + 1)]
    head = dealt(cells.where(row <= n), *SHEET, "col_idx")
    found = head.groupBy("col_idx", *SHEET).agg(*parts, F.array(*surplus).alias("repeated"))
    return found.select(*SHEET, "col_idx", *[f"h{i}" for i in range(1, n + 1)], "repeated")


def header_metadata(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per (file, sheet, col_idx) with the header rows as columns,
    the '@' key (all-missing tail removed) and the sheet's site id."""
    rows = header_rows(cells, len(names))
    meta = rows.select(*SHEET, "col_idx", *[F.col(f"h{i + 1}").alias(name) for i, name in enumerate(names)])
    return meta.withColumn("key", S.header_key(list(names))).withColumn("site_id", S.site_id("sheet_name"))


def _roles(columns: DataFrame, name_col: str, keep_pattern: str) -> DataFrame:
    """``columns`` (one row per file, sheet, col_idx) with ``__role``: 'k' for a kept
    column, 'd' for a further kept column of the same name, 'v' for a value column.  They are written
    once: of each sheet only the few kept columns are sorted, and later steps read this small table, not the cells."""
    is_kept = F.coalesce(F.col(name_col).rlike(keep_pattern), F.lit(False))
    written = cut_lineage(columns.withColumn("__is_kept", is_kept), free=True)
    first = F.min("col_idx").over(Window.partitionBy(name_col, *SHEET))
    kept = written.where("__is_kept").withColumn("__role", F.when(F.col("col_idx") == first, F.lit("k")).otherwise(F.lit("d")))
    values = written.where("NOT __is_kept").withColumn("__role", F.lit("v"))
    return values.unionByName(kept).drop("__is_kept")


def _first_of_each(cells: Column, field: str) -> Column:
    """Of the structs with one value of ``field`` the smallest; the arrays without repeats, as nearly all are, stay as they are."""
    ordered = F.sort_array(cells)
    firsts = F.filter(ordered, lambda x, i: (i == 0) | (x[field] != F.get(ordered, i - 1)[field]))
    repeats = F.size(F.array_distinct(F.transform(cells, lambda x: x[field]))) < F.size(cells)
    two = (F.size(cells) == 2) & ~F.get(cells, F.lit(0))[field].eqNullSafe(F.get(cells, F.lit(1))[field])
    return F.when((F.size(cells) < 2) | two, cells).when(repeats, firsts).otherwise(cells)


def sheet_rows(cells: DataFrame, columns: DataFrame, kept: Sequence[str], kept_map: bool) -> DataFrame:
    """One row per sheet row below the header: the ``kept`` names as columns (with ``kept_map`` also all
    kept cells as the map ``kept``), the value cells as ``__vals`` and ``__repeated``, how many cells
    are there more than once.  The one shuffle of the body.

    ``columns`` has one row per (file, sheet, col_idx) with ``__depth``, the number of header
    rows of the sheet, ``__name`` and ``__role``.  Only the kept columns, a few of each sheet, meet the
    body before the shuffle; of a repeated cell the smallest value counts.
    """
    # written, so that their size is known when the joins are planned: small ones move no cell of the body
    sheets = cut_lineage(columns.select(*SHEET, "__depth").distinct())
    keys = cut_lineage(columns.where(F.col("__role") != "v").select(*SHEET, "col_idx", "__name", "__role"))
    body = cells.where(F.col("row_idx") > 1).join(sheets, [*SHEET]).where(F.col("row_idx") > F.col("__depth"))
    role = F.col("__role")
    used = body.join(keys, [*SHEET, "col_idx"], "left").where(role.isNull() | (role == "k"))
    used = used.select(*CELL_COLUMNS, "__name", role.isNotNull().alias("__is_key"))
    per_row = (
        dealt(used, *SHEET, "row_idx")
        .groupBy("row_idx", *SHEET)
        .agg(
            F.collect_list(F.when(F.col("__is_key"), F.struct("__name", "col_idx", "value"))).alias("__keys"),
            F.collect_list(F.when(~F.col("__is_key"), F.struct("col_idx", "value"))).alias("__cells"),
        )
        .withColumns({"__k": _first_of_each(F.col("__keys"), "__name"), "__vals": _first_of_each(F.col("__cells"), "col_idx")})
    )
    by_name = F.map_from_entries(F.transform("__k", lambda x: F.struct(x["__name"], x["value"])))

    def of(name: str) -> Column:
        # without the map of all of them no map is built
        return F.try_element_at(by_name, F.lit(name)) if kept_map else F.get(F.filter("__k", lambda x: x["__name"] == name), F.lit(0))["value"]

    surplus = F.size("__keys") - F.size("__k") + F.size("__cells") - F.size("__vals")
    return per_row.select(
        *SHEET,
        "row_idx",
        *[of(k).alias(k) for k in kept],
        *([by_name.alias("kept")] if kept_map else []),
        "__vals",
        surplus.alias("__repeated"),
    )


def long_cells(rows: DataFrame, columns: DataFrame, carry: Sequence[str]) -> DataFrame:
    """R-06: the value cells of ``sheet_rows`` one by one, with the header columns ``carry``; columns without
    any header drop out (``dropped_columns``).  Joined by position, so equal header names cannot fan out."""
    fixed = [c for c in rows.columns if not c.startswith("__")]
    long = rows.select(*fixed, F.inline("__vals")).withColumnRenamed("value", "DataValue")
    header = columns.where(F.col("__role") == "v").select(*SHEET, "col_idx", *carry)
    return long.join(header, ["col_idx", *SHEET], "inner").select(*SHEET, "col_idx", *[c for c in [*fixed, "DataValue", *carry] if c not in SHEET])


def _prepared(columns: DataFrame, name_col: str, depth: int, keep_pattern: str | None) -> DataFrame:
    named = columns.withColumns({"__name": F.col(name_col), "__depth": F.lit(depth)})
    return _roles(named, "__name", keep_pattern or gather_ignore_pattern())


def gather_with_header(
    cells: DataFrame,
    header_names: Sequence[str] = HEADER_2,
    keep_pattern: str | None = None,
    kept: Sequence[str] = KEPT_NAMES,
    kept_map: bool = True,
) -> DataFrame:
    """R-03 / R-04 (header-2 / header-4 sheets) -> long table.

    Output: the ``kept`` names as columns, the map ``kept``, ``key``,
    ``DataValue``, header columns, ``file_name``, ``sheet_name``, ``site_id``,
    ``row_idx``, ``col_idx``.
    """
    columns = _prepared(header_metadata(cells, header_names), "key", len(header_names), keep_pattern)
    # written: the body's shuffle is given back before its values are shuffled to their header
    rows = cut_lineage(sheet_rows(cells, columns, kept, kept_map), free=True)
    # the key and the site follow from what the long table has: they are not shuffled with the header
    long = long_cells(rows, columns, header_names)
    return long.select(
        *kept, *["kept"] * kept_map, S.header_key(list(header_names)).alias("key"), "DataValue", *header_names, *SHEET,
        S.site_id("sheet_name").alias("site_id"), "row_idx", "col_idx",
    )


def dropped_columns(
    cells: DataFrame, header_names: Sequence[str] = HEADER_2, keep_pattern: str | None = None, kept: Sequence[str] | None = None
) -> DataFrame:
    """Q-H: what gathering leaves out of the long table, per (file, sheet, col_idx): further kept
    columns of one name ('second kept column'), columns without any header ('no header') and, given
    ``kept``, columns that ``keep_pattern`` keeps but ``kept`` does not name ('only in the map'),
    with the number of their body cells."""
    keep_pattern = keep_pattern or gather_ignore_pattern()
    n = len(header_names)
    roles = _roles(header_metadata(cells, header_names), "key", keep_pattern).select(*SHEET, "col_idx", "key", "__role")
    counts = cells.where(F.col("row_idx") > n).groupBy(*SHEET, "col_idx").agg(F.count("value").alias("n_cells"))
    reason = (
        F.when(F.col("__role").isNull(), F.lit("no header"))
        .when(F.col("__role") == "d", F.lit("second kept column"))
    )
    if kept is not None:
        reason = reason.when((F.col("__role") == "k") & S.not_in("key", kept), F.lit("only in the map"))
    joined = counts.join(roles, [*SHEET, "col_idx"], "left").withColumn("reason", reason)
    return joined.where(F.col("reason").isNotNull()).select(*SHEET, "col_idx", "key", "reason", "n_cells")


def meta_rows(
    cells: DataFrame, meta_pattern: str = META_SHEET_PATTERN, fields: Sequence[str] = META_FIELDS, meta_map: bool = True
) -> DataFrame:
    """The rows of META sheets as (file_name, Sheet, OriginalName, Name, other
    ``fields``, meta, n_described): ``meta``, with ``meta_map``, is a map of all columns of the sheet, of columns with one name
    the leftmost.  A name that is described more than once has the first description and their
    number in ``n_described``, so that no value is doubled."""
    meta_cells = cells.where(F.col("sheet_name").rlike(meta_pattern))
    head = meta_cells.where((F.col("row_idx") == 1) & F.col("col_idx").isNotNull()).groupBy(*SHEET, "col_idx").agg(F.min("value").alias("field"))
    if not meta_map:
        head = head.where(F.col("field").isin(list(fields)))
    by_col = F.map_from_entries(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("col_idx", "field"))))
    # a row per META sheet, written: with its size known it moves no cell of the rows
    heads = cut_lineage(head.groupBy(*SHEET).agg(by_col.alias("__fields")))
    body = meta_cells.where(F.col("row_idx") > 1).join(heads, [*SHEET]).withColumn("__field", F.try_element_at("__fields", F.col("col_idx")))
    # a META sheet can have very many rows: they are put together in blocks, not all in one task
    body = body.where(F.col("__field").isNotNull()).withColumn("__block", F.floor(F.col("row_idx") / META_BLOCK))
    body = dealt(body.select(*SHEET, "__block", "row_idx", "__field", "col_idx", "value"), *SHEET, "__block")
    blocks = body.groupBy("row_idx", "__block", *SHEET)
    if meta_map:
        rows = blocks.agg(F.collect_list(F.struct("__field", "col_idx", "value")).alias("__cells"))
        by_name = F.transform(_first_of_each(F.col("__cells"), "__field"), lambda x: F.struct(x["__field"], x["value"]))
        rows = rows.withColumn("meta", F.map_from_entries(by_name))
        rows = rows.select(*SHEET, "row_idx", *[F.try_element_at("meta", F.lit(f)).alias(f) for f in fields], "meta")
    else:
        leftmost = [F.min(F.when(F.col("__field") == f, F.struct("col_idx", "value"))).alias(f) for f in fields]
        rows = blocks.agg(*leftmost).select(*SHEET, "row_idx", *[F.col(f)["value"].alias(f) for f in fields])
    others = [f for f in fields if f not in ("Sheet", "OriginalName")]
    first = F.min_by(F.struct(*others, *["meta"] * meta_map), F.struct("sheet_name", "row_idx")).alias("__first")
    # nearly all names are described once: they are dealt before they are sorted, so that they are sorted once
    named_rows = dealt(rows.where(F.col("Sheet").isNotNull()), "OriginalName", "Sheet", "file_name")
    per_name = named_rows.groupBy("OriginalName", "Sheet", "file_name").agg(first, F.count(F.lit(1)).alias("n_described"))
    return per_name.select("file_name", "Sheet", "OriginalName", "__first.*", "n_described")


def gather_with_meta(
    cells: DataFrame,
    meta_pattern: str = META_SHEET_PATTERN,
    keep_pattern: str | None = None,
    kept: Sequence[str] = KEPT_NAMES,
    fields: Sequence[str] = META_FIELDS,
    kept_map: bool = True,
    meta_map: bool = True,
) -> DataFrame:
    """R-02 / J-07: header-1 sheets described by a META sheet.

    The META sheet (header row: Sheet, OriginalName, Name, ...) maps each
    sheet's original header names to clean names (Q-6: renamed first, then
    gathered and joined on the clean name).  A column that META does not
    describe keeps its original name and is gathered too; further META columns
    come along as ``fields`` beyond the first three and, with ``meta_map``, in the map ``meta``.
    """
    more = [f for f in fields if f not in META_FIELDS]
    data = cells.where(~F.col("sheet_name").rlike(meta_pattern))
    names = header_rows(data, 1).select(*SHEET, "col_idx", F.col("h1").alias("OriginalName"))
    about = meta_rows(cells, meta_pattern, fields, meta_map).withColumnRenamed("Sheet", "sheet_name")
    described = names.join(about, ["OriginalName", "sheet_name", "file_name"], "left")
    described = described.withColumn("VariableName_org", F.coalesce("Name", "OriginalName"))
    columns = _prepared(described, "VariableName_org", 1, keep_pattern)
    rows = cut_lineage(sheet_rows(data, columns, kept, kept_map), free=True)
    long = long_cells(rows, columns, ["VariableName_org", "OriginalName", "Name", *more, *["meta"] * meta_map])
    return long.select(
        *kept, *["kept"] * kept_map, "VariableName_org", "DataValue", "OriginalName", "Name", *more, *["meta"] * meta_map,
        *SHEET, "row_idx", "col_idx",
    )


# P-21 / C-04 / Q-H: workbooks of all layouts in one pass ---------------------------------
ARCHIVE_CARRY = (
    "layout", "VariableName_org", "OriginalName", "Name", "meta", "key", "Method", "UnitName_org", "Limit_TrinkWV", "site_id",
)


def archive_carry(meta_map: bool) -> list[str]:
    return [c for c in ARCHIVE_CARRY if meta_map or c != "meta"]


def archive_columns(
    cells: DataFrame, header4_files: Sequence[str] = (), keep_pattern: str | None = None, meta_map: bool = True
) -> DataFrame:
    """One row per column of every sheet that is to be read, whatever its layout, written once; with ``meta_map`` the map ``meta``.

    The layout is a column: per file 'header1' with a META sheet, else 'header2' with a
    site sheet; 'header4' for ``header4_files``.  It decides how many of a sheet's first
    four rows are header (``__depth``), which of them are name, method, unit and limit, and whether
    META describes them.  ``__repeated`` counts header cells that are there more than once.
    """
    head = cut_lineage(header_rows(cells, len(HEADER_4)), free=True)
    is_meta, is_site = F.col("sheet_name").rlike(META_SHEET_PATTERN), F.col("sheet_name").rlike(S.SITE_ID_PATTERN)
    files = sheet_layouts(head).select("file_name", "layout", "n_meta_sheets")
    if header4_files:
        files = files.withColumn("layout", F.when(F.col("file_name").isin(list(header4_files)), F.lit("header4")).otherwise(F.col("layout")))
    files = cut_lineage(files)  # a row per file: with its size known it moves no header row
    one = F.col("layout") == "header1"
    four = F.col("layout") == "header4"
    depth = F.when(one, 1).when(four, len(HEADER_4)).otherwise(len(HEADER_2))
    x = head.join(files, "file_name").where((F.col("layout") != "none") & F.when(one, ~is_meta).otherwise(is_site)).withColumn("__depth", depth)
    # a column with cells below the header only has no header
    used = [F.when(F.col("__depth") >= i, F.col(f"h{i}")) for i in range(1, len(HEADER_4) + 1)]
    x = x.where(F.coalesce(*used).isNotNull())
    x = x.withColumn("__repeated", F.aggregate(F.slice("repeated", 1, F.col("__depth")), F.lit(0).cast("long"), lambda a, b: a + b))
    about = meta_rows(cells, meta_map=meta_map).withColumnsRenamed({"Sheet": "sheet_name", "OriginalName": "__original"})
    # only header-1 columns meet META: the others have no name to look up and would all be dealt by a null
    described = x.where(one).withColumn("__original", F.col("h1")).join(about, ["__original", "sheet_name", "file_name"], "left")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in about.schema if f.name not in SHEET}
    x = described.unionByName(x.where(~one).withColumns(nothing))
    key = F.when(one, None).when(four, S.header_key(["h1", "h2", "h3", "h4"])).otherwise(S.header_key(["h1", "h2"]))
    variable = F.when(one, F.coalesce("Name", "h1")).otherwise(F.col("h1"))
    named = x.select(
        *SHEET,
        "col_idx",
        "layout",
        "__depth",
        "__repeated",
        "n_meta_sheets",
        "n_described",
        variable.alias("VariableName_org"),
        F.col("__original").alias("OriginalName"),
        "Name",
        *["meta"] * meta_map,
        key.alias("key"),
        F.when(four, F.col("h2")).alias("Method"),
        F.when(four, F.col("h3")).when(~one, F.col("h2")).alias("UnitName_org"),
        F.when(four, F.col("h4")).alias("Limit_TrinkWV"),
        F.when(~one, S.site_id("sheet_name")).alias("site_id"),
    ).withColumn("__name", F.coalesce("key", "VariableName_org"))
    return _roles(named, "__name", keep_pattern or gather_ignore_pattern())


def sheet_problems(cells: DataFrame, columns: DataFrame, rows: DataFrame) -> DataFrame:
    """Q-H: (file_name, sheet_name, problem, n) of the sheets that cannot be read without a
    choice, from the columns and rows of ``archive_columns`` and ``sheet_rows``: cells that are there more than
    once, names that META describes more than once, and what is wrong with a META sheet
    itself (repeated columns or cells, more than one), which touches all sheets of its file."""
    def told(df: DataFrame, problem: str, n: Column) -> DataFrame:
        counted = df.groupBy(*SHEET).agg(n.cast("long").alias("n"))
        return counted.where("n > 0").select(*SHEET, F.lit(problem).alias("problem"), "n")

    meta_cells = cells.where(F.col("sheet_name").rlike(META_SHEET_PATTERN))
    heads = meta_cells.where(F.col("row_idx") == 1).select(*SHEET, "col_idx", "value").distinct()
    again = heads.groupBy(*SHEET, "value").agg((F.count_distinct("col_idx") - 1).alias("__more"))
    places = dealt(meta_cells.select(*SHEET, "row_idx", "col_idx"), *SHEET, "row_idx", "col_idx").groupBy(*SHEET, "row_idx", "col_idx").agg((F.count(F.lit(1)) - 1).alias("__more"))
    meta = [told(again, "META column twice", F.sum("__more")), told(places, "repeated cell", F.sum("__more"))]
    # of a file's META sheets to all its sheets
    sheets = columns.select(*SHEET, "layout").distinct().where("layout = 'header1'")
    spread = [sheets.join(p.withColumnRenamed("sheet_name", "__meta"), "file_name").select(*SHEET, F.concat(F.lit("META: "), "problem").alias("problem"), "n") for p in meta]
    more = told(columns.where("layout = 'header1'"), "META: more than one sheet", F.max("n_meta_sheets") - 1)
    own = columns.select(*SHEET, F.col("__repeated").alias("n")).unionByName(rows.select(*SHEET, F.col("__repeated").cast("long").alias("n")))
    return (
        told(own, "repeated cell", F.sum("n"))
        .unionByName(told(columns, "name described twice", F.count(F.when(F.col("n_described") > 1, 1))))
        .unionByName(reduce(lambda a, b: a.unionByName(b), [more, *spread]))
    )


# S-08 / S-10 / S-11 / H-20 ---------------------------------------------------------
@F.udf(T.ArrayType(T.StringType()))
def _clean_headers(raw):
    """H-20 for the header of one sheet (as long as the sheet is wide)."""
    return clean_names(raw)


def clean_header(cells: DataFrame, clean: bool = True) -> DataFrame:
    """(file, sheet, col_idx, __name) of one header row per sheet: names cleaned (snake_case) and
    unique within each sheet; of repeated cells the smallest value."""
    one = cells.groupBy(*SHEET, "col_idx").agg(F.min("value").alias("value"))
    head = one.groupBy(*SHEET).agg(F.array_sort(F.collect_list(F.struct("col_idx", "value"))).alias("h"))
    raw = F.transform("h", lambda x: x["value"])
    named = head.select(*SHEET, "h", (_clean_headers(raw) if clean else raw).alias("n"))
    names = named.select(*SHEET, F.explode(F.arrays_zip(F.transform("h", lambda x: x["col_idx"]).alias("c"), F.col("n"))).alias("x"))
    return names.select(*SHEET, F.col("x.c").alias("col_idx"), F.col("x.n").alias("__name"))


def table_rows(cells: DataFrame, header_row: int | DataFrame = 1, clean: bool = True) -> DataFrame:
    """(file_name, sheet_name, row_idx, values): one row per sheet row below the
    header, ``values`` mapping that sheet's own column names to the cells.
    Names are cleaned (snake_case) and unique within each sheet; without ``clean`` the leftmost of equal
    names counts, and of repeated cells the smallest value.  ``header_row`` is a number, or a table
    (file_name, sheet_name, header_row, first_row, last_row) with those of each sheet; only its
    sheets are read, and a null last row is the end."""
    if isinstance(header_row, int):
        head, body = cells.where(F.col("row_idx") == header_row), cells.where(F.col("row_idx") > header_row)
    else:
        placed = cells.join(header_row, [*SHEET])
        head = placed.where(F.col("row_idx") == F.col("header_row"))
        last = F.coalesce(F.col("row_idx") <= F.col("last_row"), F.lit(True))
        body = placed.where((F.col("row_idx") >= F.col("first_row")) & last)
    names = clean_header(head.select(*CELL_COLUMNS), clean)
    per_row = (
        body.join(names, [*SHEET, "col_idx"])
        .groupBy(*SHEET, "row_idx")
        .agg(F.collect_list(F.struct("__name", "col_idx", "value")).alias("__cells"))
    )
    firsts = F.transform(_first_of_each(F.col("__cells"), "__name"), lambda x: F.struct(x["__name"], x["value"]))
    return per_row.select(*SHEET, "row_idx", F.map_from_entries(firsts).alias("values"))


def cells_to_table(cells: DataFrame, names: Sequence[str], header_row: int = 1, clean: bool = True, rest: bool = False) -> DataFrame:
    """The sheets' rows with the columns ``names`` (NULL where a sheet has none of
    that name); with ``rest`` also the map ``values`` of all columns.  Any number of
    sheets with different headers."""
    rows = table_rows(cells, header_row, clean)
    out = [F.try_element_at("values", F.lit(n)).alias(n) for n in names]
    return rows.select(*SHEET, "row_idx", *out, *(["values"] if rest else []))


# S-09 / R-09 -------------------------------------------------------------------------
LAB_HEADER_ROW = 5
LAB_BLOCKS = ((1, 53), (210, 211))
LAB_KEY_PARTS = ("par_name", "method", "par_name_phreeqc", "unit_org")


def lab_sheet_rows(
    cells: DataFrame,
    key_cols: Sequence[str],
    header_row: int = LAB_HEADER_ROW,
    blocks: Sequence[tuple[int, int | None]] = LAB_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """The lab workbook as delivered: (rows, columns) for ``long_cells``.

    The header is in ``header_row``; only the columns of ``blocks`` are read, by position.
    Names with '@' are value columns, split into ``LAB_KEY_PARTS``; the others are key columns with
    clean names, of which ``key_cols`` become columns of the rows.  There is no wide table.
    """
    block = cell_range(cells, (header_row, None), blocks)
    head = block.where(F.col("row_idx") == header_row).groupBy(*SHEET, "col_idx").agg(F.min("value").alias("value"))
    is_value = F.col("value").contains("@")
    keys = clean_header(head.where(~is_value))
    parts = S.split_key("value", LAB_KEY_PARTS)
    columns = head.join(keys, [*SHEET, "col_idx"], "left").select(
        *SHEET,
        "col_idx",
        F.coalesce("__name", "value").alias("__name"),
        F.when(is_value, "v").otherwise("k").alias("__role"),
        F.lit(header_row).alias("__depth"),
        *[part.alias(name) for name, part in parts.items()],
    )
    columns = cut_lineage(columns)
    return sheet_rows(block, columns, key_cols, kept_map=False), columns


# P-22 / Q-D / Q-E / Q-F -------------------------------------------------------------
def sheet_layouts(
    cells_or_sheets: DataFrame,
    meta_pattern: str = META_SHEET_PATTERN,
    site_pattern: str = S.SITE_ID_PATTERN,
) -> DataFrame:
    """Per file: number of META sheets, site sheets, other sheets and the
    chosen layout (header1 if a META sheet, header2 if a site sheet, else
    none)."""
    sheets = cells_or_sheets.select(*SHEET).distinct()
    per_file = sheets.groupBy("file_name").agg(
        F.count(F.when(F.col("sheet_name").rlike(meta_pattern), 1)).alias("n_meta_sheets"),
        F.count(F.when(F.col("sheet_name").rlike(site_pattern), 1)).alias("n_site_sheets"),
        F.count(
            F.when(~F.col("sheet_name").rlike(meta_pattern) & ~F.col("sheet_name").rlike(site_pattern), 1)
        ).alias("n_other_sheets"),
    )
    return per_file.withColumn(
        "layout",
        F.when(F.col("n_meta_sheets") > 0, F.lit("header1"))
        .when(F.col("n_site_sheets") > 0, F.lit("header2"))
        .otherwise(F.lit("none")),
    )


# A-10 --------------------------------------------------------------------------------
def column_types(body: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Per (file, sheet, col_idx): 'empty' without any value, 'numeric' if every
    value is a number, 'date' if every value is a date, else 'text'."""
    v = F.col("value")
    flags = body.groupBy(*SHEET, "col_idx").agg(
        F.count(v).alias("__n"),
        F.count(S.to_number(v)).alias("__num"),
        F.count(S.parse_date(v, date_format)).alias("__date"),
    )
    return flags.select(
        *SHEET,
        "col_idx",
        F.when(F.col("__n") == 0, F.lit("empty"))
        .when(F.col("__num") == F.col("__n"), F.lit("numeric"))
        .when(F.col("__date") == F.col("__n"), F.lit("date"))
        .otherwise(F.lit("text"))
        .alias("type"),
    )


def type_census(body: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A-10: number of columns per type."""
    return column_types(body, date_format).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


# H-24 ---------------------------------------------------------------------------------
def header_programme(cells: DataFrame, rows: int, col_idx: int = 1, sep: str = "@") -> DataFrame:
    """Header cells of rows 1..rows in one column joined with '@' per sheet."""
    head = cells.where((F.col("row_idx") <= rows) & (F.col("col_idx") == col_idx))
    return head.groupBy(*SHEET).agg(S.ordered_join("row_idx", "value", sep).alias("programme"))
