"""Composite flows of the reference as DataFrame functions.

Each function takes DataFrames shaped like the reference's inputs (column
names of FIXTURES.md) and returns a DataFrame; loops over parameters or
wells in the source become grouping keys here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.names import rename_regex
from ..operators import cells as CL
from ..operators import filters as P
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import stats as A
from ..session import cut_lineage
from ..sources import readers as SR
from ..sources import sinks as K

SENSOR_VALUE_COLUMNS = ("Leitfaehigkeit", "Temperatur")
# --- fixed values: limits, names and wells of the monitoring programme ----------
CONDUCTIVITY_LIMIT = 20000.0  # µS/cm; higher readings are sensor faults
DAILY_VOLUME_LIMIT = 2000.0  # m³/day; plausible well abstraction
LAB_NAME = "BWB"
WELLS_WITH_SENSORS = (9, 10, 13)
SURVEY_PROGRAMME_ROWS = (1, 2)  # header rows of a survey sheet that name the programme
# ---------------------------------------------------------------------------------


# C-01 / T-02 -------------------------------------------------------------------
def sensor_long_from_raw(raw: DataFrame, installed_since=None) -> DataFrame:
    """Logger rows (Geraet, DatumUhrzeit local UTC+1, 2 values, file) ->
    long series in UTC, measurements before installation removed."""
    cols = [c for c in ("file",) if c in raw.columns]
    renamed = raw.select(
        *cols,
        F.col("Geraet").alias("sensor_id"),
        S.local_plus_one_to_utc("DatumUhrzeit").alias("datum_uhrzeit"),
        *SENSOR_VALUE_COLUMNS,
    )
    long = R.to_long(renamed, [*cols, "sensor_id", "datum_uhrzeit"], SENSOR_VALUE_COLUMNS, "parameter", "messwert")
    long = long.withColumn("messwert", S.nan_to_null("messwert"))
    return P.remove_before(long, "datum_uhrzeit", installed_since)


def sensor_stats_flow(long: DataFrame) -> DataFrame:
    """C-01 tail: implausible conductivity nulled, then A-01 statistics."""
    clean = P.null_implausible(long, "parameter", "messwert", "Leitfaehigkeit", CONDUCTIVITY_LIMIT)
    return A.measurement_stats(clean)


# C-02 ---------------------------------------------------------------------------------
def well_operation_daily(operation: DataFrame) -> DataFrame:
    """C-02 (data behind the combined plot): plausible daily volumes per well
    and for the field, with 7- and 10-row rolling means.

    ``operation``: name_der_messstelle_gms, bwb_datum, menge_summe_m3.
    """
    parts = S.well_code_parts("name_der_messstelle_gms")
    op = (
        operation.where(F.col("menge_summe_m3") < DAILY_VOLUME_LIMIT)
        .withColumns(parts)
        .withColumn("bwb_datum", F.to_date("bwb_datum"))
    )
    daily = A.daily_totals(op, "bwb_datum", "brunnen_nummer", "menge_summe_m3", levels="both")
    return A.rolling_means(daily, ["is_field", "brunnen_nummer"], "bwb_datum", "volume")


def chain_series(long: DataFrame, metadata: DataFrame, well: int | None = None, since=None) -> DataFrame:
    """C-02 / C-03: series joined with sensor metadata (depth, well), labelled
    and optionally restricted to one well and to the time from ``since`` (P-07)."""
    long = P.remove_before(long, "datum_uhrzeit", since)
    meta = metadata.select("sensor_id", "brunnen_nummer", "einbau_sensor_muGOK")
    j = J.keyed_join(long, meta, ["sensor_id"])
    if well is not None:
        j = j.where(F.col("brunnen_nummer") == well)
    return j.withColumns(
        {
            "label": S.depth_label("einbau_sensor_muGOK", "sensor_id"),
            "unit": S.parameter_unit("parameter"),
        }
    )


def titled_series(long: DataFrame, metadata: DataFrame, since=None) -> DataFrame:
    """C-03: the series of every well and parameter with label, unit, title and file name of its plot."""
    x = chain_series(long, metadata, since=since)
    return x.withColumns({"title": S.plot_title("parameter", "brunnen_nummer"), "plot_name": S.plot_name("parameter", "brunnen_nummer")})


def well_with_operation(
    long: DataFrame,
    metadata: DataFrame,
    files: DataFrame,
    operation: DataFrame,
    well: int,
    parameter: str,
    date_min,
    date_max,
    wells: Sequence[int] = WELLS_WITH_SENSORS,
) -> tuple[DataFrame, DataFrame]:
    """C-02: (series of one well and parameter, daily volumes of the well and of the field) in a window of days.

    ``long``: file, sensor_id, datum_uhrzeit, parameter, messwert; implausible conductivities are nulled,
    the depth comes from ``metadata`` and the well from ``files`` (sftp_path, galerie, brunnen_nummer).  The
    rolling means are of all days; the window (P-18, both ends in it) cuts what is returned.
    """
    if well not in wells:
        raise ValueError(f"the well must be one of {', '.join(map(str, wells))}")
    clean = P.null_implausible(long, "parameter", "messwert", "Leitfaehigkeit", CONDUCTIVITY_LIMIT)
    x = J.keyed_join(clean, metadata, ["sensor_id"], columns=["einbau_sensor_muGOK"])
    x = J.keyed_join(x, files, ["file"], ["sftp_path"], columns=["galerie", "brunnen_nummer"])
    x = x.where((F.col("parameter") == parameter) & (F.col("brunnen_nummer") == well))
    # the same window with the days as moments: open above, so that the last day is whole
    day = F.col("datum_uhrzeit").cast("date")
    series = x.where(day.between(F.lit(date_min).cast("date"), F.lit(date_max).cast("date")))
    volumes = P.within(well_operation_daily(operation), "bwb_datum", date_min, date_max)
    return series, volumes.where(F.col("is_field") | (F.col("brunnen_nummer") == well))


# C-04 ----------------------------------------------------------------------------------
def read_archive(
    cells: DataFrame,
    header4_files: Sequence[str] = (),
    keep_pattern: str | None = None,
    kept: Sequence[str] = ("Datum", "Probe_Nr"),
    kept_map: bool = True,
    meta_map: bool = True,
) -> DataFrame:
    """C-04: lab archive import by layout, for any number of workbooks.

    Per file: a META sheet -> header-1; else a sheet starting with a
    site code -> header-2; files on the explicit ``header4_files``
    list have four header rows (Q-13: never chosen automatically); files
    of no layout are left out (reported by ``cells.sheet_layouts``).  Layout and header
    depth are columns of one header table, so the bodies of all workbooks are read, shuffled
    and joined once (``rbindlist(fill=TRUE)``: columns that a layout lacks are NULL).
    """
    columns = CL.archive_columns(cells, header4_files, keep_pattern, meta_map)
    rows = CL.sheet_rows(cells, columns, kept, kept_map)
    return CL.long_cells(rows, columns, CL.archive_carry(meta_map))


def import_archive(
    cells: DataFrame,
    header4_files: Sequence[str] = (),
    keep_pattern: str | None = None,
    kept: Sequence[str] = ("Datum", "Probe_Nr"),
    kept_map: bool = True,
    meta_map: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """C-04 with Q-H: (long table of the good sheets, problems of the bad ones).

    A sheet with a problem is left out as a whole and named with it; all others are
    read as by ``read_archive``.  The sheet rows are written once, and rows and report read that table.
    """
    columns = CL.archive_columns(cells, header4_files, keep_pattern, meta_map)
    rows = cut_lineage(CL.sheet_rows(cells, columns, kept, kept_map), free=True)
    problems = cut_lineage(CL.sheet_problems(cells, columns, rows))
    bad = problems.select(*CL.SHEET).distinct()
    good = rows.join(bad, [*CL.SHEET], "left_anti")
    return CL.long_cells(good, columns, CL.archive_carry(meta_map)), problems


def parameters_or_template(
    df: DataFrame, lookup_path: str, parameters: DataFrame, template_path: str
) -> tuple[DataFrame, str | None]:
    """J-03 / J-04 / K-06 as one flow: (mapped rows, path of the template or None).

    Names that the lookup does not map, or all if it is missing, are written as the template to fill in.
    """
    lookup = SR.read_lookup(df.sparkSession, lookup_path)
    mapped, template = J.map_or_template(df, lookup, parameters)
    return mapped, None if template.isEmpty() else K.write_template(template, template_path)


# C-05 ----------------------------------------------------------------------------------
def archive_timeseries(
    long: DataFrame, lookup_para: DataFrame, parameters: DataFrame, sites: DataFrame
) -> DataFrame:
    """C-05 cleaning: values with a date, mapped parameters (inner), site
    metadata (left), numeric value.

    ``long``: VariableName_org, DataValue, Datum/Probenahme, site_id.
    """
    x = long.where(F.col("DataValue").isNotNull())
    date_cols = [c for c in ("Datum", "Probenahme") if c in x.columns]
    x = x.withColumn("Date", P.first_present(*[S.parse_date(c, "yyyy-MM-dd") for c in date_cols]))
    x = x.where(F.col("Date").isNotNull())
    x = J.add_parameter_metadata(x, lookup_para, parameters)
    x = J.add_site_metadata(x, sites)
    return x.withColumn("value", S.to_number("DataValue"))


def lab_archive_yearly(
    timeseries: DataFrame, abstraction: DataFrame, water_type: str | None = None
) -> DataFrame:
    """C-05: yearly mean per (parameter, waterworks, year) of one water type,
    joined with the abstraction of that year (``werk, year, ...``).  The
    reference loops over parameters; here the parameter is a grouping key."""
    x = timeseries
    if water_type is not None:
        x = x.where(F.col("prufgegenstand") == water_type)
    means = A.yearly_mean(x, ["para_kurzname", "werk"], "Date", "value", "mean_value")
    return J.keyed_join(means, abstraction, ["werk", "year"])


# C-06 -----------------------------------------------------------------------------------
def availability_report(timeseries: DataFrame, werk: str, water_type: str = "Rohwasser") -> DataFrame:
    """C-06: sampling statistics per parameter and gallery of one waterworks."""
    x = timeseries.where((F.col("prufgegenstand") == water_type) & (F.col("werk") == werk))
    return A.sampling_stats(x, ["para_id", "para_kuerzel", "para_kurzname", "werk", "galerie"], "Date")


# C-07 ------------------------------------------------------------------------------------
def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column behind a generator: Catalyst neither pushes later filters through it nor copies
    its expression to each place that uses it, so the expression runs once a row."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def clean_lab_values(long: DataFrame, labor: str = LAB_NAME, below_factor: float = 0.5) -> DataFrame:
    """C-07 core: raw lab text -> numbers, limits, mg/l; unusable rows dropped.

    ``long`` carries par_name, unit_org and par_val_org (plus keys).
    """
    raw = F.col("par_val_org")
    # the patterns look only at texts that can have them
    analysed = F.when(raw.contains("n."), S.blank_if_not_analysed(raw)).otherwise(raw)
    x = _computed_once(long, "__par_val", F.when(raw.contains(","), S.limit_comma_to_point(analysed)).otherwise(analysed))
    x = _computed_once(x, "__is_number", F.coalesce(F.col("__par_val").rlike(S.LAB_VALUE_PATTERN), F.lit(False)))
    # P-15: a number exists exactly when the unit is known and the cleaned text matches the lab-value
    # pattern (the factors are never NULL, the matched number always casts)
    is_text = F.coalesce(F.col("par_name").isin(list(S.TEXT_PARAMETERS)), F.lit(False))
    x = x.where((is_text & raw.isNotNull()) | (~is_text & F.col("unit_org").isNotNull() & F.col("__is_number")))
    x = S.with_matched_value(x, "__par_val", "__is_number", below_factor).drop("__par_val", "__is_number")
    conv = S.micro_to_milli("unit_org", "numeric_value")
    x = x.withColumns({"unit": conv["unit"], "numeric_value": conv["numeric_value"]})
    x = x.withColumn("character_value", S.text_value("par_name", "par_val_org"))
    return x.withColumn("labor", F.lit(labor))


def lab_table(wide: DataFrame, sample_col: str = "probe_nr", labor: str = LAB_NAME) -> DataFrame:
    """C-07: lab matrix (key columns without '@', values 'name@method@phreeqc@unit')
    -> checked, long, cleaned.  The matrix is materialised once: the duplicate
    check (an action) and the rest of the flow read the same table."""
    wide = cut_lineage(wide)
    Q.check(Q.duplicated_samples(wide, [sample_col]), "duplicated samples")
    return clean_lab_values(R.lab_matrix_long(wide), labor)


def lab_table_from_cells(
    cells: DataFrame,
    sheet: str = "Analysen",
    key_cols: Sequence[str] = ("probe_nr", "messstelle", "probenahme_datum"),
    sample_col: str = "probe_nr",
    labor: str = LAB_NAME,
    required: Sequence[str] = ("Stammdaten",),
) -> DataFrame:
    """C-07 from the workbook as delivered (S-09, Q-D, R-09): header in row 5, two blocks of columns
    read by position straight into long form, samples checked, values cleaned."""
    Q.check(Q.missing_sheets(cells.select(*CL.SHEET).distinct(), [*required, sheet]), "missing sheets")
    rows, columns = CL.lab_sheet_rows(cells.where(F.col("sheet_name") == sheet), key_cols)
    rows = cut_lineage(rows)
    Q.check(Q.duplicated_samples(rows, [sample_col]), "duplicated samples")
    long = CL.long_cells(rows, columns, CL.LAB_KEY_PARTS).withColumnRenamed("DataValue", "par_val_org")
    return clean_lab_values(long.select(*key_cols, *CL.LAB_KEY_PARTS, "par_val_org"), labor)


def master_sites(cells: DataFrame, names: Sequence[str], sheet: str = "Stammdaten") -> DataFrame:
    """S-11: the master data sheet with clean names: ``messstelle`` (its column ``name``) and ``names``."""
    table = CL.cells_to_table(cells.where(F.col("sheet_name") == sheet), ["name", *names])
    return P.rename_columns(table, {"name": "messstelle"}).drop(*CL.SHEET, "row_idx")


def parameter_list(cells: DataFrame, names: Sequence[str], sheet: str = "nur Parameterliste") -> DataFrame:
    """S-10: the parameter sheet with clean names; ``para_id`` is a whole number."""
    table = CL.cells_to_table(cells.where(F.col("sheet_name") == sheet), names).drop(*CL.SHEET, "row_idx")
    return table.withColumn("para_id", S.to_int("para_id"))


# C-08 ------------------------------------------------------------------------------------
def isotopes_long(wide: DataFrame, sampler: str, laboratory: str, date_format: str = "dd.MM.yyyy") -> DataFrame:
    """C-08: isotope sheet (clean names) -> long with parsed values; ``sampler`` and
    ``laboratory`` say who took and who analysed the samples."""
    x = wide.withColumn("sampling_date", S.parse_date("sampling_date", date_format)).drop("fuk_masl")
    x = P.rename_columns(x, {"lab_id": "probe_nr", "sampling_date": "probenahme_datum", "site_id": "messstelle"})
    x = rename_regex(x, "^x", "isotope_")
    Q.check(Q.duplicated_samples(x, ["probe_nr"]), "duplicated samples")
    ids = [c for c in x.columns if "isotope" not in c and "cond" not in c]
    long = R.wide_to_long_matching(x, ids, "isotope|cond", "par_name", "par_val_org")
    long = S.with_lab_value(long, "par_val_org")
    return long.withColumns({"probenahme": F.lit(sampler), "labor": F.lit(laboratory)})


# C-09 --------------------------------------------------------------------------------------
def hydrochemistry(lab: DataFrame, isotopes: DataFrame, master: DataFrame) -> DataFrame:
    """C-09: lab values and isotopes as one table (U-03: sample ids and raw values as text) with
    the master data of their sites (J-09)."""
    both = R.bind_as_text([lab, isotopes], ["probe_nr", "par_val_org"])
    return J.keyed_join(both, master, ["messstelle"])


def solver_data(lab: DataFrame) -> DataFrame:
    """``get_phreeqc_data``: rows with a solver name; units must be mg/l.
    The rows are written once, and the unit rule is counted while they are."""
    named = P.keep_text(lab, "par_name_phreeqc").select("probe_nr", "par_name_phreeqc", "unit", "numeric_value")
    dat = Q.written_checked(named, {"units other than mg/l": Q.is_unit_violation()})
    return dat.select("probe_nr", "par_name_phreeqc", "numeric_value")


def solver_wide(data: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """R-11: (solver input with one row per sample and a column per name, names left out with their
    rows); a name that a sample has twice is an error."""
    Q.check(Q.duplicated_samples(data, ["probe_nr", "par_name_phreeqc"]), "solver names that a sample has twice")
    wide = R.to_wide(data, ["probe_nr"], "par_name_phreeqc", "numeric_value", names)
    return wide.withColumnRenamed("probe_nr", "solution"), R.names_outside(data, "par_name_phreeqc", names)


def solver_long(data: DataFrame) -> DataFrame:
    """R-12: one row per sample and solver name with the unit of the solver, missing
    values dropped.  Every name of the data stays; a name that a sample has twice is an error."""
    Q.check(Q.duplicated_samples(data, ["probe_nr", "par_name_phreeqc"]), "solver names that a sample has twice")
    return data.where(F.col("numeric_value").isNotNull()).select(
        F.col("probe_nr").alias("solution"), F.lit("ppm").alias("units"), "par_name_phreeqc", "numeric_value"
    )


# C-10 ----------------------------------------------------------------------------------------
def survey_sheet(sheet: DataFrame) -> DataFrame:
    """One survey sheet: ``messstellen`` renamed, empty rows dropped, repeated header
    rows dropped where the sheet has a date, rows without a site dropped where it has sites."""
    if "messstellen" in sheet.columns and "messstelle" not in sheet.columns:
        sheet = sheet.withColumnRenamed("messstellen", "messstelle")
    sheet = P.drop_empty_rows(sheet, [c for c in sheet.columns if c != "ods_names_clean"])
    if "datum" in sheet.columns:
        sheet = P.drop_header_repeats(sheet, "datum", "Datum")
    if "messstelle" in sheet.columns:
        sheet = P.drop_missing(sheet, ["messstelle"])
    return sheet


def survey_table(sheets: dict[str, DataFrame], plan: DataFrame) -> DataFrame:
    """C-10: survey sheets with differing columns, each cleaned by its own columns
    -> one table -> synonyms remapped -> import plan right-joined -> dates parsed."""
    x = R.union_fill({name: survey_sheet(sheet) for name, sheet in sheets.items()}, "sheet")
    x = P.remap_synonyms(x)
    x = J.keyed_join(plan, x, ["ods_names_clean"], how="right")
    return x.withColumn("datum", S.survey_date("datum"))


def survey_from_cells(cells: DataFrame, plan: DataFrame, names: Sequence[str]) -> DataFrame:
    """C-10 from cells: every file's first sheet by its row of the import plan (S-12) -> one table.

    ``plan``: ods_files, ods_names_clean, skip_rows and, where a file differs, header_row, first_row and
    last_row.  The header is the row after the skipped ones, cleaned per sheet; one or two skipped rows name
    the measuring programme (their first cells, H-24).  Header repeats go where a sheet has dates, rows
    without a site where it has sites; ``names`` become columns, the map ``values`` has all.
    """
    given = {c: F.col(c) if c in plan.columns else F.lit(None).cast("long") for c in ("header_row", "first_row", "last_row")}
    header = F.coalesce(given["header_row"], F.col("skip_rows") + 1)
    places = plan.select(
        F.col("ods_files").alias("file_name"),
        "ods_names_clean",
        "skip_rows",
        header.cast("long").alias("header_row"),
        F.coalesce(given["first_row"], header + 1).cast("long").alias("first_row"),
        given["last_row"].cast("long").alias("last_row"),
    )
    sheets = cells.groupBy("file_name").agg(F.min("sheet_name").alias("sheet_name"))
    places = cut_lineage(places.join(sheets, "file_name"))
    renamed = cells.withColumn("value", F.regexp_replace("value", r"^Kuppb\.$", "Kupp. St."))
    placed = renamed.join(places.select(*CL.SHEET, "header_row"), [*CL.SHEET]).where(F.col("row_idx") == F.col("header_row"))
    has = CL.clean_header(placed.select(*CL.CELL_COLUMNS)).groupBy(*CL.SHEET).agg(
        F.max(F.col("__name") == "datum").alias("__dated"), F.max(F.col("__name").isin("messstelle", "messstellen")).alias("__sited")
    )
    above = cells.join(places.select(*CL.SHEET, "skip_rows"), [*CL.SHEET]).where(
        F.col("skip_rows").isin(list(SURVEY_PROGRAMME_ROWS)) & (F.col("row_idx") <= F.col("skip_rows")) & (F.col("col_idx") == 1)
    )
    programme = above.groupBy(*CL.SHEET).agg(S.ordered_join("row_idx", "value", "@").alias("messprogramm"))

    rows = CL.table_rows(renamed, places.select(*CL.SHEET, "header_row", "first_row", "last_row"))
    value = {n: F.try_element_at("values", F.lit(n)) for n in {*names, "messstelle", "messstellen", "datum"}}
    value["messstelle"] = F.coalesce(value["messstelle"], value.pop("messstellen"))
    x = rows.select(*CL.SHEET, "row_idx", "values", *[v.alias(n) for n, v in value.items()])
    x = x.where(F.exists(F.map_values("values"), lambda v: v.isNotNull()))
    x = x.join(has, [*CL.SHEET])
    x = x.where(~F.col("__dated") | (F.col("datum") != "Datum")).where(~F.col("__sited") | F.col("messstelle").isNotNull())
    x = x.join(programme, [*CL.SHEET], "left").join(places.select(*CL.SHEET, "ods_names_clean", "skip_rows"), [*CL.SHEET])
    return P.remap_synonyms(x.drop("__dated", "__sited")).withColumn("datum", S.survey_date("datum"))


def survey_sites(df: DataFrame, col: str = "messstelle") -> DataFrame:
    """C-10 tail (H-21 ... H-23): split the survey site text into object,
    borehole number / year, pipe, gallery and well id."""
    objekt, bhrgs, rohr = S.split_fixed(col, r"\s{1,9}", 3)
    bh = F.split(bhrgs, "/")
    ms = S.substitute_all(objekt, S.GALLERY_SUBSTITUTIONS)
    gal_well = F.split(ms, ",", 2)
    return df.withColumns(
        {
            "objekt": objekt,
            "bhrgs_nr_jahr": bhrgs,
            "bhrgs_nr": F.get(bh, 0),
            "jahr": F.get(bh, 1),
            "rohr": F.regexp_replace(rohr, "^0", "O"),
            "brunnen_galerie": F.coalesce(F.get(gal_well, 0), F.lit("")),
            "brunnen_id": F.regexp_replace(F.coalesce(F.get(gal_well, 1), F.lit("")), "^Br", ""),
        }
    )


# C-11 ----------------------------------------------------------------------------------------
def gallery_abstraction(wide: DataFrame, prefix: str = "FRI ") -> DataFrame:
    """C-11: gallery volumes long, missing removed, in million m³."""
    long = R.gallery_long(wide, prefix=prefix)
    long = long.where(F.col("foerdermenge_m3").isNotNull())
    return long.withColumn("foerdermenge_mio_m3", S.to_million("foerdermenge_m3"))


def waterworks_abstraction(wide: DataFrame, werk: str, year_col: str = "Jahr") -> DataFrame:
    """C-11: yearly volumes of one waterworks (R-07, P-12), missing ones removed, in million m³."""
    long = R.abstraction_long(wide, year_col).where(F.col("werk") == werk)
    return long.withColumn("Foerdermenge_Mio_m3", S.to_million("Foerdermenge_m3"))
