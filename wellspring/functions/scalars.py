"""Column -> Column functions.

All are built-in Spark expressions, so they run inside whole-stage codegen;
none is a Python UDF.  R-specific NULL rules (§1.5) are applied here once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values that must equal the source behaviour ---------------------
# Logger file name (prefix, 7-digit sensor id with its end digit, local time).
LOGGER_FILE_PATTERN = r"^(LF_)?(\d{6}(\d))[-_](\d{4}-\d{2}-\d{2}-\d{4})$"
LOGGER_TIME_FORMAT = "yyyy-MM-dd-HHmm"
# Site code: up to four leading digits of a sheet name.
SITE_ID_PATTERN = r"^[0-9]{1,4}"
# Lab "not analysed" / "not determined" markers with 0 to 10 blanks.
NOT_ANALYSED_PATTERN = r"n\.\s{0,10}(a|b)\."
# Fixed UTC+1 without daylight saving, the loggers' clock.
GMT_PLUS_ONE = "Etc/GMT-1"
# Strict UTC text.
UTC_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
# Lab parameters whose text value is kept.
TEXT_PARAMETERS = ("Farbe", "Trübung", "Geruch", "Bodensatz")
# A plain decimal number (no 'd'/'f' suffix, no NaN/Infinity words).
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Lab value: optional limit sign then a number.
LAB_VALUE_PATTERN = r"^\s*([<>]?)\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
# Gallery spellings of the 1991 survey, applied in this order, all matches.
GALLERY_SUBSTITUTIONS = (
    ("GF|F-Gal.", "Gal_F"),
    ("GE|E-Gal", "Gal_E"),
    ("GI|I-Gal.", "Gal_I"),
    ("GG|G-Gal.|G-Gal", "Gal_G"),
    ("GK|K-Gal.", "Gal_K"),
    ("^Go$", "Gal_O"),
    ("GH|H-Gal.", "Gal_H"),
    ("GO", "Gal_O"),
    ("GL|L-Gal.", "Gal_L"),
    ("GM|M-Gal.", "Gal_M"),
    (",,", ","),
)
# Units by sensor parameter.
PARAMETER_UNITS = (("Leitfaehigkeit", "µS/cm"), ("Temperatur", "°C"))
# ---------------------------------------------------------------------------


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# H-01 ----------------------------------------------------------------------
def path_folder(path: ColumnOrName) -> Column:
    """``dirname``: text before the last '/', '.' when there is none."""
    p = _c(path)
    return F.when(F.instr(p, "/") > 0, F.regexp_extract(p, r"^(.*)/[^/]*$", 1)).when(
        p.isNotNull(), F.lit(".")
    )


def path_file(path: ColumnOrName) -> Column:
    """``basename``: text after the last '/'."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


# H-02 ----------------------------------------------------------------------
def drop_extension(name: ColumnOrName) -> Column:
    return F.regexp_replace(_c(name), r"\.[^./]*$", "")


# H-03 ----------------------------------------------------------------------
def gallery_of_folder(folder: ColumnOrName) -> Column:
    return F.substring(_c(folder), 1, 1)


def well_of_folder(folder: ColumnOrName) -> Column:
    return to_int(F.substr(_c(folder), F.lit(2)))


# H-04 ----------------------------------------------------------------------
def logger_parts(stem: ColumnOrName) -> dict[str, Column]:
    """Prefix, sensor id, sensor end digit and instant of a logger file stem.

    Non-matching stems give NULL everywhere (quality rule Q-B lists them).
    """
    s = _c(stem)
    ok = s.rlike(LOGGER_FILE_PATTERN)

    def grp(i: int) -> Column:
        return F.when(ok, F.regexp_extract(s, LOGGER_FILE_PATTERN, i))

    return {
        "prefix": grp(1),
        "sensor_id": to_int(grp(2)),
        "sensor_endnummer": to_int(grp(3)),
        "datum_uhrzeit": local_plus_one_to_utc(grp(4), LOGGER_TIME_FORMAT),
    }


# H-05 ----------------------------------------------------------------------
def site_id(text: ColumnOrName, pattern: str = SITE_ID_PATTERN) -> Column:
    """Leading 1-4 digit site code as DOUBLE, NULL when absent."""
    return F.regexp_substr(_c(text), F.lit(pattern)).try_cast("double")


# H-06 / H-07 -----------------------------------------------------------------
def well_code_parts(code: ColumnOrName) -> dict[str, Column]:
    """Fixed-width well code, '-' removed from each field."""
    s = _c(code)

    def part(pos: int, length: int) -> Column:
        return F.replace(F.substring(s, pos, length), F.lit("-"), F.lit(""))

    return {
        "wasserwerk": part(1, 3),
        "galerie": F.upper(part(4, 1)),
        "brunnen_nummer": to_int(part(5, 5)),
        "unbekannter_buchstabe": part(10, 1),
        "brunnen_baujahr": to_int(part(12, 4)),
        "brunnen_bauart": part(16, 1),
    }


def waterworks_code(name: ColumnOrName) -> Column:
    return F.upper(F.substring(_c(name), 1, 3))


# H-08 ----------------------------------------------------------------------
def null_if_not_analysed(text: ColumnOrName) -> Column:
    s = _c(text)
    return F.when(~F.coalesce(s.rlike(NOT_ANALYSED_PATTERN), F.lit(False)), s)


def blank_if_not_analysed(text: ColumnOrName) -> Column:
    """H-08 in single-reference form: marked values become '' (then parse to
    NULL).  Used inside the lab flow, where Catalyst may inline the text into
    pushed-down filters."""
    return F.regexp_replace(_c(text), r"^.*" + NOT_ANALYSED_PATTERN + r".*$", "")


# H-09 ----------------------------------------------------------------------
def limit_comma_to_point(text: ColumnOrName) -> Column:
    """First ',' becomes '.', but only in values carrying '<' or '>'.

    One regular expression (a lookahead carries the '<'/'>' condition), so the
    text is referenced once and the expression stays small when Catalyst
    inlines it into pushed-down filters.
    """
    return F.regexp_replace(_c(text), r"^(?=.*[<>])([^,]*),", "$1.")




def with_lab_value(df, text_col: str, below_factor: float = 0.5, prefix: str = ""):
    """DataFrame form of ``lab_value`` in stages (sign, number, value).

    ``regexp_extract_all(...)[1]`` is NULL when the anchored pattern does not
    match, so each part references the text once; this keeps generated code
    small when Catalyst substitutes the stages into a pushed-down filter.
    """
    pat = LAB_VALUE_PATTERN
    s = F.col(text_col)
    staged = df.withColumns(
        {
            "__lv_sign": F.get(F.regexp_extract_all(s, F.lit(pat), 1), 0),
            "__lv_num": F.get(F.regexp_extract_all(s, F.lit(pat), 2), 0).try_cast("double"),
        }
    )
    sign, num = F.col("__lv_sign"), F.col("__lv_num")
    # number x factor: each input referenced once (see micro_to_milli)
    factor = F.when(sign == "<", F.lit(below_factor)).otherwise(F.lit(1.0))
    return staged.withColumns(
        {f"{prefix}numeric_value": num * factor, f"{prefix}out_of_limit": sign}
    ).drop("__lv_sign", "__lv_num")


def with_matched_value(df, text_col: str, matches_col: str, below_factor: float = 0.5):
    """``with_lab_value`` for a text of which ``matches_col`` says whether it is a lab value: no pattern runs again."""
    matches = F.col(matches_col)
    sign = F.when(matches, F.regexp_replace(F.substring(F.trim(text_col), 1, 1), "[^<>]", ""))
    number = F.when(matches, F.translate(F.col(text_col), "<>", "")).try_cast("double")
    factor = F.when(F.col(text_col).contains("<"), F.lit(below_factor)).otherwise(F.lit(1.0))
    return df.withColumns({"numeric_value": number * factor, "out_of_limit": sign})


# H-11 ----------------------------------------------------------------------
def micro_to_milli(unit: ColumnOrName, value: ColumnOrName) -> dict[str, Column]:
    """µg/l -> mg/l (value x 0.001); other units unchanged; NULL unit -> NULL."""
    u, v = _c(unit), _c(value)
    micro = u == F.lit("µg/l")
    # value x factor (NULL factor for a NULL unit) references the value once,
    # so inlining it into a pushed-down filter does not duplicate the parse.
    factor = F.when(micro, F.lit(0.001)).when(u.isNotNull(), F.lit(1.0))
    return {
        "unit": F.when(micro, F.lit("mg/l")).otherwise(u),
        "numeric_value": v * factor,
    }


# H-12 / H-13 / H-17 ----------------------------------------------------------
def _try_ntz(text: Column, fmt: str) -> Column:
    """Text of a format -> TIMESTAMP_NTZ, else NULL: parsed as UTC and counted from the epoch."""
    instant = F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(fmt + "X"))
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def local_plus_one_to_utc(text: ColumnOrName, fmt: str | None = None) -> Column:
    """Wall-clock text (or NTZ timestamp) in fixed UTC+1 -> UTC as TIMESTAMP_NTZ; text that
    is no time -> NULL.  Never goes through the session's time zone."""
    t = _c(text)
    ntz = _try_ntz(t, fmt) if fmt else t.try_cast("timestamp_ntz")
    return F.convert_timezone(F.lit(GMT_PLUS_ONE), F.lit("UTC"), ntz)


def utc_bound_as_local_plus_one(since_utc: str) -> str:
    """A UTC bound expressed on the loggers' UTC+1 clock.  The offset is
    constant (no daylight saving), so ``to_utc(local) >= since`` equals
    ``local >= since + 1 h`` -- a predicate on the raw column that Catalyst
    can push into the scan."""
    import datetime as _dt

    t = _dt.datetime.fromisoformat(str(since_utc)) + _dt.timedelta(hours=1)
    return t.isoformat(sep=" ")


def utc_to_local_plus_one(ts: ColumnOrName) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(GMT_PLUS_ONE), _c(ts).cast("timestamp_ntz"))


def is_utc_text(text: ColumnOrName) -> Column:
    return F.coalesce(_c(text).rlike(UTC_TEXT_PATTERN), F.lit(False))


def parse_utc_text(text: ColumnOrName) -> Column:
    """Strict ``yyyy-MM-ddTHH:mm:ssZ`` -> TIMESTAMP_NTZ in UTC, else NULL."""
    s = _c(text)
    return F.when(is_utc_text(s), F.regexp_replace(s, "Z$", "")).try_cast("timestamp_ntz")


def period_text(ts_utc: ColumnOrName) -> Column:
    """``yyyyMMdd-HHmmss`` in UTC+1 followed by ``TZ+01``."""
    return F.concat(F.date_format(utc_to_local_plus_one(ts_utc), "yyyyMMdd-HHmmss"), F.lit("TZ+01"))


# H-14 / H-15 / H-16 ----------------------------------------------------------
def parse_date(text: ColumnOrName, fmt: str) -> Column:
    return F.try_to_date(_c(text), fmt)


def survey_date(text: ColumnOrName) -> Column:
    """'yy/MM/dd' of 1991 -> '19' prefix, then a date."""
    return F.try_to_date(F.concat(F.lit("19"), _c(text)), "yyyy/M/d")


def year_end(year: ColumnOrName) -> Column:
    return F.make_date(_c(year).cast("int"), F.lit(12), F.lit(31))


def to_number(text: ColumnOrName) -> Column:
    """Text -> DOUBLE; text that is not a plain decimal number -> NULL.

    A bare ``try_cast`` would accept '1.5d', 'NaN' or 'Infinity'.
    """
    s = _c(text).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), F.trim(s)).try_cast("double")


def to_int(text: ColumnOrName) -> Column:
    s = _c(text).cast("string")
    return F.when(s.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(s)).try_cast("int")


# H-18 / H-19 -----------------------------------------------------------------
def header_key(parts: Sequence[ColumnOrName]) -> Column:
    """Header cells joined with '@' (missing -> 'NA'); an all-missing tail of
    'NA' parts is removed: 'Datum@NA' -> 'Datum', 'Cl@NA@mg/l@NA' stays."""
    cols = [F.coalesce(_c(p), F.lit("NA")) for p in parts]
    joined = F.concat_ws("@", *cols)
    if len(cols) == 1:
        return joined
    tail = "(@NA)" * (len(cols) - 1) + "$"
    return F.regexp_replace(joined, tail, "")


def split_key(key: ColumnOrName, names: Sequence[str], sep: str = "@") -> dict[str, Column]:
    """Split into named parts: missing parts NULL, extra parts dropped."""
    arr = F.split(_c(key), F.lit(sep))
    return {name: F.get(arr, i) for i, name in enumerate(names)}


# H-21 / H-22 / H-23 ----------------------------------------------------------
def split_fixed(text: ColumnOrName, pattern: str, n: int) -> list[Column]:
    """``str_split_fixed``: exactly n pieces, missing pieces ''."""
    arr = F.split(_c(text), pattern, n)
    return [F.coalesce(F.get(arr, i), F.lit("")) for i in range(n)]


def substitute_all(text: ColumnOrName, replacements: Sequence[tuple[str, str]]) -> Column:
    out = _c(text)
    for pattern, repl in replacements:
        out = F.regexp_replace(out, pattern, repl)
    return out


# H-24 ------------------------------------------------------------------------
def ordered_join(order: ColumnOrName, value: ColumnOrName, sep: str = "@") -> Column:
    """Aggregate: values joined in ``order`` (for header rows, few per group)."""
    pairs = F.array_sort(F.collect_list(F.struct(_c(order).alias("o"), _c(value).alias("v"))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), sep)


# H-25 ------------------------------------------------------------------------
def parameter_unit(parameter: ColumnOrName) -> Column:
    p = _c(parameter)
    expr = None
    for name, unit in PARAMETER_UNITS:
        expr = F.when(p == name, F.lit(unit)) if expr is None else expr.when(p == name, F.lit(unit))
    return expr


def depth_label(depth: ColumnOrName, sensor: ColumnOrName) -> Column:
    """'<depth> m uGOK (<sensor>)'; NULL when the depth is unknown."""
    return F.concat(_c(depth).cast("string"), F.lit(" m uGOK ("), _c(sensor).cast("string"), F.lit(")"))


def plot_title(parameter: ColumnOrName, well: ColumnOrName) -> Column:
    return F.format_string("Parameter: %s, Brunnen: K%d", _c(parameter), _c(well))


def plot_name(parameter: ColumnOrName, well: ColumnOrName) -> Column:
    return F.format_string("%s_K%02d", _c(parameter), _c(well))


# H-26 ------------------------------------------------------------------------
def to_million(value: ColumnOrName) -> Column:
    return _c(value) / F.lit(1e6)


# H-28 ------------------------------------------------------------------------
def text_value(par_name: ColumnOrName, raw: ColumnOrName, text_parameters=TEXT_PARAMETERS) -> Column:
    return F.when(_c(par_name).isin(list(text_parameters)), _c(raw))


# K-03 helper -----------------------------------------------------------------
def decimal_comma(value: ColumnOrName, digits: int = 2) -> Column:
    return F.replace(F.format_string(f"%.{digits}f", _c(value)), F.lit("."), F.lit(","))


# §1.5 helpers ---------------------------------------------------------------
def not_in(col: ColumnOrName, values: Sequence) -> Column:
    """R ``!x %in% set``: NULL counts as 'not in'."""
    return ~F.coalesce(_c(col).isin(list(values)), F.lit(False))


def not_rlike(col: ColumnOrName, pattern: str) -> Column:
    """R ``!grepl``: NULL text does not match the pattern, so it is kept."""
    return ~F.coalesce(_c(col).rlike(pattern), F.lit(False))


def nan_to_null(col: ColumnOrName) -> Column:
    c = _c(col)
    return F.when(~F.isnan(c), c)


def has_text(col: ColumnOrName) -> Column:
    """Not NULL and not empty."""
    return F.coalesce(F.length(_c(col)), F.lit(0)) > 0
