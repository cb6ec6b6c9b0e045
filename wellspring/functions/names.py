"""Column-name helpers (metadata only; they never touch rows).

H-20 clean names, P-02 regex rename, P-17 keep/gather split of names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

# --- fixed values: default keep patterns of the lab-archive readers --------
# Header names kept beside the gathered values (original names).
GATHER_IGNORE_FIELDS = (
    "Datum", "KN", "[iI]nterne Nr.", "Name der", "Ort", "Probe",
    "Prü", "Untersuchung", "Labor", "Jahr", "Galer", "Detail",
    "Meß", "Zeit", "Bezei", "Monat",
)
# The same for clean (English) names.
GATHER_IGNORE_FIELDS_CLEAN = (
    "LabSampleCode", "Date", "Time", "Waterbody", "ExSiteCode", "Site",
)
# ---------------------------------------------------------------------------

_UMLAUTS = {"ä": "a", "ö": "o", "ü": "u", "Ä": "A", "Ö": "O", "Ü": "U", "ß": "ss", "µ": "u"}


def clean_name(name: str) -> str:
    """snake_case ASCII; 'x' before a leading digit; empty -> 'x'."""
    s = "".join(_UMLAUTS.get(ch, ch) for ch in str(name))
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
    s = re.sub(r"([a-z])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean and make unique with _2, _3 ... suffixes."""
    out, seen = [], {}
    for name in names:
        base = clean_name(name)
        k = seen.get(base, 0) + 1
        seen[base] = k
        out.append(base if k == 1 else f"{base}_{k}")
    return out




def rename_regex(df: DataFrame, pattern: str, repl: str) -> DataFrame:
    """P-02: rename every column by a regex substitution."""
    return df.toDF(*[re.sub(pattern, repl, c) for c in df.columns])


def or_pattern(patterns: Iterable[str]) -> str:
    """Alternation of the given regular expressions (unanchored)."""
    return "|".join(patterns)


def gather_ignore_pattern(fields: Sequence[str] = GATHER_IGNORE_FIELDS) -> str:
    return or_pattern(fields)




def split_columns(names: Sequence[str], keep_pattern: str | None = None):
    """P-17: (kept, gathered) lists of names by an alternation pattern."""
    rx = re.compile(keep_pattern or gather_ignore_pattern())
    kept = [n for n in names if rx.search(n)]
    return kept, [n for n in names if not rx.search(n)]
