"""Column expressions shared by the jobs.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source format and of the mart files.
SENTINEL = "\\N"      # two characters: backslash, N; marks a missing cell in the TSV files
FILL_VALUE = -9999    # written for every missing cell of a mart file
SEX_CODES = {"actor": 0, "actress": 1}          # category -> sexe
SEX_LABELS = {0: "Homme", 1: "Femme"}           # sexe -> label shown by the dashboard


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: str | Column) -> Column:
    """The text sentinel becomes NULL; every other value stays."""
    c = col(c)
    return F.when(c == F.lit(SENTINEL), F.lit(None).cast("string")).otherwise(c)


def decade(year: str | Column) -> Column:
    """First year of the decade: 1987 -> 1980; NULL stays NULL."""
    return (F.floor(col(year) / 10) * 10).cast("int")


def sexe(category: str | Column) -> Column:
    """0 for actor, 1 for actress, NULL for any other category."""
    c = col(category)
    expr = None
    for name, code in SEX_CODES.items():
        expr = F.when(c == name, F.lit(code)) if expr is None else expr.when(c == name, F.lit(code))
    return expr.cast("int")


def sex_label(code: str | Column) -> Column:
    """Dashboard label of a sexe code: 0 is Homme, anything else Femme."""
    return F.when(col(code) == 0, F.lit(SEX_LABELS[0])).otherwise(F.lit(SEX_LABELS[1]))


def age(birth_year: str | Column, death_year: str | Column, as_of_year: int) -> Column:
    """Age at death if a death year is known, else age in ``as_of_year``."""
    b, d = col(birth_year), col(death_year)
    return F.when(d > 0, d - b).otherwise(F.lit(as_of_year) - b).cast("int")


def genre_items(genres: str | Column, max_items: int = 3) -> Column:
    """Array of the first ``max_items`` comma-separated items."""
    return F.slice(F.split(col(genres), ","), 1, max_items)


def feature_name(c: str | Column) -> Column:
    """Column-name rule of the ML matrix, applied to a value:
    lower case, drop '_', '-' becomes '_', ' ' becomes '_'."""
    x = F.lower(col(c))
    x = F.replace(x, F.lit("_"), F.lit(""))
    x = F.replace(x, F.lit("-"), F.lit("_"))
    return F.replace(x, F.lit(" "), F.lit("_"))


def feature_name_py(value: str) -> str:
    """The same rule for a Python string (column names)."""
    return value.lower().replace("_", "").replace("-", "_").replace(" ", "_")


def decimal_comma_text(c: str | Column) -> Column:
    """Number as text with a decimal comma: 6.92 -> '6,92'."""
    return F.regexp_replace(col(c).cast("string"), r"\.", ",")


def decimal_comma_to_double(c: str | Column) -> Column:
    """Inverse of ``decimal_comma_text``; non-numbers give NULL."""
    return F.regexp_replace(col(c), ",", ".").try_cast("double")
