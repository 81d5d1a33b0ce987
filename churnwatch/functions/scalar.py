"""Scalar column helpers. All are built-in Spark expressions (codegen, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number written as text: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent. Rejects '12d', 'NaN', 'inf' and blanks, which a plain
# try_cast would accept or turn into NaN.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
WS_PATTERN = r"^\s+|\s+$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind (Spark ``trim`` removes spaces only)."""
    return F.regexp_replace(col_of(c), WS_PATTERN, "")


def to_number(c: str | Column) -> Column:
    """Text or number -> double; anything that is not a plain number -> NULL."""
    text = strip_ws(col_of(c).cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def nan_to_null(c: str | Column) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def norm_text(c: str | Column) -> Column:
    """lower(strip(text)) as used by every yes/no and label comparison."""
    return F.lower(strip_ws(col_of(c).cast("string")))


def is_yes(c: str | Column) -> Column:
    """1 when the text equals 'yes' ignoring case and surrounding whitespace, else 0 (null -> 0)."""
    return F.coalesce((norm_text(c) == F.lit("yes")).cast("int"), F.lit(0))


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division raises on 0)."""
    return F.try_divide(num, den)


def clip(c: Column, lo: float | None, hi: float | None) -> Column:
    """Clip keeping NULL as NULL (``greatest(NULL, 0)`` would give 0)."""
    out = c
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return out


def rnd(c: Column, digits: int = 9) -> Column:
    """Rounded double used for results compared across engines."""
    return F.round(c.cast("double"), digits)


def np_lerp(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation written the way NumPy evaluates it (exact at t = 0 and a = b)."""
    return F.when(t >= F.lit(0.5), b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
