"""Scalar Column builders.

Every function returns a ``Column`` made of built-in expressions, so it stays
inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source data model.
MISSING_EVENT_ORDINAL = 800000          # ordinal used for "event never happened"
TWO_DIGIT_YEAR_PIVOT = 2069
DATE_FORMATS = {"iso": "yyyy-MM-dd", "us_short": "M/d/yy", "compact": "yyyyMMdd"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c, width: int) -> Column:
    """Left-pad with '0' to ``width``; longer text is kept whole (no truncation)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def key_from_float(c, width: int | None = None) -> Column:
    """Key from a float rendered as text: cut at the first '.', then pad."""
    s = F.substring_index(_c(c).cast("string"), ".", 1)
    return zero_pad(s, width) if width else s


def compose_key(*cols) -> Column:
    return F.concat(*[_c(c).cast("string") for c in cols])


def parent_key(c, n: int = 2) -> Column:
    """Parent code = first ``n`` characters of the child code."""
    return F.substring(_c(c), 1, n)


def suffix_key(c, n: int = 5) -> Column:
    return F.right(_c(c), F.lit(n))


def parse_date(c, fmt: str, strict: bool = True) -> Column:
    """Parse text in one of the source formats (or any Spark pattern)."""
    pattern = DATE_FORMATS.get(fmt, fmt)
    d = F.to_date(_c(c), pattern) if strict else F.try_to_date(_c(c), F.lit(pattern))
    if "yy" in pattern and "yyy" not in pattern:
        # two-digit years: 69-99 -> 19xx, 00-68 -> 20xx (POSIX %y); Spark maps all to 20xx
        d = F.when(F.year(d) >= TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)
    return d


def nonneg_numeric(c, strict: bool = True) -> Column:
    """To double; negative no-data codes become NULL.

    ``strict`` casts with ANSI semantics (bad text raises, as the source
    loader does); otherwise bad text becomes NULL.
    """
    x = _c(c).cast("double") if strict else F.expr(f"try_cast({_name(c)} as double)")
    return F.when(x >= 0, x)


def _name(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("non-strict numeric parse needs a column name")


def nan_to_null(c) -> Column:
    x = _c(c)
    return F.when(~F.isnan(x), x)


def safe_ratio(num, den) -> Column:
    """num / den; a zero or missing denominator gives NULL (never inf/NaN)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_log(c) -> Column:
    """Natural log; non-positive input gives NULL."""
    x = _c(c).cast("double")
    return F.when(x > 0, F.ln(x))


def tenths_c_to_f(c) -> Column:
    """Tenths of a degree Celsius to Fahrenheit: (x/10)*(9/5)+32."""
    return (_c(c) / 10.0) * (9.0 / 5.0) + 32.0


def threshold_flag(c, threshold: float) -> Column:
    """1 when value > threshold, else 0; missing counts as 0."""
    return F.coalesce((_c(c) > F.lit(threshold)).cast("int"), F.lit(0))


def ordinal_to_date(c, missing: int = MISSING_EVENT_ORDINAL) -> Column:
    """Proleptic Gregorian ordinal (day 1 = 0001-01-01) to a date."""
    n = F.coalesce(_c(c).cast("double").cast("int"), F.lit(missing))
    return F.date_add(F.lit("0001-01-01").cast("date"), n - 1)


def event_in_force(ordinal, d, missing: int = MISSING_EVENT_ORDINAL) -> Column:
    """1 when the event's date is on or before the row date."""
    return (ordinal_to_date(ordinal, missing) <= _c(d)).cast("int")


def weekday_monday0(d) -> Column:
    return F.weekday(_c(d))


def conditional_override(c, condition: Column, value) -> Column:
    return F.when(condition, value).otherwise(_c(c))


def abs_error(y, y_hat) -> Column:
    return F.abs(_c(y) - _c(y_hat))


def label_model(c, sep: str = " - ") -> Column:
    """Model name = text before the separator."""
    return F.substring_index(_c(c), sep, 1)


def label_version(c) -> Column:
    """Version = last character of the label."""
    return F.right(_c(c), F.lit(1))


def round6(c) -> Column:
    return F.round(_c(c), 6)
