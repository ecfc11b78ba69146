"""Value coercion, blanks, labels and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\r\n\f\x0b"

# Date layouts tried in this order; the first is the one the source header names.
DATE_FORMATS = ("MM-dd-yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy h:mm:ss a", "M/d/yyyy")


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def coerce_numeric(value: str | Column) -> Column:
    """Text or number to double; anything unreadable, and NaN, to null."""
    return nan_to_null(as_column(value).try_cast("double"))


def coerce_datetime(value: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to timestamp by the first layout that fits; null when none does."""
    text = F.btrim(as_column(value), F.lit(_WHITESPACE))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def coerce_date(value: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return coerce_datetime(value, formats).cast("date")


def nan_to_null(value: str | Column) -> Column:
    return F.nanvl(as_column(value), F.lit(None).cast("double"))


def blank_to_null(value: str | Column) -> Column:
    """Trimmed text, with the empty string turned into null."""
    return F.nullif(F.btrim(as_column(value), F.lit(_WHITESPACE)), F.lit(""))


# From here on the millionths of a double are no exact whole number any more.
_NO_DECIMALS_ABOVE = 2.0**53 / 1e6


def norm_number(value: str | Column) -> Column:
    """Number rounded to six decimals, ties to even, NaN to null.

    Written with ``rint``, which is plain arithmetic; ``round`` goes through a decimal
    object for every value.
    """
    number = nan_to_null(as_column(value).cast("double"))
    return F.when(F.abs(number) < _NO_DECIMALS_ABOVE, F.rint(number * 1e6) / 1e6).otherwise(number)


def first_nonblank(*values: str | Column) -> Column:
    """First value that is neither null nor blank, trimmed."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def first_number(*values: str | Column) -> Column:
    return F.coalesce(*[nan_to_null(as_column(v).cast("double")) for v in values])


def log_scaled_size(value: str | Column, factor: float = 10.0, low: float = 5.0, high: float = 100.0) -> Column:
    """``clip(log1p(x or 0) * factor, low, high)``."""
    raw = F.log1p(F.coalesce(as_column(value), F.lit(0.0))) * factor
    return F.least(F.lit(high), F.greatest(F.lit(low), raw))


def scaled_to_max(value: str | Column, maximum: Column, factor: float, base: float) -> Column:
    """``value / max * factor + base``, with a zero maximum read as one."""
    divisor = F.when(maximum == 0, F.lit(1.0)).otherwise(maximum.cast("double"))
    return F.try_divide(as_column(value).cast("double"), divisor) * factor + base


def month_key(date: str | Column) -> Column:
    """Month of the year, 1 to 12, on which climate is averaged and joined; null without a date."""
    return F.month(as_column(date))


def year_month_label(year: str | Column, month: str | Column) -> Column:
    return F.concat(as_column(year).cast("string"), F.lit("-"), F.lpad(as_column(month).cast("string"), 2, "0"))


def quarter_label(quarter: str | Column) -> Column:
    return F.concat(F.lit("Q"), as_column(quarter).cast("int").cast("string"))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


# Labels and upper edges of the wave bands.
WAVE_BANDS = ((2.0, "Bajo (< 2m)"), (4.0, "Medio (2-4m)"))
WAVE_BAND_TOP = "Alto (> 4m)"


def wave_band(height: str | Column) -> Column:
    value = as_column(height)
    (edge, label), *rest = WAVE_BANDS
    band = F.when(value < edge, label)
    for edge, label in rest:
        band = band.when(value < edge, label)
    return band.otherwise(WAVE_BAND_TOP)


# Species-name shape accepted by the quality rules.
BINOMIAL_PATTERN = r"^[A-Z][a-z]+ [a-z\-]+$"


def is_binomial(name: str | Column) -> Column:
    return as_column(name).rlike(BINOMIAL_PATTERN)


def right_closed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based index of ``bins`` equal-width right-closed bins; the lowest edge belongs to bin 0.

    When every value is equal the range is widened by 0.1 % on both sides, which puts
    that value in the middle bin.
    """
    width = (high - low) / bins
    index = F.ceil(F.try_divide(value - low, width)).cast("int") - 1
    clamped = F.greatest(F.lit(0), F.least(F.lit(bins - 1), index))
    # (x - low') / width' is bins/2 exactly here, so the right-closed bin index is ceil(bins/2) - 1.
    middle = F.lit((bins + 1) // 2 - 1)
    return F.when(value.isNull(), F.lit(None).cast("int")).when(high == low, middle).otherwise(clamped)


def left_closed_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based index of ``bins`` equal-width left-closed bins, the last one closed on both ends.

    A constant column is read over ``[low - 0.5, high + 0.5]``.
    """
    start = F.when(high == low, low - 0.5).otherwise(low)
    width = F.when(high == low, F.lit(1.0)).otherwise(high - low) / bins
    return F.least(F.floor((value - start) / width), F.lit(bins - 1)).cast("int")
