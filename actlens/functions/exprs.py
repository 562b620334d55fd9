"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actlens.functions import labels as L


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_of(action: str, action_col: str = "action") -> Column:
    """Number of rows of one action, as BIGINT (null actions count nowhere)."""
    return F.count_if(F.col(action_col) == F.lit(action))


def _nonzero(c: Column) -> Column:
    """The divisor, or null when it is 0 (ANSI mode raises on x % 0)."""
    return F.when(c != 0, c)


def floor_div(num: str | Column, den: str | Column) -> Column:
    """Exact floor(num / den) for BIGINT operands, den > 0 (null when den is 0)."""
    a, b = col(num).cast("long"), _nonzero(col(den).cast("long"))
    exact_multiple = (a - F.pmod(a, b)).cast("decimal(38,0)")
    return F.try_divide(exact_multiple, b.cast("decimal(38,0)")).cast("long")


def half_up_div(num: str | Column, den: str | Column) -> Column:
    """num / den rounded half-up to an integer, exactly, for num >= 0, den > 0."""
    return floor_div(col(num).cast("long") * 2 + col(den), col(den).cast("long") * 2)


def half_even_div(num: str | Column, den: str | Column) -> Column:
    """num / den rounded half-to-even (Python's ``round``), exactly."""
    a, b = col(num).cast("long"), _nonzero(col(den).cast("long"))
    q, r2 = floor_div(a, b), F.pmod(a, b) * 2
    return q + F.when((r2 > b) | ((r2 == b) & (F.pmod(q, F.lit(2)) == 1)), 1).otherwise(0)


def exact_pct(part: str | Column, whole: str | Column, digits: int = L.SHARE_DIGITS,
              rounding: str = "half_up") -> Column:
    """round(part / whole * 100, digits) for counts, computed on integers so it
    is exact at any scale; null when ``whole`` is 0.  ``rounding`` is
    ``"half_up"`` (Spark's ``round``) or ``"half_even"`` (Python's)."""
    scale = 10 ** digits
    div = {"half_up": half_up_div, "half_even": half_even_div}[rounding]
    k = div(col(part).cast("long") * (100 * scale), col(whole))
    return k.cast("double") / F.lit(float(scale))


def exact_ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """round(num / den, digits) half-up for counts, exact; null when den is 0."""
    scale = 10 ** digits
    k = half_up_div(col(num).cast("long") * scale, col(den))
    return k.cast("double") / F.lit(float(scale))


def parse_timestamp_ntz(c: str | Column, fmt: str = L.TIME_FORMAT, fraction: bool = True) -> Column:
    """Parse text with a fixed layout to TIMESTAMP_NTZ; malformed text gives
    null instead of an ANSI error.  With ``fraction`` the layout may be
    followed by up to six fractional-second digits (as :func:`time_text`
    writes them)."""
    c = col(c)
    pattern = F.lit(f"{fmt}[.SSSSSS]" if fraction else fmt)
    return F.when(F.try_to_timestamp(c, pattern).isNotNull(), F.to_timestamp_ntz(c, pattern))


def time_text(c: str | Column, fmt: str = L.TIME_FORMAT) -> Column:
    """A timestamp as text in the file layout, with ``.ffffff`` only when the
    time has a fraction of a second -- the inverse of
    :func:`parse_timestamp_ntz`."""
    c = col(c)
    whole = F.date_format(c, "SSSSSS") == F.lit("000000")
    return F.when(whole, F.date_format(c, fmt)).otherwise(F.date_format(c, f"{fmt}.SSSSSS"))


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (NTZ) timestamp.

    Built from the date and clock fields, which need no time zone;
    ``timestamp_diff`` / ``unix_micros`` would first turn the value into an
    instant in the session zone and shift it around daylight-saving changes."""
    c = col(c)
    seconds = F.date_part(F.lit("SECOND"), c)  # seconds with microsecond fraction
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
        + F.hour(c).cast("long") * F.lit(3_600_000_000)
        + F.minute(c).cast("long") * F.lit(60_000_000)
        + (seconds * F.lit(1_000_000)).cast("long")
    )
