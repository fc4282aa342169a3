"""Text to number and text to timestamp.

A number in text form may carry decimals or an exponent; integers round half away from zero. ``strict`` helpers
fail the job on text that is no number, ``lenient`` ones give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Plain decimal notation. Without it, casts would also take Java forms such as '1d' or 'NaN'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"
# A timestamp needs at least a full date.
DATE_START = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _or_fail(col: Column, value: Column, to: str) -> Column:
    error = F.raise_error(F.concat(F.lit(f"not a valid {to}: '"), col, F.lit("'"))).cast(to)
    return F.when(col.isNull(), F.lit(None)).otherwise(F.coalesce(value, error))


def lenient_int(col: Column, to: str = "int") -> Column:
    # A failing try_cast costs an exception per row, so the notation is tested first and casts hardly ever fail.
    number = F.round(col.cast("double")).try_cast(to)
    if to != "int":
        # A double would lose the last digits of a long.
        number = F.when(col.rlike(WHOLE), col.try_cast(to)).otherwise(number)
    return F.when(col.rlike(NUMBER), number)


def strict_int(col: Column, to: str = "int") -> Column:
    return _or_fail(col, lenient_int(col, to), to)


def lenient_double(col: Column) -> Column:
    return F.when(col.rlike(NUMBER), col.cast("double"))


def strict_double(col: Column) -> Column:
    return _or_fail(col, lenient_double(col), "double")


def to_ntz(col: Column) -> Column:
    """Zone-less timestamp; an offset in the text is dropped, text that is no timestamp gives NULL."""
    return F.when(col.rlike(DATE_START), col.try_cast("timestamp_ntz"))


def ntz_to_iso(col: Column) -> Column:
    """``2025-12-01T15:32:56Z``, without going through the session time zone."""
    return F.concat(F.replace(col.cast(StringType()), F.lit(" "), F.lit("T")), F.lit("Z"))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))
