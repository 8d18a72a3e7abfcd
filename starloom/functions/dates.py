"""Calendar expressions (DATE in, DATE/INT/SHORT/STRING out; no time zones involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width of PostgreSQL's TO_CHAR 'Day' / 'Month' output: names are blank-padded to the
# longest English name (Wednesday, September), which is 9 characters.
NAME_WIDTH = 9


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: str | Column) -> Column:
    """yyyymmdd as INT, computed arithmetically (no string formatting on the hot path)."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(d: str | Column) -> Column:
    """yyyymm as INT (partition column of the sales fact)."""
    d = col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def iso_day_of_week(d: str | Column) -> Column:
    """Monday=1 .. Sunday=7."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), col(d))


def iso_week(d: str | Column) -> Column:
    return F.weekofyear(col(d))


def day_name(d: str | Column, pad: bool = True) -> Column:
    name = F.date_format(col(d), "EEEE")
    return F.rpad(name, NAME_WIDTH, " ") if pad else name


def month_name(d: str | Column, pad: bool = True) -> Column:
    name = F.date_format(col(d), "MMMM")
    return F.rpad(name, NAME_WIDTH, " ") if pad else name


def fiscal_year(d: str | Column, start_month: int = 7) -> Column:
    """Fiscal year named after the calendar year in which it ends (July start: +1)."""
    d = col(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(d: str | Column, start_month: int = 7) -> Column:
    """Quarter within the fiscal year: with a July start, Jul-Sep=1 ... Apr-Jun=4."""
    m = F.month(col(d))
    shifted = F.pmod(m - F.lit(start_month), F.lit(12))
    return (F.floor(shifted / 3) + 1).cast("int")


def month_start(d: str | Column) -> Column:
    """DATE_TRUNC('month', d) kept as DATE."""
    return F.trunc(col(d), "MM")


def months_between_starts(later: str | Column, earlier: str | Column) -> Column:
    """Whole months between two dates: (years * 12 + months) of their difference, as
    PostgreSQL's AGE gives it for first-of-month inputs."""
    a, b = col(later), col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """date - date in days (INT)."""
    return F.datediff(col(later), col(earlier))
