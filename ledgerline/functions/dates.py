"""Dates and times, kept as text in ISO form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def normalize_datetime(c: Column) -> Column:
    """ISO text from yyyyMMdd, yyyyMMddHHmmss, yyyy-MM-dd, and times with a decimal comma or a tight zone; else as it is."""
    s = strip(F.coalesce(c, F.lit("")))
    part = lambda at, n: F.substring(s, at, n)
    date = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2))
    time = F.concat_ws(":", part(9, 2), part(11, 2), part(13, 2))
    dialect = F.regexp_replace(F.regexp_replace(s, "(\\d{2}:\\d{2}:\\d{2}),(\\d+)", "$1.$2"), "([+-]\\d{2})(\\d{2})$", "$1:$2")
    return (
        F.when(s.rlike("^[0-9]{8}$"), F.concat(date, F.lit("T00:00:00Z")))
        .when(s.rlike("^[0-9]{14}$"), F.concat(date, F.lit("T"), time, F.lit("Z")))
        .when(s.rlike("^.{4}-.{2}-.{2}$"), F.concat(s, F.lit("T00:00:00Z")))
        .otherwise(dialect)
    )


def day(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, 10)


def _checked(y: Column, m: Column, d: Column) -> Column:
    good = y.try_cast("int").between(1901, 2099) & m.try_cast("int").between(1, 12) & d.try_cast("int").between(1, 31)
    return F.when(good, F.concat(y, m, d))


def date_from_name(c: Column) -> Column:
    """yyyyMMdd from the first eight digits of a name, read as year first, else as day first; null if neither is a date."""
    at = lambda pattern, *groups: (F.regexp_extract(c, pattern, g) for g in groups)
    return F.coalesce(_checked(*at("(\\d{4})(\\d{2})(\\d{2})", 1, 2, 3)), _checked(*at("(\\d{2})(\\d{2})(\\d{4})", 3, 2, 1)))


def date_partition(c: Column) -> Column:
    """struct(year, month) as yyyy and yyyy-MM."""
    return F.struct(F.substring(c, 1, 4).alias("year"), F.substring(c, 1, 7).alias("month"))


def age_iso(born: Column, at: Column) -> Column:
    """P{w}W for whole weeks, else P{d}D; null if a date is missing or the order is wrong."""
    days = F.datediff(F.try_to_date(F.substring(at, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(born, 1, 10), "yyyy-MM-dd"))
    weeks = (days / 7).cast("int")
    return F.when(days < 0, None).when((days > 0) & (days % 7 == 0), F.format_string("P%dW", weeks)).when(days.isNotNull(), F.format_string("P%dD", days))


def age_years(age: Column, born: Column, at: Column) -> Column:
    """P{n}Y from an age such as 039Y, else from two yyyyMMdd dates, 0 to 149 years; else empty."""
    text = strip(F.coalesce(age, F.lit("")))
    given = F.regexp_extract(text, "^0*([1-9][0-9]*)[yY]$", 1)
    both = born.rlike("^[0-9]{8}$") & at.rlike("^[0-9]{8}$")
    years = F.substring(at, 1, 4).try_cast("int") - F.substring(born, 1, 4).try_cast("int") - (F.substring(at, 5, 4) < F.substring(born, 5, 4)).cast("int")
    return F.when(given != "", F.concat(F.lit("P"), given, F.lit("Y"))).when(both & years.between(0, 149), F.format_string("P%dY", years)).otherwise("")


def parse_month_name(c: Column) -> Column:
    """ISO text from such as 2025-Oct-29 10:15:58; empty if it is none."""
    return F.coalesce(F.date_format(F.try_to_timestamp(strip(c), F.lit("yyyy-MMM-dd HH:mm:ss")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def from_parts(date: Column, time: Column) -> Column:
    """From yyyyMMdd and HHmmss with or without a fraction, which is dropped."""
    return normalize_datetime(F.concat(date, F.substring_index(time, ".", 1)))


def date_flag(stamp: Column, folder: Column) -> Column:
    """How a folder's six-digit date agrees with a yyyyMMdd stamp: read as yyMMdd or ddMMyy, whichever is nearer."""
    real = F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")
    part = lambda at: F.substring(folder, at, 2)
    read = lambda y, m, d: F.try_to_date(F.concat(F.lit("20"), part(y), part(m), part(d)), "yyyyMMdd")
    off = F.least(F.abs(F.datediff(real, read(1, 3, 5))), F.abs(F.datediff(real, read(5, 3, 1))))
    return F.when(F.coalesce(folder, F.lit("")) == "", "").when(real.isNull() | off.isNull(), "baddate").when(off <= 1, "").otherwise(F.format_string("date-off-%dd", off))
