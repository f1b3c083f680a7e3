"""Date and time expressions on station-local wall-clock values (never zone dependent)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from obslake.functions.exact import col

#: Two-digit years from here on belong to the 1900s.
PIVOT_YEAR = 69
_EXPORT_STAMP = r"^\d{1,2}/\d{1,2}/\d{2} \d{1,2}:\d{2}$"


def parse_export_stamp(date: str | Column, time: str | Column) -> Column:
    """``dd/MM/yy`` and ``HH:mm`` text as TIMESTAMP_NTZ; NULL where it is no valid instant.

    Kept small: long expressions make generated methods that the JVM does not compile.
    """
    d, t = col(date), col(time)
    dd, mm, yy = (F.split_part(d, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    century = F.when(yy >= F.lit(str(PIVOT_YEAR)), "19").otherwise("20")
    iso = F.concat(century, yy, F.lit("-"), mm, F.lit("-"), dd, F.lit(" "), t)
    return F.when(F.concat_ws(" ", d, t).rlike(_EXPORT_STAMP), iso.try_cast("timestamp_ntz"))


def has_shape(text: Column, shape: str) -> Column:
    """Whether the text has a digit wherever ``shape`` has a 0, and else its very characters."""
    return F.translate(text, "123456789", "000000000") == shape


def date_id(c: str | Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return (F.year(col(c)) * 10000 + F.month(col(c)) * 100 + F.dayofmonth(col(c))).cast("int")


def floor_to_minutes(c: str | Column, minutes: int) -> Column:
    """Start of the slot of ``minutes`` (a divisor of 60) holding the instant; stays TIMESTAMP_NTZ."""
    ts = col(c)
    past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts) % F.lit(minutes), F.extract(F.lit("SECOND"), ts))
    return ts - past


def day_fraction(c: str | Column) -> Column:
    """Share of its day that has passed at an instant; 0 for a date."""
    ts = col(c).cast("timestamp_ntz")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return seconds / F.lit(86400.0)


def days_between(lo: str | Column, hi: str | Column) -> Column:
    """Array of the dates from ``lo`` to ``hi``, both included."""
    return F.sequence(col(lo).cast("date"), col(hi).cast("date"), F.expr("interval 1 day"))
