"""Built-in expressions only, so all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def bpchar(text: Column, width: int) -> Column:
    """Fixed-width text: cut or padded with spaces, which are kept."""
    return F.rpad(F.left(text.cast("string"), F.lit(width)), width, " ")


def numeric_text(number: Column, precision: int, scale: int) -> Column:
    """A decimal as text with all digits of its scale."""
    return number.cast(f"decimal({precision},{scale})").cast("string")


def bytea_text(text: Column) -> Column:
    """Bytes from hex text with its leading ``\\x``."""
    return F.unhex(F.substring(text, 3, 1 << 30))


def epoch_days(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit("1970-01-01").cast("date"))


def epoch_micros(timestamp: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, read as UTC (the session's zone)."""
    return F.unix_micros(timestamp.cast("timestamp"))


def time_micros(timestamp: Column) -> Column:
    """Microseconds since midnight, for times before 1970 as well."""
    return F.pmod(epoch_micros(timestamp), F.lit(_DAY))


def time_of_day(timestamp: Column) -> Column:
    return F.date_format(timestamp, "HH:mm:ss.SSSSSS").cast("time(6)")


def interval_parts(years: Column, months: Column, days: Column, hours: Column, minutes: Column, seconds: Column) -> Column:
    """Months, days and nanoseconds, which are kept apart."""
    whole = (hours.cast("long") * 3600 + minutes.cast("long") * 60) * 1_000_000_000
    return F.struct(
        (years * 12 + months).cast("int").alias("months"),
        days.cast("int").alias("days"),
        (whole + F.round(seconds * 1_000_000).cast("long") * 1000).alias("nanoseconds"),
    )
