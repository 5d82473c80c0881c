"""Identifiers, names and time stamps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column, width: int = 3) -> Column:
    """`WH-007`; longer numbers keep all their digits."""
    return F.format_string(f"{prefix}-%0{width}d", number)


def full_name(first, last) -> Column:
    return F.concat(first, F.lit(" "), last)


def email_address(first: Column, last: Column, domain: str = "example.eu") -> Column:
    return F.concat(F.lower(first), F.lit("."),
                    F.replace(F.lower(last), F.lit(" "), F.lit("")), F.lit(f"@{domain}"))


def country_prefix(country: Column) -> Column:
    return F.upper(F.substring(country, 1, 2))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSSSSS")


def stamp_of_file(path: Column) -> Column:
    """Time stamp in a landed file's name, with or without microseconds."""
    day_time = F.regexp_extract(path, r"_(\d{8}_\d{6})(?:_\d{6})?(?:\.json|/)", 1)
    micros = F.regexp_extract(path, r"_\d{8}_\d{6}_(\d{6})(?:\.json|/)", 1)
    whole = F.concat(day_time, F.lit("_"), F.rpad(micros, 6, "0"))
    return F.try_to_timestamp(whole, F.lit("yyyyMMdd_HHmmss_SSSSSS")).cast("timestamp_ntz")


def coordinate(value: Column) -> Column:
    return F.round(value, 4)
