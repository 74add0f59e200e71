"""Release calendar, names and human-readable sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def release_month(day: Column) -> Column:
    """The newest release on a day: last month's from the 15th on, else that of the month before."""
    return F.trunc(F.when(F.day(day) >= 15, F.add_months(day, -1)).otherwise(F.add_months(day, -2)), "month")


def month_options(day: Column) -> Column:
    """array<struct<label, month, year>>: the current release and the one before; a label reads "Current (May 2024)"."""
    newest = release_month(day)

    def one(label: str, d: Column) -> Column:
        return F.struct(F.concat(F.lit(f"{label} ("), F.date_format(d, "MMM yyyy"), F.lit(")")).alias("label"), F.date_format(d, "MMM").alias("month"), F.date_format(d, "yyyy").alias("year"))

    return F.array(one("Current", newest), one("Previous", F.add_months(newest, -1)))


def slug(month: Column, year: Column) -> Column:
    return F.lower(F.concat_ws("-", month, year))


def object_path(base: Column, *parts: Column) -> Column:
    """Parts of a URL or prefix joined by single slashes; empty ones are left out."""
    trimmed = [F.nullif(F.regexp_replace(p, "^/+|/+$", ""), F.lit("")) for p in parts]
    return F.concat_ws("/", F.regexp_replace(base, "/+$", ""), *trimmed)


def format_duration(seconds: float) -> str:
    """Seconds below a minute, minutes and seconds below an hour, else hours and minutes."""
    minutes, rest = divmod(seconds, 60)
    hours, left = divmod(int(minutes), 60)
    return f"{hours}h {left}m" if hours else f"{left}m {rest:.0f}s" if left else f"{seconds:.1f}s"


def format_size(n: int) -> str:
    size, units = float(n), ["B", "KB", "MB", "GB", "TB", "PB"]
    while size >= 1024 and len(units) > 1:
        size /= 1024
        units.pop(0)
    return f"{size:.1f} {units[0]}"
