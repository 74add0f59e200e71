"""Region codes: which are valid, which is a location's leaf, and prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def valid_state(code: Column) -> Column:
    """A state code counts only with something after its first hyphen, and a prefix without one doesn't."""
    prefix = F.split_part(code, F.lit("-"), F.lit(1))
    return F.when(F.length(code) > F.length(prefix) + 1, code)


def leaf_region(country: Column, state: Column, county: Column) -> Column:
    return F.coalesce(filled(county), valid_state(state), filled(country))


def grid_region(country: Column, state: Column) -> Column:
    return F.coalesce(valid_state(state), filled(country))


def dedupe_key(group: Column, event: Column) -> Column:
    """Checklists of a group count once."""
    return F.coalesce(filled(group), event)


def in_region(code: Column, region: Column, mode: str = "strict") -> Column:
    """strict: the region itself or one below it (hyphen); loose: any code that begins with it. Both ignore ASCII case and take codes as written, without wildcards."""
    c, r = F.lower(code), F.lower(region)
    return c.startswith(r) if mode == "loose" else (c == r) | c.startswith(F.concat(r, F.lit("-")))


def parse_list(text: Column) -> Column:
    """Codes parted by commas or white space, upper-cased, without empty ones."""
    return F.filter(F.transform(F.split(text, r"[,\s]+"), lambda x: F.upper(F.trim(x))), lambda x: x != "")
