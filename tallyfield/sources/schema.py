"""Declared schemas of inputs and outputs; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "binary": T.BinaryType()}


def _struct(text: str) -> T.StructType:
    """Of "name type, ..." with plain types and arrays of them; unlike Spark's own parser it needs no session."""
    out = T.StructType()
    for part in text.split(", "):
        name, kind = part.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        out.add(name, _KINDS[kind] if kind in _KINDS else T.ArrayType(_KINDS[inner]))
    return out


#: Raw header name -> our column name. The columns that an extract must have.
OBSERVATION_COLUMNS = {
    "LOCALITY ID": "location_id",
    "OBSERVATION DATE": "observed_on",
    "SAMPLING EVENT IDENTIFIER": "event_id",
    "GROUP IDENTIFIER": "group_id",
    "SCIENTIFIC NAME": "sci_name",
}
CHECKLIST_COLUMNS = {
    "LOCALITY ID": "location_id",
    "LOCALITY": "locality",
    "LOCALITY TYPE": "locality_type",
    "OBSERVATION DATE": "observed_on",
    "SAMPLING EVENT IDENTIFIER": "event_id",
    "GROUP IDENTIFIER": "group_id",
    "COUNTRY CODE": "country_code",
    "STATE CODE": "state_code",
    "COUNTY CODE": "county_code",
    "LATITUDE": "lat",
    "LONGITUDE": "lng",
}
COMPLETE, CATEGORY = "ALL SPECIES REPORTED", "CATEGORY"
CATEGORIES = ("species", "issf")

CHECKLISTS = _struct("location_id string, locality string, locality_type string, observed_on date, event_id string, group_id string, country_code string, state_code string, county_code string, lat double, lng double")
OBSERVATIONS = _struct("location_id string, observed_on date, event_id string, group_id string, sci_name string")
TAXONOMY = _struct("sciName string, comName string, speciesCode string, taxonOrder double, category string, bandingCodes array<string>, comNameCodes array<string>")
SPECIES = _struct("id bigint, sci_name string, name string, code string, taxon_order double, search_codes string")
API_HOTSPOTS = _struct("locId string, locName string, lat double, lng double, numSpeciesAllTime bigint, countryCode string, subnational1Code string, subnational2Code string")
PACKS = _struct("id bigint, region string, center_lat double, center_lng double, name string, tags array<string>")
SEEN = _struct("user_id string, species_id bigint")

#: Output tables: name -> (schema, primary key, partition columns).
TABLES = {
    "species": (SPECIES, ["id"], []),
    "hotspots": (_struct("id string, name string, country_code string, subnational1_code string, subnational2_code string, region_code string, lat double, lng double"), ["id"], []),
    "regions": (_struct("id bigint, code string"), ["id"], []),
    "month_obs": (_struct("location_id string, month bigint, species_id bigint, obs bigint, samples bigint, score double"), ["location_id", "month", "species_id"], []),
    "year_obs": (_struct("location_id string, species_id bigint, obs bigint, samples bigint, score double"), ["location_id", "species_id"], []),
    "region_month_obs": (_struct("region_id bigint, month bigint, species_id bigint, obs bigint"), ["region_id", "month", "species_id"], []),
    "region_month_samples": (_struct("region_id bigint, month bigint, samples bigint"), ["region_id", "month"], []),
    "species_fts": (_struct("species_id bigint, field string, token string"), ["species_id", "field", "token"], []),
    "metadata": (_struct("version string, version_year string, version_month string, generated_at string"), [], []),
    "h3_cells": (_struct("res int, cell_ref bigint, h3 bigint, region_code string, lat double, lng double"), ["res", "cell_ref"], ["res"]),
    "h3_cell_obs": (_struct("res int, cell_ref bigint, month bigint, species_id bigint, obs bigint"), ["res", "cell_ref", "month", "species_id"], ["res"]),
    "h3_cell_samples": (_struct("res int, cell_ref bigint, month bigint, samples bigint"), ["res", "cell_ref", "month"], ["res"]),
    "h3_metadata": (_struct("version string, res int, generated_at string"), [], []),
    "loc_meta": (_struct("loc_ref bigint, location_id string, name string, lat double, lng double, country_code string, subnational1_code string, subnational2_code string, region_code string, samples bigint"), ["loc_ref"], []),
    "loc_species": (_struct("species_id bigint, loc_ref bigint, bucket_level int"), ["species_id", "loc_ref"], []),
    "loc_qcount": (_struct("bucket int, loc_ref bigint, q_count bigint"), ["bucket", "loc_ref"], []),
    "zone_meta": (_struct("res int, cell_ref bigint, h3 bigint, lat double, lng double, samples bigint"), ["res", "cell_ref"], ["res"]),
    "zone_species": (_struct("res int, species_id bigint, cell_ref bigint, bucket_level int"), ["res", "species_id", "cell_ref"], ["res"]),
    "zone_qcount": (_struct("res int, bucket int, cell_ref bigint, q_count bigint"), ["res", "bucket", "cell_ref"], ["res"]),
    "loc_zone_h3": (_struct("res int, loc_ref bigint, h3 bigint"), ["res", "loc_ref"], ["res"]),
    "loc_cell_ref": (_struct("res int, loc_ref bigint, cell_ref bigint"), ["res", "loc_ref"], ["res"]),
    "blob_cache": (_struct("key string, part bigint, data binary"), ["key", "part"], []),
}
