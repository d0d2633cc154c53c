"""Lookups over the location dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions import replace_map, zero_pad


def locations_of_state(locations: DataFrame, state_fips: int,
                       replace: Mapping[str, str] | None = None) -> DataFrame:
    """Counties of one state: ``state_fips = s and location != s``, with
    the name, the zero-padded FIPS and the display name after ``replace``."""
    out = locations.filter((F.col("state_fips") == F.lit(state_fips))
                           & (F.col("location") != F.lit(state_fips)))
    return out.select("name", zero_pad("location").alias("fips"),
                      (replace_map("name", replace) if replace else F.col("name")).alias("display_name"))
