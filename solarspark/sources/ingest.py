"""Work list and landing zone of the irradiance series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark.fixed_values import FIRST_YEAR, LAST_YEAR
from solarspark.functions.solar import optimal_tilt, with_solar_position


def expected_partitions(locations: DataFrame, first_year: int = FIRST_YEAR,
                        last_year: int = LAST_YEAR) -> DataFrame:
    """Every location with every year it should have landed for."""
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return locations.withColumn("YEAR", F.explode(years))


def missing_partitions(expected: DataFrame, landed: DataFrame,
                       keys=("CITY", "YEAR")) -> DataFrame:
    """Expected pairs without a single landed row."""
    return expected.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def attach_location(df: DataFrame, locations: DataFrame, key: str = "CITY") -> DataFrame:
    """Coordinates of each row's city; Spark broadcasts the dimension while it is small."""
    return df.join(locations, key, "left")


def enrich_irradiance(series: DataFrame, locations: DataFrame, ts: str = "DATETIME") -> DataFrame:
    """Raw hourly series with coordinates, position of the sun and optimal tilt."""
    placed = attach_location(series.drop("LATITUDE", "LONGITUDE"), locations)
    return with_solar_position(placed, ts, "LATITUDE", "LONGITUDE").withColumn(
        "OPTIMAL_TILT", optimal_tilt(F.col("SOLAR_ZENITH_ANGLE")))
