"""Declared schemas of the raw inputs; timestamps of the plants stay text until parsed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solarspark.fixed_values import LOCATIONS

GENERATION = T.StructType([
    T.StructField("DATE_TIME", T.StringType()),
    T.StructField("PLANT_ID", T.IntegerType()),
    T.StructField("SOURCE_KEY", T.StringType()),
    T.StructField("DC_POWER", T.DoubleType()),
    T.StructField("AC_POWER", T.DoubleType()),
    T.StructField("DAILY_YIELD", T.DoubleType()),
    T.StructField("TOTAL_YIELD", T.DoubleType()),
])

WEATHER = T.StructType([
    T.StructField("DATE_TIME", T.StringType()),
    T.StructField("PLANT_ID", T.IntegerType()),
    T.StructField("SOURCE_KEY", T.StringType()),
    T.StructField("AMBIENT_TEMPERATURE", T.DoubleType()),
    T.StructField("MODULE_TEMPERATURE", T.DoubleType()),
    T.StructField("IRRADIATION", T.DoubleType()),
])

IRRADIANCE = T.StructType([
    T.StructField("DATETIME", T.TimestampType()),
    T.StructField("ghi", T.DoubleType()),
    T.StructField("dhi", T.DoubleType()),
    T.StructField("dni", T.DoubleType()),
    T.StructField("temp_air", T.DoubleType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("CITY", T.StringType()),
    T.StructField("LATITUDE", T.DoubleType()),
    T.StructField("LONGITUDE", T.DoubleType()),
    T.StructField("YEAR", T.IntegerType()),
    T.StructField("SOLAR_ZENITH_ANGLE", T.DoubleType()),
    T.StructField("SOLAR_AZIMUTH", T.DoubleType()),
    T.StructField("OPTIMAL_TILT", T.DoubleType()),
])

LOCATION = T.StructType([
    T.StructField("CITY", T.StringType(), False),
    T.StructField("LATITUDE", T.DoubleType(), False),
    T.StructField("LONGITUDE", T.DoubleType(), False),
])


def locations(spark: SparkSession, rows=None) -> DataFrame:
    """The location dimension, CITY to coordinates."""
    return literal_rows(spark, LOCATIONS if rows is None else rows, LOCATION)


def literal_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A few constant rows whose size the planner knows, so that joins broadcast them."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
