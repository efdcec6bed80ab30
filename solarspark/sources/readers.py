"""Readers of the raw CSV sources and of datasets written by this library."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from solarspark.fixed_values import IRRADIANCE_EXCLUDE, IRRADIANCE_GLOB
from solarspark.operators.lookup import join_aggregate
from solarspark.operators.quarantine import MALFORMED, SOURCE_FILE
from solarspark.schemas import GENERATION, IRRADIANCE, WEATHER
from solarspark.session import require_utc


def _csv(spark: SparkSession, schema: StructType, paths, keep_malformed: bool, **options) -> DataFrame:
    # Headers are compared with the schema, so a file with other columns in other
    # places fails instead of being read by position.
    reader = spark.read.option("header", True).option("enforceSchema", False).options(**options)
    if not keep_malformed:
        return reader.schema(schema).csv(paths)
    # Only values that a query reads are parsed, and only those are seen to be malformed. So
    # the raw line is tied to all columns: a line without any value counts as well formed.
    held = StructType([*schema, StructField(MALFORMED, StringType())])
    empty = reduce(Column.__and__, [F.col(c).isNull() for c in schema.names])
    return (reader.schema(held).option("columnNameOfCorruptRecord", MALFORMED).csv(paths)
            .withColumns({MALFORMED: F.nullif(F.coalesce(MALFORMED, F.when(empty, F.lit(""))), F.lit("")),
                          SOURCE_FILE: F.col("_metadata.file_name")}))


def read_generation(spark: SparkSession, paths, keep_malformed: bool = False) -> DataFrame:
    """Inverter readings of all plants in one scan; timestamps stay text.

    A value that does not fit its type is NULL. ``keep_malformed`` adds the raw line of such
    rows and the file of all rows, for ``operators.quarantine``.
    """
    return _csv(spark, GENERATION, paths, keep_malformed)


def read_weather(spark: SparkSession, paths, keep_malformed: bool = False) -> DataFrame:
    """Plant sensor readings in one scan; timestamps stay text. See ``read_generation``."""
    return _csv(spark, WEATHER, paths, keep_malformed)


def with_file_partition(df: DataFrame) -> DataFrame:
    """CITY and YEAR taken from a file named City_Year.csv."""
    name = F.col("_metadata.file_name")
    return df.withColumns({
        "CITY": F.regexp_extract(name, r"^([^_]*)_", 1),
        "YEAR": F.regexp_extract(name, r"^[^_]*_(\d+)", 1).cast("int"),
    })


def _wanted_files(df: DataFrame) -> DataFrame:
    return df.filter(~F.contains(F.col("_metadata.file_name"), F.lit(IRRADIANCE_EXCLUDE)))


def read_irradiance(spark: SparkSession, folder: str, by_header: bool = False,
                    keep_malformed: bool = False) -> DataFrame:
    """Hourly irradiance of every City_Year.csv in ``folder``; times are UTC instants.

    All files are one scan when their headers agree. With ``by_header`` every file is read
    by its own header and columns go by name; those a file lacks become NULL. Only the
    distinct headers come to the driver, however many files there are. Headers then have to
    be plain and values must not hold line breaks. ``keep_malformed`` is that of
    ``read_generation``.
    """
    require_utc(spark)
    if not by_header:
        scan = _csv(spark, IRRADIANCE, folder, keep_malformed, pathGlobFilter=IRRADIANCE_GLOB)
        return with_file_partition(_wanted_files(scan))
    lines = _wanted_files(spark.read.option("pathGlobFilter", IRRADIANCE_GLOB).text(folder))
    lines = with_file_partition(lines).select(
        "value", "CITY", "YEAR", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("start"))
    # The first block of a file is read by one task from its first line on.
    heads = lines.filter("start = 0").groupBy("path").agg(F.first("value").alias("header"))
    headers = [r["header"] for r in heads.select("header").distinct().orderBy("header").collect()]
    kept = [MALFORMED, SOURCE_FILE] if keep_malformed else []
    if not headers:
        return spark.createDataFrame([], StructType([*IRRADIANCE, *[StructField(c, StringType()) for c in kept]]))
    known = {f.name: f for f in IRRADIANCE}
    schemas = {}
    for header in headers:
        schema = StructType()
        for name in header.split(","):
            schema = schema.add(known[name]) if name in known else schema.add(name, "string")
        schemas[header] = schema
    extra = list(dict.fromkeys(n for s in schemas.values() for n in s.names if n not in known))
    rows = join_aggregate(lines, heads, "path", "inner").filter("value <> header")

    def column(name: str, kind: str):
        held = F.lit(None).cast(kind)
        for header, schema in schemas.items():
            if name in schema.names:
                held = F.when(F.col("header") == header, F.col(f"r{headers.index(header)}").getField(name)).otherwise(held)
        return held.alias(name)

    for i, header in enumerate(headers):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas[header])
        options = {"mode": "PERMISSIVE"}
        if keep_malformed:
            fields, options = f"{fields}, {MALFORMED} string", {**options, "columnNameOfCorruptRecord": MALFORMED}
        rows = rows.withColumn(f"r{i}", F.when(F.col("header") == header, F.from_csv("value", fields, options)))
    if keep_malformed:
        rows = rows.withColumn(MALFORMED, F.coalesce(*[F.col(f"r{i}.{MALFORMED}") for i in range(len(headers))]))
    from_name = [n for n in ("CITY", "YEAR") if n not in known]
    return rows.select(*[F.col(n) if n in ("CITY", "YEAR") else column(n, known[n].dataType.simpleString())
                         for n in IRRADIANCE.names], *from_name, *[column(n, "string") for n in extra
                                                                   if n not in ("CITY", "YEAR")], *kept)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_if_exists(read) -> DataFrame | None:
    """Result of a reader call, or None where its path is absent."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
