"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from solarspark.session import scratch_path


def write_dataset(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    """Parquet; partition columns are rebalanced first.

    Rebalancing gives each partition value few files of even size: small values
    are put together in a task and large ones are split over several.
    """
    partition_by = list(partition_by)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def land_irradiance(series: DataFrame, path: str) -> None:
    """Landing zone of the hourly series, a folder per city and year.

    Loading a city and year again replaces it; all others stay.
    """
    series = series.hint("rebalance", "CITY", "YEAR")
    (series.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("CITY", "YEAR").parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, a file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_city_files(series: DataFrame, folder: str) -> None:
    """CSV files named City_Year_part.csv with the hourly series of a city and year.

    The columns CITY and YEAR go into the names. Files of other cities and years stay; large
    ones are written in several parts.
    """
    spark = series.sparkSession
    parts = scratch_path(spark)
    (series.hint("rebalance", "CITY", "YEAR").write.option("header", True)
     .partitionBy("CITY", "YEAR").csv(parts))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(folder))
    found = system.globStatus(hadoop.Path(f"{parts}/CITY=*/YEAR=*/*.csv"))
    for i in range(len(found)):
        path = found[i].getPath()
        year, city = path.getParent(), path.getParent().getParent()
        name = f"{city.getName().removeprefix('CITY=')}_{year.getName().removeprefix('YEAR=')}_{i}.csv"
        system.rename(path, hadoop.Path(f"{folder}/{name}"))
    system.delete(hadoop.Path(parts), True)
