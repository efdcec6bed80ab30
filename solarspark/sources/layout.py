"""Tables whose files are laid out by a key, so that joins and checks on it need no shuffle."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from solarspark.session import stage

# Rows of a bucket, about. Tables that are joined must have one number of buckets.
ROWS_PER_BUCKET = 1_000_000


def _name(path: str) -> str:
    return "laid_out_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def buckets_for(rows: int) -> int:
    """A power of two, so that tables of similar size often have the same."""
    return 1 << max(0, (max(rows, 1) - 1) // ROWS_PER_BUCKET).bit_length()


def write_by_key(df: DataFrame, path: str, keys, buckets: int) -> None:
    """Parquet with the rows of a key in one of ``buckets`` files, sorted by it; replaces what is there.

    The shuffle before the write is the one that joins on the key no longer need. Equal keys
    share a task, so the key should be one that no value of dominates.
    """
    spark, keys = df.sparkSession, list(keys)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(_name(path)))


def open_by_key(spark: SparkSession, path: str, keys, buckets: int) -> DataFrame:
    """A table written so, in this or another session, with its layout known to the planner."""
    if not spark.catalog.tableExists(_name(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by})"
                  f" INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_name(path))


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def newest(spark: SparkSession, path: str) -> int | None:
    """Buckets of the rows held under ``path`` by ``add_by_month``; none where nothing is whole."""
    former, system = _hadoop(spark, f"{path}/rows")
    if system.exists(former):
        raise ValueError(f"{path} has a former layout; land its rows into a new store")
    whole = system.globStatus(_hadoop(spark, f"{path}/rows-*/_SUCCESS")[0])
    return max((int(f.getPath().getParent().getName().removeprefix("rows-")) for f in whole or []), default=None)


def _declare(spark: SparkSession, folder: str, schema, keys, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "MONTH")
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {_name(folder)} ({columns}, MONTH int) USING parquet PARTITIONED BY (MONTH)"
              f" CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'")


def open_by_month(spark: SparkSession, path: str, buckets: int, keys) -> DataFrame:
    """Rows that ``add_by_month`` put there, in this or another session, with their layout known."""
    folder = f"{path}/rows-{buckets}"
    if not spark.catalog.tableExists(_name(folder)):
        _declare(spark, folder, spark.read.parquet(folder).schema, keys, buckets)
    spark.sql(f"ALTER TABLE {_name(folder)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(_name(folder))
    return spark.table(_name(folder))


def add_by_month(df: DataFrame, path: str, buckets: int, keys, fresh: bool = False) -> None:
    """Add rows dealt by ``keys`` to as many tasks as buckets; with ``fresh`` in place of what is there.

    Parquet by MONTH and within it by bucket, without another shuffle. Rows that were added
    before may be read meanwhile.
    """
    spark, folder = df.sparkSession, f"{path}/rows-{buckets}"
    if fresh:
        spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
        _declare(spark, folder, df.schema, keys, buckets)
    df.select(*spark.table(_name(folder)).columns).write.insertInto(_name(folder), overwrite=fresh)


def add_buckets(spark: SparkSession, path: str, buckets: int, more: int, keys) -> None:
    """Lay the rows under ``path`` out anew in more buckets; the former files go when that is done."""
    rows = open_by_month(spark, path, buckets, keys)
    add_by_month(rows.repartition(more, *keys), path, more, keys, fresh=True)
    spark.sql(f"DROP TABLE {_name(f'{path}/rows-{buckets}')}")
    folder, system = _hadoop(spark, f"{path}/rows-{buckets}")
    system.delete(folder, True)


def lay_out_together(tables: dict[str, DataFrame], folder: str, keys, buckets: int | None = None) -> int:
    """Write frames that will be joined on ``keys`` with one number of buckets, which is returned.

    Without ``buckets`` the frames are staged and counted first.
    """
    if buckets is None:
        tables = {name: stage(df) for name, df in tables.items()}
        buckets = buckets_for(max(df.count() for df in tables.values()))
    for name, df in tables.items():
        write_by_key(df, f"{folder}/{name}", keys, buckets)
    return buckets
