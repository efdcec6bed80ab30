"""Small helpers the text operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows are handed to Python in steps of so many characters at most.
STEP_CHARS = 8_000_000

#: So many 64-bit keys at most are sent to all tasks.
FEW_KEYS = 1_000_000

#: Texts go to Python, and come from files, so many at a time where ``few_at_once`` was called.
TEXTS_AT_ONCE = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def learnable(doc_id: str = "doc_id") -> Column:
    """True for documents whose labels may be learned from; the others are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is computed inside are deleted as soon as it is done."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_at_once(spark: SparkSession, rows: int = TEXTS_AT_ONCE) -> None:
    """From now on the session hands over ``rows`` rows at a time, unless it has less already.

    With thousands of texts a batch, each task holds them several times over outside the heap
    and in Python, and the executor's heap grows by arrays of that size.
    """
    for name in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
        if not 0 < int(spark.conf.get(name)) <= rows:
            spark.conf.set(name, rows)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut.

    The table is compressed well and deleted when the application ends; shuffle files that
    it took go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    with shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def free(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of shuffle files of what has been computed since without being staged.

    Spark deletes them when the driver collects its garbage, which may be long after.
    """
    spark.sparkContext._jvm.System.gc()


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``gone``, which is computed once.

    Up to ``FEW_KEYS`` numbers are sent to all tasks, so that the texts stay where they are;
    more are met by a shuffle.
    """
    gone = staged(gone)
    return docs.join(F.broadcast(gone) if gone.count() <= FEW_KEYS else gone, key, "left_anti")


_kept: dict = {}


def kept(operator: str) -> dict:
    """What the tasks of an operator leave in their Python process for its next tasks.

    Processes outlive operators, so what another one left is let go here.
    """
    if _kept.get("operator") != operator:
        _kept.clear()
        _kept.update(operator=operator, held={})
    return _kept["held"]


def bit_table(df: DataFrame, mark: str, bits: int):
    """Broadcast table of 2**bits bits, those at the first ``bits`` bits of every ``mark`` set.

    The driver gets 2**(bits - 5) numbers at most, however many rows there are.
    """
    place = F.shiftrightunsigned(mark, 64 - bits)
    rows = df.select(place.alias("p")).groupBy(F.shiftright("p", 5).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(p & 31 as int))")).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 5), np.int32)
    words[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return df.sparkSession.sparkContext.broadcast(words.astype("<i4").tobytes())


def unpacked(table) -> np.ndarray:
    """The bits of a broadcast table as booleans."""
    return np.unpackbits(np.frombuffer(table.value, np.uint8), bitorder="little").view(bool)


def steps(batches: Iterator[pa.RecordBatch], sizes_of: str = "text",
          limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded text, whatever size Spark hands over.

    A batch always has one row at least, so that a very long text is its own batch.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(sizes_of)).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if len(lengths) > start:
            yield batch.slice(start, len(lengths) - start)


def map_texts(df: DataFrame, work: Callable[[list], list[tuple]], keep: list[str], schema: str,
              text: str = "text") -> DataFrame:
    """One row of results for every row; ``work`` maps a list of texts (null: "") to rows.

    ``keep`` columns pass through and come first; ``schema`` declares kept and new columns.
    """
    names = [c for c in keep]

    def run(batches):
        for batch in steps(batches, text):
            rows = work([t or "" for t in batch.column(text).to_pylist()])
            columns = [batch.column(c) for c in names]
            columns += [pa.array(c, type=t) for c, t in zip(zip(*rows), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=all_names)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    fields = _parse_datatype_string(schema).fields
    all_names = [f.name for f in fields]
    types = [to_arrow_type(f.dataType) for f in fields[len(names):]]
    return df.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)
