"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from casewright.session import run_folder


#: Rows of one slice of an Arrow batch.
SLICE_ROWS = 512


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over slices of the batches; at its end the worker, which Spark uses again,
    gives freed memory back to the system."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS))
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except OSError:  # another C library: nothing to trim
            pass
    return body


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python workers in batches of ``SLICE_ROWS``, unless the session names a number.

    The default of 10 000 whole texts is held twice while a batch grows, outside the heap, and once more in the worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(SLICE_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` as a Parquet table in the shared folder.

    Cuts the lineage without keeping blocks on executors, so a lost executor costs no more
    than its running tasks, and fixes columns that depend on how a scan was split.
    """
    folder = run_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    table = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    table.written_folder = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Remove what ``written`` wrote, once nothing reads it any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_folder)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fold(key: Column, parts: int) -> Column:
    """``crc32(key as text) mod parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def hash_cut(bound: int, count: int) -> int:
    """The 64-bit hash up to which about ``bound`` of ``count`` rows lie."""
    return min((1 << 63) - 1, (bound << 64) // max(1, count) - (1 << 63))


def running_total(rows: DataFrame, order: Sequence[Column], value: str, out: str, purpose: str) -> DataFrame:
    """Add ``out``: the total of ``value`` up to and including each row in ``order``.

    A range sort deals the rows out, each range sums its rows, and a window over one row
    per range gives the bases. No task sees more than one range. ``order`` should be
    unique but for rows that are alike.
    """
    ranged = written(
        rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), purpose
    )
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    # One row per range: as many as there are shuffle partitions.
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(bases), "_range")
        .withColumn(out, F.col("_base") + F.sum(value).over(within))
        .drop("_range", "_base")
    )
