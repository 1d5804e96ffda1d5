"""Intermediate tables in the shared folder, and helpers every operator needs."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"  # a word: any run of characters that are not ASCII white space


#: For rows of megabytes. The writer holds a row group, and the reader brings all rows of one to
#: the heap at once; by default its size is looked at after 100 rows for the first time.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1"}


def stored(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the session's checkpoint folder and read it back.

    Cuts the lineage and keeps what was computed when an executor is lost. The
    table is deleted when the application ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """While this lasts, what is run sends Arrow batches of about ``limit`` bytes to Python, or
    less where the session says so. A batch is held outside of the heap and in the worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    default = int(re.match(r"\d+", before)[0]) if re.fullmatch(r"\d+b?", before, re.I) else None
    spark.conf.set(name, str(limit if default is None else min(limit, default)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, which grows with the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def empty_if_null(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (text or bytes) holds about ``limit``
    bytes in each. A single longer value is a slice of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package shipped to the Python workers, so that their
    module-level caches outlive a task."""
    _ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()  # workers are kept for later tasks

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Give memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library that cannot
        ctypes.CDLL(None).malloc_trim(0)


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    staging = tempfile.TemporaryDirectory(prefix="ship-")  # on the driver, which serves the file to the workers
    atexit.register(staging.cleanup)
    sc.addPyFile(shutil.make_archive(f"{staging.name}/{package.name}", "zip", package.parent, package.name))
    _shipped.add(sc.applicationId)
