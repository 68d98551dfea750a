"""Small helpers the operators share: reading tables, defined null handling, sums in order."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.session import shared_dir, ship_by_value

ship_by_value(__name__)

#: Java pattern of a word in the contracts: a run of anything but these six bytes.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(text: Column) -> Column:
    """Words of a text without nulls, counted without building an array of them."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the one that all executors share."""
    return f"{shared_dir(spark)}/starfold-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lost executors don't lose it."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(
    task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task function after which its Python worker gives free memory back to the system.

    Spark keeps workers for later tasks. What their allocators hold would else count
    against the executor while other stages run, also those without Python.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run


def local_path(uri: str) -> str | None:
    """The plain path of a file: URI or path, None for another file system."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri if "://" not in uri else None


def file_system(uri: str):
    """(pyarrow file system, path) of a folder that every executor can reach.

    s3a and s3n are the Hadoop names of what pyarrow calls s3.
    """
    from pyarrow import fs

    local = local_path(uri)
    if local is not None:
        return fs.LocalFileSystem(), local
    for name in ("s3a://", "s3n://"):
        if uri.startswith(name):
            uri = "s3://" + uri[len(name) :]
    return fs.FileSystem.from_uri(uri)


#: Rows of a table that may be broadcast: a few megabytes of narrow rows.
BROADCAST_ROWS = 20_000


def small_if_proven(df: DataFrame) -> DataFrame:
    """Hint a broadcast of a stored, narrow table only if it has been counted to be small.

    A larger one joins by shuffle, where AQE splits hot keys.
    """
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def running_before(
    df: DataFrame, group: str, order: list[str], value: str, rows_per_cell: int = 4096
) -> DataFrame:
    """Add ``<value>_before``: the sum of a value over the group's earlier rows.

    No task sorts a whole group. Rows are dealt to cells by the leading order column, a
    long that is spread evenly over 0 .. 2^62 (column ``order[0]``); cells are summed
    first, then the rows inside each. The number of cells follows the number of rows, so
    a group that holds all of them has rows_per_cell rows in a cell.
    """
    cells = max(1, df.count() // rows_per_cell)
    rows = df.withColumn("_cell", F.expr(f"{order[0]} div {(1 << 62) // cells + 1}"))
    sums = rows.groupBy(group, "_cell").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        group, "_cell", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    )
    inside = (
        Window.partitionBy(group, "_cell")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_base")
    return (
        rows.join(bases, [group, "_cell"])
        .withColumn(f"{value}_before", before.cast("long"))
        .drop("_cell", "_base")
    )
