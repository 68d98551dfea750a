"""Download manifest: an append-only log of JSON lines, last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.merge import latest_state

# The fields of a manifest line.
SCHEMA = """
    dataset_code string, state string, archive_path string, archive_sha256 string,
    url string, expected_size string, expected_rows bigint, attempts bigint,
    error string, downloaded_at string, updated_at string
"""
FIELDS = [part.split()[0] for part in SCHEMA.split(",")][1:]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the log with its place in it; unknown keys and blank lines are skipped.

    Place is the file's time, then the block and the row inside the scan, which follow
    the order of the lines.
    """
    rows = spark.read.schema(SCHEMA).json(path).where("dataset_code IS NOT NULL")
    place = F.struct(
        F.col("_metadata.file_modification_time"),
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return rows.withColumn("place", place)


def current_states(log: DataFrame, order: str = "place") -> DataFrame:
    """Latest whole entry per dataset; every line of the log is a full entry."""
    return latest_state(log, "dataset_code", order, FIELDS, [])


def carried_states(changes: DataFrame, order: str) -> DataFrame:
    """Latest state per dataset of a log of partial changes.

    A field that a change leaves out (NULL) keeps its last value.
    """
    return latest_state(changes, "dataset_code", order, ["state"], [f for f in FIELDS if f != "state"])
