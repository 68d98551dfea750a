"""Curated lookup and flag legend files: small all-text CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.cells import col
from starfold.functions.headers import normalise_names
from starfold.operators.merge import flag_legend, legend_columns
from starfold.sources.csv_files import csv_header, scan_csv, source_facts

# Header of the curated area lookup.
LOOKUP_COLUMNS = ["area_name", "is_country", "valid_from", "valid_to"]


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The curated area lookup, all text, blank cells NULL."""
    facts = source_facts(spark, path)
    names = csv_header(spark, path, facts.encoding)
    return scan_csv(spark, path, names, facts.encoding, facts.has_multi_line).select(*LOOKUP_COLUMNS)


def legend_rows(rows: DataFrame) -> DataFrame | None:
    """Rows as (flag_code, flag_description) by header rules, or None if unclear."""
    chosen = legend_columns(rows.columns)
    if chosen is None:
        return None
    code, description = chosen
    text = col(description) if description else F.lit(None).cast("string")
    return rows.select(col(code).alias("flag_code"), text.alias("flag_description"))


def read_flag_legend(spark: SparkSession, path: str, dataset_code: str) -> DataFrame | None:
    """Flag legend of one dataset, one description per code."""
    facts = source_facts(spark, path)
    names = normalise_names(csv_header(spark, path, facts.encoding))
    rows = legend_rows(scan_csv(spark, path, names, facts.encoding, facts.has_multi_line))
    return None if rows is None else flag_legend(rows, dataset_code)
