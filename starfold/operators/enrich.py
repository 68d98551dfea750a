"""Enrichment from a curated lookup, kept apart from source content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import blank_to_null


def label_key(label: Column) -> Column:
    return F.lower(F.trim(label))


def curated_keys(lookup: DataFrame) -> DataFrame:
    """The lookup file (area_name, is_country, valid_from, valid_to) by label key."""
    return lookup.select(
        label_key(F.col("area_name")).alias("_key"),
        F.col("is_country").cast("string").try_cast("boolean").alias("_is_country"),
        blank_to_null(F.col("valid_from").cast("string")).try_cast("int").alias("_from"),
        blank_to_null(F.col("valid_to").cast("string")).try_cast("int").alias("_to"),
    )


def classify_areas(dim_area: DataFrame, lookup: DataFrame) -> DataFrame:
    """Classification per area code, by any of its label variants.

    The label that matched represents the code, else the greatest label. A code with
    no match keeps NULL; nothing is guessed. The join runs on distinct areas, so its
    size is that of the dimension and not of the facts.
    """
    has_label = "area_label" in dim_area.columns
    label = F.col("area_label") if has_label else F.lit(None).cast("string").alias("area_label")
    areas = dim_area.where("area_code IS NOT NULL").select("area_code", label).distinct()
    matched = areas.join(
        curated_keys(lookup).select("_key", "_is_country"),
        label_key(F.col("area_label")) == F.col("_key"),
        "left",
    )
    return (
        matched.groupBy("area_code")
        .agg(
            F.expr("coalesce(max(area_label) FILTER (WHERE _key IS NOT NULL), max(area_label))").alias(
                "area_label"
            ),
            F.bool_or("_is_country").alias("is_country"),
        )
        .select(
            F.col("area_code").try_cast("int").alias("area_code"),
            "area_label",
            "is_country",
            F.lit(None).cast("int").alias("valid_from"),
            F.lit(None).cast("int").alias("valid_to"),
        )
    )


def fill_validity(classified: DataFrame, lookup: DataFrame) -> DataFrame:
    """Set both validity bounds where the representative label has a dated entry."""
    dated = curated_keys(lookup).where("_from IS NOT NULL OR _to IS NOT NULL")
    # One dated entry per label, so that a repeated entry cannot repeat an area.
    dated = dated.groupBy("_key").agg(
        F.min(F.struct("_from", "_to")).alias("_bounds"),
    )
    joined = classified.join(dated, label_key(F.col("area_label")) == F.col("_key"), "left")
    found = F.col("_key").isNotNull()
    return joined.select(
        "area_code",
        "area_label",
        "is_country",
        F.when(found, F.col("_bounds._from")).otherwise(F.col("valid_from")).alias("valid_from"),
        F.when(found, F.col("_bounds._to")).otherwise(F.col("valid_to")).alias("valid_to"),
    )


def validity_coverage(classified: DataFrame) -> DataFrame:
    """Number of areas that carry a validity bound."""
    dated = F.col("valid_from").isNotNull() | F.col("valid_to").isNotNull()
    return classified.agg(F.count_if(dated).alias("dated_areas"))
