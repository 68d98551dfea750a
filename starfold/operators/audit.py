"""Audits: size, member choice, losslessness, summaries, re-fetch decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import size_in_bytes

# Fixed values of the contract.
REUSABLE_STATES = ("downloaded", "zip_valid", "importing", "imported")


def size_matches(actual: Column, declared: Column, tolerance: float = 0.0) -> Column:
    """Size check against a declaration; an unknown declaration passes."""
    fits = actual == declared if tolerance <= 0 else F.abs(actual - declared) <= declared * tolerance
    return F.when(declared.isNull(), F.lit(True)).otherwise(fits)


def size_check(files: DataFrame, inventory: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Compare files (dataset_code, length) with an inventory (…, declared_bytes)."""
    joined = files.join(inventory.select("dataset_code", "declared_bytes"), "dataset_code", "left")
    verdict = size_matches(F.col("length"), F.col("declared_bytes"), tolerance)
    return joined.select("dataset_code", "length", "declared_bytes", verdict.alias("size_ok"))


def _first_member(members: DataFrame, rank: list[Column], ties: list[str], kept: list[str]) -> DataFrame:
    """Best member per archive by a partial aggregate, so a huge archive is no hot task."""
    order = [c.alias(f"r{i}") for i, c in enumerate(rank)]
    best = F.min(F.struct(*order, *ties, *[c for c in kept if c not in ties])).alias("best")
    chosen = members.groupBy("archive").agg(best)
    return chosen.select("archive", *[F.col(f"best.{c}").alias(c) for c in kept])


def is_csv(name: Column) -> Column:
    return F.lower(name).endswith(".csv")


def pick_main_member(members: DataFrame, ties: list[str], kept: list[str]) -> DataFrame:
    """Largest CSV of every archive, the first one on a tie."""
    return _first_member(members.where(is_csv(F.col("name"))), [-F.col("size")], ties, kept)


def pick_flag_member(members: DataFrame, ties: list[str], kept: list[str]) -> DataFrame:
    """Smallest CSV whose path contains ``flag``, the first one on a tie."""
    legends = members.where(is_csv(F.col("name")) & F.lower("name").contains("flag"))
    return _first_member(legends, [F.col("size")], ties, kept)


def lossless(imported: Column, source: Column, filtered: Column) -> Column:
    """A filtered import is lossless by design; any other must hold every source row."""
    return filtered | (imported == source)


def lossless_verdict(datasets: DataFrame) -> DataFrame:
    """Verdict per dataset; the difference to the declared rows is only advice."""
    imported, declared = F.col("rows_imported"), F.col("file_rows_declared")
    verdict = lossless(imported, F.col("source_csv_rows"), F.col("is_filtered"))
    return datasets.select(
        "dataset_code",
        "rows_imported",
        "source_csv_rows",
        verdict.alias("is_lossless"),
        (imported - declared).alias("declared_difference"),
    )


def build_summary(datasets: DataFrame, builds: DataFrame) -> DataFrame:
    """Imported and failed datasets next to the latest build, in one aggregate."""
    rows = datasets.select("import_status").unionByName(
        builds.select("build_id", "completed_at"), allowMissingColumns=True
    )
    is_build, status = F.col("build_id").isNotNull(), F.col("import_status")
    latest = F.max(F.when(is_build, F.struct("completed_at", "build_id")))
    return rows.agg(
        F.count_if(status == "imported").alias("datasets_imported"),
        F.count_if(status != "imported").alias("datasets_failed"),
        latest.alias("latest"),
    ).select("datasets_imported", "datasets_failed", "latest.build_id", "latest.completed_at")


def validate_facts(counts: DataFrame) -> DataFrame:
    """Fact tables without a row, out of (table_name, row_count)."""
    facts = counts.where(F.col("table_name").startswith("data_"))
    return facts.where("row_count = 0").select("table_name", F.lit("empty").alias("problem"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row count of every table, ordered by name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.orderBy("table_name")


def needs_refetch(inventory: DataFrame, states: DataFrame, files: DataFrame) -> DataFrame:
    """Datasets to fetch again: no record, no file, or a state that is not reusable."""
    joined = inventory.join(states.select("dataset_code", "state"), "dataset_code", "left").join(
        files.select("dataset_code", F.lit(True).alias("on_disk")), "dataset_code", "left"
    )
    reusable = F.coalesce(F.col("state").isin(*REUSABLE_STATES), F.lit(False)) & F.col("on_disk").isNotNull()
    return joined.select("dataset_code", (~reusable).alias("needs_fetch"))


def selection_estimate(inventory: DataFrame) -> DataFrame:
    """Datasets, bytes and declared rows of a selection; unknown figures count zero."""
    size = F.coalesce(size_in_bytes(F.col("file_size")), F.lit(0))
    rows = F.coalesce(F.col("file_rows"), F.lit(0))
    return inventory.agg(
        F.count(F.lit(1)).alias("datasets"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def rows_per_dataset(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dataset_code").agg(F.count(F.lit(1)).alias("n"))


def recent_datasets(datasets: DataFrame, n: int = 10) -> DataFrame:
    """The last updated datasets, newest first, as a top-k."""
    return datasets.orderBy(F.desc("date_update"), "dataset_code").limit(n)
