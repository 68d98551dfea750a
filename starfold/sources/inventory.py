"""Dataset inventory: JSON documents to one row per dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.cells import content_hash

# The fields of an inventory entry and the names they may go by.
FIELDS = {
    "dataset_code": ("DatasetCode", "datasetCode", "code"),
    "dataset_name": ("DatasetName", "datasetName", "name"),
    "topic": ("Topic", "topic"),
    "dataset_description": ("DatasetDescription", "datasetDescription"),
    "contact": ("Contact", "contact"),
    "email": ("Email", "email"),
    "date_update": ("DateUpdate", "dateUpdate"),
    "compression_format": ("CompressionFormat", "compressionFormat"),
    "file_type": ("FileType", "fileType"),
    "file_location": ("FileLocation", "fileLocation", "URL"),
    "file_size": ("FileSize", "fileSize"),
    "file_rows": ("FileRows", "Rows"),
}
REQUIRED = ("dataset_code", "dataset_name")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Inventory files, one whole JSON document per row."""
    files = spark.read.option("wholetext", "true").text(path)
    return files.select(F.col("_metadata.file_path").alias("source_url"), "value")


def _pick(entry: str, names: tuple[str, ...]) -> Column:
    """First of the named fields that is neither missing nor empty, as trimmed text."""
    found = [F.nullif(F.try_variant_get(entry, f"$.{name}", "string"), F.lit("")) for name in names]
    return F.trim(F.coalesce(*found, F.lit(None).cast("string")))


def scan_inventory(documents: DataFrame) -> DataFrame:
    """Entries of inventory documents (source_url, value).

    The entries are found under ``Datasets.Dataset``, under ``Datasets``, or at the
    top; a single entry may stand without its list. Every entry is also kept whole.
    """
    parsed = documents.select(
        "source_url",
        content_hash(F.col("value")).alias("source_hash"),
        F.parse_json("value").alias("doc"),
    )
    # Step down one level where the document has it.
    inner = F.coalesce(F.try_variant_get("doc", "$.Datasets", "variant"), F.col("doc"))
    parsed = parsed.select("source_url", "source_hash", inner.alias("inner"))
    is_list = F.schema_of_variant("inner").startswith("ARRAY")
    entries = F.when(is_list, F.col("inner")).otherwise(
        F.try_variant_get("inner", "$.Dataset", "variant")
    )
    parsed = parsed.select("source_url", "source_hash", entries.alias("entries"))
    single = ~F.schema_of_variant("entries").startswith("ARRAY")
    listed = F.when(single, F.array("entries")).otherwise(
        F.try_variant_get("entries", "$", "array<variant>")
    )
    exploded = parsed.select("source_url", "source_hash", F.explode(listed).alias("entry"))
    columns = []
    for name, alternatives in FIELDS.items():
        value = _pick("entry", alternatives)
        if name == "file_rows":
            value = value.try_cast("bigint")
        elif name in REQUIRED:
            value = F.coalesce(value, F.lit(""))
        columns.append(value.alias(name))
    return exploded.select(
        *columns, F.to_json("entry").alias("raw_json"), "source_url", "source_hash"
    )
