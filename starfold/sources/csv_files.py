"""CSV files: encoding audit, header, all-text scan, record counts."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions.cells import blank_to_null, col
from starfold.session import materialise
from starfold.sources.records import whole_records
from starfold.sources.utf16 import utf16_counts

UTF8, UTF16, LATIN1 = "utf-8", "utf-16", "latin-1"
SPARK_ENCODING = {UTF8: "UTF-8", UTF16: "UTF-16", LATIN1: "ISO-8859-1"}


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines of files, split at line feeds only, with their raw bytes."""
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)


def path_value(partition: str) -> Column:
    """Value of a ``partition=value`` folder in the path of a file, as it was written.

    The path is URI-encoded over the escapes of the folder name itself.
    """
    value = F.regexp_extract("_metadata.file_path", f"/{partition}=([^/]+)/", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return value


def _has_utf16_mark(value: Column) -> Column:
    """A UTF-16 byte order mark (FF FE or FE FF) before text that holds NUL bytes."""
    head = F.substring(value.cast("binary"), 1, 2)
    marked = head.isin(F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF")))
    return marked & value.contains(F.lit("\x00"))


def _odd_quotes(value: Column) -> Column:
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    return quotes % 2 == 1


def file_facts(spark: SparkSession, path: str | list[str], label: Column | None = None) -> DataFrame:
    """What one splittable line scan tells about every file.

    ``encoding``: UTF-16 by its mark, UTF-8 if all bytes are valid, else Latin-1. The
    mark counts in the first block of a file only, and only before NUL bytes, which
    every UTF-16 line with a separator holds and no Latin-1 text does.
    ``physical_rows``: lines less the header, never below zero.
    ``has_multi_line``: some line holds an odd number of quotes, so a quoted cell may
    run over its end, or a carriage return that does not end it, where the CSV reader
    would end a record. A file without such lines is read by the plain CSV reader. Lines
    and cells of UTF-16 files are counted by code unit.
    """
    inner_return = F.rtrim("value", F.lit("\r")).contains("\r")
    lines = _lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        *([label.alias("label")] if label is not None else []),
        F.is_valid_utf8("value").alias("valid"),
        ((F.col("_metadata.file_block_start") == 0) & _has_utf16_mark(F.col("value"))).alias("mark"),
        (_odd_quotes(F.col("value")) | inner_return).alias("odd"),
    )
    found = lines.groupBy("file", *(["label"] if label is not None else [])).agg(
        F.bool_or("mark").alias("mark"),
        F.bool_and("valid").alias("valid"),
        (F.count(F.lit(1)) - 1).alias("physical_rows"),
        F.bool_or("odd").alias("has_multi_line"),
    )
    encoding = F.when(F.col("mark"), UTF16).when(F.col("valid"), UTF8).otherwise(LATIN1)
    found = materialise(found.withColumn("encoding", encoding).drop("mark", "valid"), "file-facts")
    units = _units(spark, found)
    if units is None:
        return found
    lines, multi = F.coalesce("_lines", "physical_rows"), F.coalesce("_multi", "has_multi_line")
    counted = found.join(units, "file", "left").withColumns({"physical_rows": lines, "has_multi_line": multi})
    return counted.drop("_lines", "_records", "_multi")


def _units(spark: SparkSession, facts: DataFrame) -> DataFrame | None:
    """(file, _lines, _records, _multi) of the UTF-16 files among all, None if there are none."""
    paths = [r["file"] for r in facts.where(F.col("encoding") == UTF16).select("file").collect()]
    if not paths:
        return None
    counts = utf16_counts(spark, [unquote(path) for path in paths])
    multi = (F.col("lines") != F.col("records")).alias("_multi")
    return counts.select("file", F.col("lines").alias("_lines"), F.col("records").alias("_records"), multi)


@dataclass(frozen=True)
class SourceFacts:
    """Facts of the file or files of one dataset, taken together."""

    encoding: str
    physical_rows: int
    has_multi_line: bool


def source_facts(spark: SparkSession, path: str) -> SourceFacts:
    row = (
        file_facts(spark, path)
        .agg(
            F.collect_set("encoding").alias("encodings"),
            F.coalesce(F.sum("physical_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.bool_or("has_multi_line"), F.lit(False)).alias("multi"),
        )
        .first()
    )
    encodings = [e for e in (UTF16, LATIN1) if e in row["encodings"]]
    if len(row["encodings"]) > 1 and UTF16 in row["encodings"]:
        raise ValueError(f"files of {path} mix UTF-16 with other encodings")
    return SourceFacts(encodings[0] if encodings else UTF8, row["rows"], row["multi"])


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    return (
        spark.read.option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", SPARK_ENCODING[encoding])
        .option("mode", "FAILFAST")
        .option("enforceSchema", "true")
        # A UTF-16 line feed is two bytes, which only whole-file reading splits right.
        .option("multiLine", str(multi_line or encoding == UTF16).lower())
    )


def csv_header(spark: SparkSession, path: str, encoding: str = UTF8) -> list[str]:
    """Header names as written, repeats included, read from the head of the file."""
    plain = _reader(spark, encoding, True).option("header", "false").csv(path)
    return [name or "" for name in plain.first()]


def scan_csv(
    spark: SparkSession, path: str, names: list[str], encoding: str = UTF8, multi_line: bool = True
) -> DataFrame:
    """Every cell as text under the given names; an empty cell, quoted or not, is NULL.

    Where cells run over lines, records are put together from lines first and then parsed
    one by one, so that such files are read in splits too. Only UTF-16 files are parsed
    whole, one task each.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if multi_line and encoding != UTF16:
        raw = F.decode("record", SPARK_ENCODING[encoding])
        text = whole_records(_numbered_lines(spark, path)).select(F.rtrim(raw, F.lit("\r")).alias("record"))
        options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
        parsed = F.from_csv("record", F.lit(", ".join(f"c{i} string" for i in range(len(names)))), options)
        rows = text.where(F.trim("record") != "").select(parsed.alias("cells"))
        return rows.select(*[blank_to_null(F.col(f"cells.c{i}")).alias(n) for i, n in enumerate(names)])
    rows = _reader(spark, encoding, multi_line).schema(schema).csv(path)
    return rows.select(*[blank_to_null(col(n)).alias(n) for n in names])


def _numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line, odd) of the lines of each block of files, in their order."""
    return _lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
        _odd_quotes(F.col("value")).alias("odd"),
    )


def record_counts(spark: SparkSession, path: str | list[str], label: Column | None = None) -> DataFrame:
    """(file[, label], records) less the header, by the parity of quotes alone.

    A record ends at a line feed before which the file has an even number of quotes. It
    shares nothing with the CSV reader, so it can contradict it. Parities are summed for
    each block of a file first, then for the lines inside; no task holds a file. Bytes
    count, so this is for any encoding but UTF-16 (see ``utf16``). An unfinished record
    counts.
    """
    labels = [label.alias("label")] if label is not None else []
    names = ["label"] if labels else []
    lines = _lines(spark, path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        *labels,
        F.monotonically_increasing_id().alias("id"),
        _odd_quotes(F.col("value")).cast("long").alias("odd"),
    )
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("_odd"))
    by_file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("_odd").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lead("block").over(by_file).isNull()
    blocks = blocks.select("file", "block", before.alias("_before"), last.alias("_last"))
    inside = Window.partitionBy("file", "block").orderBy("id")
    running = F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ends = (F.col("_before") + F.col("_running")) % 2 == 0
    unfinished = F.col("_last") & F.col("_is_last") & ~ends
    counted = (
        lines.join(blocks, ["file", "block"])
        .withColumn("_running", running)
        .withColumn("_is_last", F.lead("id").over(inside).isNull())
        .groupBy("file", *names)
        .agg(F.count_if(ends | unfinished).alias("n"))
    )
    return counted.select("file", *names, F.greatest(F.col("n") - 1, F.lit(0)).alias("records"))


def count_source_rows(spark: SparkSession, path: str, facts: SourceFacts) -> tuple[int, str]:
    """Source record count and how it was found, without looking at what was imported.

    Without cells that run over lines, lines are records; else the parity of quotes tells.
    """
    if not facts.has_multi_line:
        return facts.physical_rows, "line-count"
    counts = utf16_counts(spark, [path]) if facts.encoding == UTF16 else record_counts(spark, path)
    total = counts.agg(F.coalesce(F.sum("records"), F.lit(0))).first()
    return total[0], "quote-parity"


def audit_row_counts(spark: SparkSession, root: str, imported: DataFrame) -> DataFrame:
    """Source rows of many datasets against their imported rows (dataset_code, imported).

    Files lie below ``root/dataset=<code>/``, each in its own encoding. One line scan
    covers all of them; the method says whether a dataset has cells over several lines.
    """
    code = path_value("dataset")
    facts = file_facts(spark, root, code)
    lines = facts.groupBy("label").agg(F.bool_or("has_multi_line").alias("multi"))
    counts, units = record_counts(spark, root, code), _units(spark, facts)
    if units is not None:
        by_unit = F.coalesce("_records", "records").alias("records")
        counts = counts.join(units, "file", "left").select("label", by_unit)
    records = counts.groupBy("label").agg(F.sum("records").alias("records"))
    counted = lines.join(records, "label").withColumnRenamed("label", "dataset_code")
    return imported.join(counted, "dataset_code", "left").select(
        "dataset_code",
        "imported",
        F.coalesce("records", F.lit(0)).alias("source_rows"),
        F.when(F.col("multi"), "quote-parity").otherwise("line-count").alias("method"),
    )
