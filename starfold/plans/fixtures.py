"""Wide, all-text sources derived from the driver's tables, and metadata stand-ins.

They look like source CSV files do: repeated labels, constants, text markers. Every
row of the tables takes part.
"""

from __future__ import annotations

import csv
import io
import itertools
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.session import ship_by_value

ship_by_value(__name__)


class Tables:
    """The driver's Parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores: the driver's tables are single files of one row group."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def evenly(df: DataFrame) -> DataFrame:
    """The rows of a table over all cores, moved only if its splits don't do that already.

    What each split holds is counted from file footers; no column is read. Done before a
    table is widened, a move takes only the columns that the joins need.
    """
    splits = df.groupBy(F.spark_partition_id()).count()
    rows, most = splits.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if most * cores <= 2 * rows else spread(df)


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def wide_sales(t: Tables) -> DataFrame:
    """Crop-like source: constants, a text marker, a year dimension."""
    flag, year = F.col("l_returnflag"), _text(F.year("l_shipdate"))
    rows = (
        evenly(t.lineitem).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.lit("LI").alias("domain_code"),
        F.lit("Line items").alias("domain"),
        _text("n_nationkey").alias("area_code"),
        F.concat(F.lit("'"), F.lpad(_text("n_nationkey"), 3, "0")).alias("area_code_m49"),
        F.col("n_name").alias("area_label"),
        _text("p_partkey").alias("item_code"),
        F.col("p_name").alias("item_label"),
        F.when(flag == "A", "5510").when(flag == "N", "5312").otherwise("5910").alias("element_code"),
        F.when(flag == "A", "Accepted").when(flag == "N", "New").otherwise("Returned").alias("element_label"),
        year.alias("year_code"),
        year.alias("year"),
        F.lit("t").alias("unit"),
        _text(F.col("l_quantity").cast("bigint")).alias("value"),
        F.col("l_linestatus").alias("flag_code"),
    )


def wide_trade(t: Tables) -> DataFrame:
    """Trade-like source: two country roles, a currency, text item codes, decimals."""
    buyer = t.nation.select(
        F.col("n_nationkey").alias("buyer_key"), F.col("n_name").alias("buyer"), F.col("n_regionkey").alias("region_key")
    )
    seller = t.nation.select(F.col("n_nationkey").alias("seller_key"), F.col("n_name").alias("seller"))
    year = _text(F.year("l_shipdate"))
    rows = (
        evenly(t.lineitem).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(buyer, F.col("c_nationkey") == F.col("buyer_key"))
        .join(t.region, F.col("region_key") == F.col("r_regionkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(seller, F.col("s_nationkey") == F.col("seller_key"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.select(
        _text("buyer_key").alias("reporter_country_code"),
        F.col("buyer").alias("reporter_country_label"),
        _text("seller_key").alias("partner_country_code"),
        F.col("seller").alias("partner_country_label"),
        F.col("p_brand").alias("item_code"),
        F.concat(F.lit("Brand family "), "p_brand").alias("item_label"),
        F.concat(F.lit("C"), _text("r_regionkey")).alias("iso_currency_code"),
        F.col("r_name").alias("iso_currency_label"),
        year.alias("year_code"),
        year.alias("year"),
        _text("l_discount").alias("value"),
        F.col("l_linestatus").alias("flag_code"),
    )


def wide_orders(t: Tables) -> DataFrame:
    """Source with range year labels, censored values and NULL flags."""
    rows = evenly(t.orders).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    price = _text(F.floor("o_totalprice").cast("bigint"))
    return rows.select(
        _text("n_nationkey").alias("area_code"),
        F.col("n_name").alias("area_label"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("item_code"),
        F.col("o_orderpriority").alias("item_label"),
        F.when(key % 50 == 0, "1995-1997").otherwise(_text(F.year("o_orderdate"))).alias("year"),
        F.when(key % 97 == 0, "<0.1").otherwise(price).alias("value"),
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("flag_code"),
    )


def header_table(t: Tables) -> DataFrame:
    """Headers of many datasets, one dataset per part, with repeats and taken suffixes."""
    kind, brand = F.col("p_type"), F.col("p_brand")
    names = F.array(
        F.lit("Area Code"),
        F.lit("Area Code (M49)"),
        F.lit("  Area "),
        F.concat(kind, F.lit(" Code")),
        F.concat(kind, F.lit(" ("), brand, F.lit(")")),
        F.lit("Reporter Country Code"),
        F.lit("Reporter Countries"),
        F.lit("Year Code"),
        F.lit("Year"),
        F.lit("Unit"),
        F.lit("Value"),
        F.lit("Value"),
        F.concat(F.lit("Value "), _text(F.col("p_size") % 3)),
        F.lit("Value"),
        F.lit("Flag"),
        F.upper("p_name"),
    )
    return spread(t.part).select(
        F.concat(F.lit("P"), _text("p_partkey")).alias("dataset_code"),
        F.posexplode(names).alias("position", "raw_name"),
    ).select("dataset_code", (F.col("position") + 1).alias("ordinal"), "raw_name")


def archive_members(t: Tables) -> DataFrame:
    """Archive directories: an order is an archive, its lines are the members."""
    name = F.concat(
        F.lit("dir/"),
        _text("l_partkey"),
        F.when(F.col("l_linestatus") == "F", "_E_Flags").otherwise("_E_All_Data"),
        F.when(F.col("l_returnflag") == "R", ".txt").otherwise(".CSV"),
    )
    return t.lineitem.select(
        F.col("l_orderkey").alias("archive"),
        F.col("l_linenumber").alias("member_index"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        name.alias("name"),
        F.col("l_quantity").cast("bigint").alias("size"),
    )


def manifest_log(t: Tables) -> DataFrame:
    """A manifest log: users are datasets, event order is line order."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "purchase", "imported")
        .when(kind == "click", "downloaded")
        .when(kind == "view", "zip_invalid")
        .otherwise("failed")
    )
    return t.events.select(
        F.col("user_id").alias("dataset_code"),
        F.col("event_id").alias("line"),
        state.alias("state"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("expected_size"),
    )


def inventory(t: Tables) -> DataFrame:
    """An inventory with sizes as text, some of them unreadable, and URLs."""
    key = F.col("p_partkey")
    suffix = (
        F.when(key % 5 == 0, "KB")
        .when(key % 5 == 1, " MB")
        .when(key % 5 == 2, ".5kb")
        .when(key % 5 == 3, "")
        .otherwise(" parsecs")
    )
    tail = F.when(key % 3 == 0, ".zip").when(key % 3 == 1, ".ZIP/").otherwise("/data")
    return t.part.select(
        F.concat(F.lit("p"), _text(key)).alias("dataset_code"),
        F.concat(_text("p_size"), suffix).alias("file_size"),
        F.when(key % 4 != 0, key * 10).alias("file_rows"),
        F.concat(F.lit("https://example.org/bulk/"), F.replace("p_name", F.lit(" "), F.lit("_")), tail).alias("url"),
    )


def lookup(t: Tables) -> DataFrame:
    """A curated area lookup that misses some nations and varies case and spaces."""
    key = F.col("n_nationkey")
    return t.nation.where(key % 5 != 0).select(
        F.when(key % 2 == 0, F.upper("n_name")).otherwise(F.concat(F.lit(" "), "n_name", F.lit("  "))).alias("area_name"),
        F.when(key % 3 == 0, "false").otherwise("true").alias("is_country"),
        F.when(key % 4 == 0, _text(key + 1990)).otherwise("").alias("valid_from"),
        F.when(key % 7 == 0, _text(key + 2000)).otherwise("").alias("valid_to"),
    )


def provenance(t: Tables) -> DataFrame:
    """Provenance of many datasets: an order is a dataset, its lines the rows."""
    key = F.col("o_orderkey")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    counted = F.coalesce(F.col("lines"), F.lit(0))
    return t.orders.join(lines, F.col("l_orderkey") == key, "left").select(
        F.concat(F.lit("O"), _text(key)).alias("dataset_code"),
        (counted + F.when(key % 5 == 0, 1).otherwise(0)).alias("file_rows_declared"),
        (counted - F.when(key % 13 == 0, 1).otherwise(0)).alias("rows_imported"),
        counted.alias("source_csv_rows"),
        (key % 4 == 0).alias("is_filtered"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("imported").alias("import_status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_update"),
    )


def inventory_documents(t: Tables) -> DataFrame:
    """Inventory documents of every shape that the scan accepts, one per part."""
    key = F.col("p_partkey")
    code = F.concat(F.lit("p"), _text(key))
    entry = F.struct(
        code.alias("DatasetCode"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("DatasetName"),
        F.when(key % 6 == 0, "").otherwise(F.col("p_type")).alias("Topic"),
        F.lit("").alias("FileLocation"),
        F.concat(F.lit("https://example.org/"), code).alias("URL"),
        F.concat(_text("p_size"), F.lit("KB")).alias("FileSize"),
        F.when(key % 4 == 0, "many").otherwise(_text(key * 7)).alias("FileRows"),
        _text("p_size").alias("Kept"),
    )
    renamed = F.struct(
        F.concat(code, F.lit("b")).alias("datasetCode"),
        F.col("p_name").alias("name"),
        F.lit(None).cast("string").alias("topic"),
        F.col("p_size").alias("Rows"),
        F.col("p_brand").alias("Kept"),
    )
    document = (
        F.when(key % 3 == 0, F.to_json(F.struct(F.struct(F.array(entry).alias("Dataset")).alias("Datasets"))))
        .when(key % 3 == 1, F.to_json(F.struct(F.struct(renamed.alias("Dataset")).alias("Datasets"))))
        .otherwise(F.to_json(F.array(entry)))
    )
    return t.part.select(F.concat(F.lit("doc/"), _text(key)).alias("source_url"), document.alias("value"))


def small_archives(t: Tables) -> DataFrame:
    """A ZIP archive per part, made from its row alone; some are damaged on purpose.

    Every seventh archive is cut in half and every seventh has a wrong byte in its
    first member.
    """

    def pack(batches):
        for rows in batches:
            made = []
            for key, name, kind in zip(rows["p_partkey"], rows["p_name"], rows["p_type"]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
                    for member, text in (
                        ("data.csv", f'"Item","Value"\n"{name}","{key}"\n'),
                        ("flags.csv", f'"Flag","Description"\n"A","{kind}"\n'),
                    ):
                        archive.writestr(zipfile.ZipInfo(member, (2020, 1, 1, 0, 0, 0)), text)
                content = bytearray(buffer.getvalue())
                if key % 7 == 1:
                    content = content[: len(content) // 2]
                elif key % 7 == 2:
                    content[content.index(b'"Item"') + 1] ^= 0xFF
                made.append((f"p{key}.zip", bytes(content)))
            yield pd.DataFrame(made, columns=["archive", "content"])

    return spread(t.part.select("p_partkey", "p_name", "p_type")).mapInPandas(pack, "archive string, content binary")


ARCHIVE_HEADERS = ["Area Code", "Area", "Item Code", "Item", "Year", "Value", "Flag"]


def region_archives(t: Tables, folder: str) -> DataFrame:
    """(dataset_code, rows) of one ZIP archive for each region, written to ``folder``.

    An archive holds the region's orders as CSV, a legend of its flags, and a read-me file.
    Rows go through its one deflate stream as they come; a task holds a batch of them and
    the few flags. Archives get their names when they are whole.
    """

    def pack(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        system.create_dir(root, recursive=True)
        rows = itertools.chain.from_iterable(b.itertuples(index=False, name=None) for b in batches)
        for code, group in itertools.groupby(rows, key=lambda r: r[0]):
            draft, flags, count = f"{root}/.draft-{uuid.uuid4().hex}", set(), 0
            with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open(f"{code}_All_Data.csv", "w", force_zip64=True) as member:
                    text = io.TextIOWrapper(member, "utf-8", newline="")
                    writer = csv.writer(text, quoting=csv.QUOTE_ALL)
                    writer.writerow(ARCHIVE_HEADERS)
                    for _, _, *cells in group:
                        writer.writerow(["" if c is None else c for c in cells])
                        flags.add(cells[-1])
                        count += 1
                    text.detach()
                legend = [f"{f},Status {f}" for f in sorted(flags - {None})]
                archive.writestr(f"{code}_Flags.csv", "\n".join(["Flag,Description", *legend]) + "\n")
                archive.writestr("readme.txt", "orders of one region\n")
            system.move(draft, f"{root}/{code}.zip")
            yield pd.DataFrame({"dataset_code": [code], "rows": [count]})

    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    cells = rows.select(
        F.concat(F.lit("R"), _text("n_regionkey")).alias("code"),
        F.col("o_orderkey").alias("place"),
        _text("n_nationkey").alias("area_code"),
        F.col("n_name").alias("area_label"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("item_code"),
        F.col("o_orderpriority").alias("item_label"),
        _text(F.year("o_orderdate")).alias("year"),
        _text(F.floor("o_totalprice").cast("bigint")).alias("value"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("flag_code"),
    )
    ordered = cells.repartition("code").sortWithinPartitions("code", "place")
    return ordered.mapInPandas(pack, "dataset_code string, rows bigint")


def archive_inventory(packed: DataFrame) -> DataFrame:
    """An inventory document for every packed archive."""
    entry = F.struct(
        F.col("dataset_code").alias("DatasetCode"),
        F.concat(F.lit("Orders of "), "dataset_code").alias("DatasetName"),
        _text("rows").alias("FileRows"),
    )
    document = F.to_json(F.struct(F.struct(F.array(entry).alias("Dataset")).alias("Datasets")))
    return packed.select(F.concat(F.lit("doc/"), "dataset_code").alias("source_url"), document.alias("value"))
