"""One query per operator, on the driver's tables. All take (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions import cells, headers
from starfold.functions.headers import DimensionGroup, normalise_names
from starfold.operators import audit, enrich, merge, profile, reduce, selection, views
from starfold.operators.reduce import Years
from starfold.plans import build, fixtures, importer
from starfold.plans.fixtures import Tables
from starfold.plans.store import Store
from starfold.session import fresh_dir, materialise
from starfold.sources import archives, csv_files, inventory, lookup, manifest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(Tables(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def _store(t: Tables, label: str) -> Store:
    return Store(t.spark, fresh_dir(t.spark, label))


def _imported(t: Tables, wide: DataFrame, code: str, store: Store | None = None, **options) -> Store:
    """A store with one wide source staged and imported."""
    store = store or _store(t, "store")
    importer.import_frame(store, materialise(wide, "staged"), code, **options)
    return store


def _reduced(wide: DataFrame, code: str) -> tuple[DataFrame, reduce.Layout]:
    """Clean rows of a wide source and the layout its profile settled."""
    staged = materialise(wide, "staged")
    layout = reduce.plan_layout(staged, code)
    return layout.clean(staged), layout


def _fact(wide: DataFrame, code: str) -> DataFrame:
    clean, layout = _reduced(wide, code)
    return clean.select(*layout.fact_columns)


# --- scans, sources, sinks -------------------------------------------------------

ORDER_HEADERS = ["Area Code", "Area", "Item Code", "Item", "Year", "Value", "Flag"]


def _orders_with_line_ends(t: Tables) -> DataFrame:
    """Orders source in which a label spans two lines where the value has 5, 10, ... characters."""
    broken = F.concat("item_label", F.lit('\n"second, line"'))
    spans = F.length("value") % 5 == 0
    return fixtures.wide_orders(t).withColumn("item_label", F.when(spans, broken).otherwise(F.col("item_label")))


def _write_csv(df: DataFrame, label: str, encoding: str = "UTF-8", partition: str | None = None) -> str:
    path = fresh_dir(df.sparkSession, label)
    writer = df.write.option("header", "true").option("escape", '"').option("encoding", encoding)
    (writer.partitionBy(partition) if partition else writer).csv(path)
    return path


@query
def csv_scan(t: Tables) -> DataFrame:
    path = _write_csv(_orders_with_line_ends(t).toDF(*ORDER_HEADERS), "csv")
    facts = csv_files.source_facts(t.spark, path)
    names = normalise_names(csv_files.csv_header(t.spark, path, facts.encoding))
    return csv_files.scan_csv(t.spark, path, names, facts.encoding, facts.has_multi_line)


@query
def encoding_audit(t: Tables) -> DataFrame:
    """Files of each region in the encoding of that region."""
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", F.concat("n_name", F.lit(" côté")).alias("label"), F.col("r_name").alias("region"), "r_regionkey")
    )
    root = fresh_dir(t.spark, "encodings")
    for i, encoding in enumerate(("UTF-8", "ISO-8859-1", "UTF-16")):
        part = rows.where(F.col("r_regionkey") % 3 == i).drop("r_regionkey")
        part.write.option("header", "true").option("encoding", encoding).partitionBy("region").csv(f"{root}/{i}")
    facts = csv_files.file_facts(t.spark, root, csv_files.path_value("region"))
    return facts.groupBy(F.col("label").alias("region"), "encoding").agg(F.sum("physical_rows").alias("physical_rows"))


@query
def archive_audit(t: Tables) -> DataFrame:
    """Findings for every archive; digests are compared with Spark's own of the same bytes."""
    packed = materialise(fixtures.small_archives(t), "packed")
    own = packed.select("archive", F.sha2("content", 256).alias("own"))
    checked = archives.audit_archives(packed).join(own, "archive")
    return checked.select(
        "archive",
        "ok",
        "bad_member",
        F.regexp_extract("reason", "^[^:]+", 0).alias("reason"),
        (F.col("sha256") == F.col("own")).alias("right_hash"),
    )


@query
def size_check(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    length = key * 3 + 100
    files = t.part.select(key.alias("dataset_code"), length.alias("length"))
    declared = t.part.select(
        key.alias("dataset_code"), F.when(key % 4 != 0, length + (key % 3) * 50).alias("declared_bytes")
    )
    return audit.size_check(files, declared, tolerance=0.1)


MEMBER_TIES = ["member_index", "part", "supplier", "name"]


@query
def pick_main_member(t: Tables) -> DataFrame:
    return audit.pick_main_member(fixtures.archive_members(t), MEMBER_TIES, [*MEMBER_TIES, "size"])


@query
def pick_flag_member(t: Tables) -> DataFrame:
    return audit.pick_flag_member(fixtures.archive_members(t), MEMBER_TIES, [*MEMBER_TIES, "size"])


@query
def inventory_scan(t: Tables) -> DataFrame:
    scanned = inventory.scan_inventory(fixtures.inventory_documents(t))
    return scanned.select(
        "dataset_code",
        "dataset_name",
        "topic",
        "file_location",
        "file_size",
        "file_rows",
        F.get_json_object("raw_json", "$.Kept").alias("kept_field"),
        "source_url",
    )


@query
def latest_state(t: Tables) -> DataFrame:
    """The log is written as JSON lines; its time stamps are the places of the lines."""
    log = fixtures.manifest_log(t).withColumn("updated_at", F.lpad(F.col("line").cast("string"), 20, "0"))
    path = fresh_dir(t.spark, "manifest")
    log.select("dataset_code", "state", F.col("expected_size").cast("string").alias("expected_size"), "updated_at").write.json(path)
    states = manifest.carried_states(manifest.read_log(t.spark, path), "updated_at")
    kinds = dict(log.dtypes)
    names = ("dataset_code", "state", "expected_size")
    return states.select(*[F.col(c).cast(kinds[c]).alias(c) for c in names])


@query
def flag_legend(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    rows = t.orders.select(
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("Flag"),
        F.concat("o_orderstatus", F.lit(" "), "o_orderpriority").alias("Description"),
    )
    return lookup.read_flag_legend(t.spark, _write_csv(rows, "legend"), "OR")


@query
def fact_replace(t: Tables) -> DataFrame:
    """A dataset is loaded, then replaced by another load."""
    store = _store(t, "replace")
    store.replace("data_li", _fact(fixtures.wide_orders(t), "LI"))
    fact = _fact(fixtures.wide_sales(t), "LI")
    return store.replace("data_li", fact, "year")


@query
def raw_copy(t: Tables) -> DataFrame:
    return _imported(t, fixtures.wide_sales(t), "LI", keep_raw=True).read("raw_li")


@query
def compact_table(t: Tables) -> DataFrame:
    store = _store(t, "compact")
    store.replace("data_or", _fact(fixtures.wide_orders(t), "OR").repartition(24))
    before, after = store.compact("data_or")
    rows = store.read("data_or")
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.length("value")).alias("value_chars"),
        F.lit(after <= before).alias("not_larger"),
    )


@query
def table_counts(t: Tables) -> DataFrame:
    store = _imported(t, fixtures.wide_sales(t), "LI")
    _imported(t, fixtures.wide_orders(t), "OR", store)
    return store.counts()


# --- projections, filters, headers -------------------------------------------------


@query
def rename_project(t: Tables) -> DataFrame:
    raw = fixtures.wide_orders(t).toDF(*ORDER_HEADERS)
    return reduce.rename_columns(raw, normalise_names(raw.columns))


@query
def normalize_headers(t: Tables) -> DataFrame:
    return headers.normalise_headers(fixtures.header_table(t))


@query
def dedupe_headers(t: Tables) -> DataFrame:
    return headers.suffix_headers(fixtures.header_table(t))


@query
def header_roles(t: Tables) -> DataFrame:
    named = headers.normalise_headers(fixtures.header_table(t))
    return named.select("dataset_code", "ordinal", "base_name", headers.role(F.col("base_name")).alias("role"))


@query
def dimension_groups(t: Tables) -> DataFrame:
    return headers.group_headers(headers.suffix_headers(fixtures.header_table(t)))


@query
def column_mapping(t: Tables) -> DataFrame:
    return headers.column_mapping(fixtures.header_table(t))


@query
def year_filter(t: Tables) -> DataFrame:
    return reduce.filter_years(fixtures.wide_orders(t), Years.of(1995, 1997))


@query
def year_filter_open(t: Tables) -> DataFrame:
    return reduce.filter_years(fixtures.wide_orders(t), Years.of(1995, start=1999))


@query
def select_include(t: Tables) -> DataFrame:
    return selection.select_datasets(fixtures.inventory(t), "include", ["P1", "p17", "P150"]).select("dataset_code", "file_size")


@query
def select_exclude(t: Tables) -> DataFrame:
    return selection.select_datasets(fixtures.inventory(t), "exclude", ["P1", "p17", "P150"]).select("dataset_code", "file_size")


@query
def needs_refetch(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    states = merge.latest_state(fixtures.manifest_log(t), "dataset_code", "line", ["state"], [])
    listed = t.part.select(key.alias("dataset_code"))
    files = t.part.where(key % 7 != 0).select(key.alias("dataset_code"))
    return audit.needs_refetch(listed, states, files)


@query
def fact_reduced(t: Tables) -> DataFrame:
    return _fact(fixtures.wide_sales(t), "LI")


@query
def strip_marker(t: Tables) -> DataFrame:
    """One column bears the marker throughout, one on some rows, one not at all."""
    rows = fixtures.wide_sales(t).select(
        "item_code",
        F.when(F.col("flag_code") == "F", F.col("area_code_m49")).alias("area_code_m49"),
        F.when(F.col("flag_code") == "F", F.concat(F.lit("'"), "area_label")).otherwise(F.col("area_label")).alias("area_label"),
        "value",
    )
    return reduce.strip_markers(rows)


# --- joins and views ----------------------------------------------------------------


@query
def labelled_view(t: Tables) -> DataFrame:
    return importer.labelled(_imported(t, fixtures.wide_sales(t), "LI"), "LI")


@query
def labelled_trade(t: Tables) -> DataFrame:
    return importer.labelled(_imported(t, fixtures.wide_trade(t), "TR"), "TR")


@query
def manual_dim_join(t: Tables) -> DataFrame:
    """Inner joins for area and item, a left join for the flag, as written by hand."""
    store = _imported(t, fixtures.wide_sales(t), "LI")
    legend = t.lineitem.where(F.col("l_linestatus") == "F").select(
        F.col("l_linestatus").alias("flag_code"), F.lit("Final").alias("flag_description")
    )
    store.replace_dimension("dim_flag", merge.flag_legend(legend, "LI"), "LI", False)
    joined = views.dimension_join(
        store.read("data_li"),
        "LI",
        {"area_code": store.read("dim_area"), "item_code": store.read("dim_item")},
        {"flag_code": store.read("dim_flag")},
    )
    return joined.select("area_label", "item_label", "year", cells.as_number(F.col("value")).alias("value"), "flag_code", "flag_description")


@query
def hetero_key_join(t: Tables) -> DataFrame:
    """One shared item dimension for integer codes and for text codes."""
    store = _imported(t, fixtures.wide_sales(t), "LI")
    _imported(t, fixtures.wide_trade(t), "TR", store)
    parts = [
        importer.labelled(store, code).groupBy("dataset_code", F.col("item_code").cast("string").alias("item_code"), "item_label").agg(F.count(F.lit(1)).alias("n"))
        for code in ("LI", "TR")
    ]
    return parts[0].unionByName(parts[1])


def _area_dimension(t: Tables) -> DataFrame:
    """Areas of two datasets; the second one words some labels differently."""
    group = DimensionGroup("area", "area_code", ("area_label",))
    worded = F.when(F.col("area_code").cast("int") % 2 == 1, F.concat("area_label", F.lit(" (former)")))
    other = fixtures.wide_orders(t).withColumn("area_label", F.coalesce(worded, "area_label"))
    return reduce.dimension(fixtures.wide_sales(t), group, "LI").unionByName(reduce.dimension(other, group, "OR"))


@query
def classify_areas(t: Tables) -> DataFrame:
    """The curated lookup is written as a CSV file and read back."""
    curated = lookup.read_lookup(t.spark, _write_csv(fixtures.lookup(t), "lookup"))
    return enrich.classify_areas(_area_dimension(t), curated)


@query
def validity_fill(t: Tables) -> DataFrame:
    classified = enrich.classify_areas(_area_dimension(t), fixtures.lookup(t))
    return enrich.fill_validity(classified, fixtures.lookup(t))


@query
def validity_coverage(t: Tables) -> DataFrame:
    classified = enrich.classify_areas(_area_dimension(t), fixtures.lookup(t))
    return enrich.validity_coverage(enrich.fill_validity(classified, fixtures.lookup(t)))


ITEM = DimensionGroup("item", "item_code", ("item_label",))


@query
def dim_append(t: Tables) -> DataFrame:
    """Members of early years are stored; later ones bring other labels and new keys."""
    wide = materialise(fixtures.wide_sales(t).select("item_code", "item_label", "year"), "staged")
    stored = reduce.dimension(wide.where("year <= '1995'"), ITEM, "LI")
    later = wide.where("year > '1995'").withColumn("item_label", F.upper("item_label"))
    return merge.append_members(stored, reduce.dimension(later, ITEM, "LI"), "item_code")


# --- aggregations -------------------------------------------------------------------


def _all_sources(t: Tables) -> dict[str, DataFrame]:
    return {"LI": fixtures.wide_sales(t), "TR": fixtures.wide_trade(t), "OR": fixtures.wide_orders(t)}


def _tagged(parts: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.select(F.lit(code).alias("dataset_code"), "*") for code, df in parts.items()]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    return union


@query
def infer_types(t: Tables) -> DataFrame:
    return _tagged({code: profile.infer_types(df) for code, df in _all_sources(t).items()})


@query
def marker_profile(t: Tables) -> DataFrame:
    return profile.marker_profile(fixtures.wide_sales(t))


@query
def constant_columns(t: Tables) -> DataFrame:
    clean, layout = _reduced(fixtures.wide_sales(t), "LI")
    return profile.constant_columns(clean.select(*layout.reduced_columns))


@query
def rowcount_audit(t: Tables) -> DataFrame:
    """Row counts of the CSV files of every area against the rows loaded from them."""
    rows = _orders_with_line_ends(t)
    even = F.col("area_code").cast("int") % 2 == 0
    rows = rows.withColumn("item_label", F.when(even, F.lit("plain")).otherwise(F.col("item_label")))
    path = _write_csv(rows.withColumn("dataset", F.col("area_code")), "counted", partition="dataset")
    loaded = rows.groupBy(F.col("area_code").alias("dataset_code")).agg(F.count(F.lit(1)).alias("imported"))
    return csv_files.audit_row_counts(t.spark, path, loaded)


@query
def lossless_verdict(t: Tables) -> DataFrame:
    return audit.lossless_verdict(fixtures.provenance(t))


@query
def build_summary(t: Tables) -> DataFrame:
    datasets = fixtures.provenance(t)
    builds = t.orders.select(
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("build_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("completed_at"),
    )
    return audit.build_summary(datasets, builds)


@query
def validate_facts(t: Tables) -> DataFrame:
    store = _imported(t, fixtures.wide_orders(t), "OR")
    _imported(t, fixtures.wide_orders(t), "EM", store, years=Years.of(1800))
    return audit.validate_facts(store.counts())


@query
def selection_estimate(t: Tables) -> DataFrame:
    return audit.selection_estimate(fixtures.inventory(t))


@query
def incoming_years(t: Tables) -> DataFrame:
    return reduce.incoming_years(fixtures.wide_orders(t))


@query
def rows_per_dataset(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("dataset_code"))
    return audit.rows_per_dataset(rows)


@query
def recent_datasets(t: Tables) -> DataFrame:
    return audit.recent_datasets(fixtures.provenance(t).select("dataset_code", "date_update"))


# --- set and table-maintenance operators ----------------------------------------------


@query
def dim_extract(t: Tables) -> DataFrame:
    """Every dimension of the source, one row per member."""
    clean, layout = _reduced(fixtures.wide_sales(t), "LI")
    parts = []
    for group in layout.groups:
        dim = reduce.dimension(clean, group, "LI")
        parts.append(
            dim.select(
                F.lit(group.stem).alias("stem"),
                "dataset_code",
                F.col(group.key).alias("member_key"),
                F.concat_ws("|", *group.attributes).alias("attributes"),
            )
        )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query
def dim_replace(t: Tables) -> DataFrame:
    """Two datasets share a dimension; one of them is loaded again with other labels."""
    group = DimensionGroup("area", "area_code", ("area_label",))
    store = _store(t, "dim")
    sales, orders = fixtures.wide_sales(t), fixtures.wide_orders(t)
    store.replace_dimension("dim_area", reduce.dimension(sales, group, "LI"), "LI", False)
    store.replace_dimension("dim_area", reduce.dimension(orders, group, "OR"), "OR", False)
    again = sales.where("flag_code = 'F'").withColumn("area_label", F.lower("area_label"))
    store.replace_dimension("dim_area", reduce.dimension(again, group, "LI"), "LI", False)
    return store.read("dim_area")


@query
def dim_widen(t: Tables) -> DataFrame:
    """A second dataset brings an attribute that the shared dimension does not know."""
    sales = reduce.dimension(fixtures.wide_sales(t), ITEM, "LI")
    trade = fixtures.wide_trade(t).withColumn("item_family", F.substring("item_code", 1, 5))
    wider = DimensionGroup("item", "item_code", ("item_label", "item_family"))
    return merge.widen(sales, reduce.dimension(trade, wider, "TR"))


@query
def upsert_dataset(t: Tables) -> DataFrame:
    stored = fixtures.provenance(t).select("dataset_code", "rows_imported", "import_status")
    key = F.col("o_orderkey")
    changes = t.orders.where(key % 10 < 3).select(
        F.concat(F.lit("O"), (key + F.when(key % 10 == 0, 100000000).otherwise(0)).cast("string")).alias("dataset_code"),
        F.lit(-1).cast("bigint").alias("rows_imported"),
        F.lit("refreshed").alias("import_status"),
    )
    return merge.upsert(stored, changes, ["dataset_code"])


@query
def build_record(t: Tables) -> DataFrame:
    """Build provenance is appended run by run."""
    store = _store(t, "builds")
    for status in ("F", "O", "P"):
        run = t.orders.where(F.col("o_orderstatus") == status).agg(
            F.count(F.lit(1)).alias("datasets_imported"),
            F.min("o_orderkey").alias("first_key"),
        )
        store.append("meta_build", run.select(F.lit(f"build-{status}").alias("build_id"), "*"))
    return store.read("meta_build")


def _later(wide: DataFrame) -> DataFrame:
    """A later delivery of the source, with other values."""
    return wide.withColumn("value", (F.col("value").cast("int") + 1000).cast("string"))


@query
def year_merge(t: Tables) -> DataFrame:
    wide = fixtures.wide_sales(t)
    store = _imported(t, wide, "LI", years=Years.of(1995, 1996, 1997, 1998))
    _imported(t, _later(wide), "LI", store, years=Years.of(start=1998))
    return store.read("data_li")


@query
def year_merge_idempotent(t: Tables) -> DataFrame:
    wide = fixtures.wide_sales(t)
    store = _imported(t, wide, "LI")
    later = materialise(_later(wide), "staged")
    for _ in range(2):
        importer.import_frame(store, later, "LI", years=Years.of(1996, 1999))
    return store.read("data_li")


@query
def merge_constant_restore(t: Tables) -> DataFrame:
    """Element and unit are constant in the first slice and no longer in the second."""
    wide = fixtures.wide_sales(t)
    first = wide.where("element_code = '5510'")
    second = wide.withColumn("unit", F.when(F.col("flag_code") == "F", "kg").otherwise("t"))
    store = _imported(t, first, "LI", years=Years.of(1995, 1996, 1997))
    _imported(t, second, "LI", store, years=Years.of(start=1998))
    return store.read("data_li")


@query
def unified_long(t: Tables) -> DataFrame:
    facts = {code: _fact(df, code) for code, df in _all_sources(t).items()}
    return views.unified_long(facts, ["area_code", "item_code", "element_code", "year", "value", "flag_code"])


# --- composites -----------------------------------------------------------------------


@query
def rehydrate(t: Tables) -> DataFrame:
    return importer.rebuild_source(_imported(t, fixtures.wide_sales(t), "LI"), "LI")


SALES_HEADERS = [
    "Domain Code", "Domain", "Area Code", "Area Code (M49)", "Area", "Item Code", "Item",
    "Element Code", "Element", "Year Code", "Year", "Unit", "Value", "Flag",
]


@query
def import_dataset(t: Tables) -> DataFrame:
    """The whole way from CSV files to the labelled view."""
    path = _write_csv(fixtures.wide_sales(t).toDF(*SALES_HEADERS), "source")
    store = _store(t, "import")
    importer.import_csv(store, path, "LI")
    return importer.labelled(store, "LI")


@query
def archive_to_star(t: Tables) -> DataFrame:
    """From ZIP archives to labelled views: several datasets side by side, in two builds.

    The first takes the years from 1996 on, the second merges 1995 into them and keeps a
    raw copy of it. The result has the rows of each label and what provenance and raw copy
    say of the dataset.
    """
    folder = fresh_dir(t.spark, "archives")
    packed = materialise(fixtures.region_archives(t, folder), "packed")
    listed = materialise(inventory.scan_inventory(fixtures.archive_inventory(packed)), "inventory")
    store = _store(t, "archives")
    for years, keep_raw in ((Years.of(start=1996), False), (Years.of(1995), True)):
        result = build.build(store, listed, folder, years=years, keep_raw=keep_raw)
        if result.failed:
            raise RuntimeError(f"builds failed: {result.failed}")
    found = raw = None
    labels = ["dataset_code", "area_label", "item_label", "year", "flag_description"]
    for code in sorted(result.imported):
        view = importer.labelled(store, code)
        rows = view.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("bigint")).alias("total"))
        copies = store.read(importer.raw_table(code)).agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("dataset_code", F.lit(code))
        found, raw = (rows, copies) if found is None else (found.unionByName(rows), raw.unionByName(copies))
    noted = store.read(build.DATASETS).select("dataset_code", "rows_imported", "file_rows_declared")
    return found.join(noted, "dataset_code").join(raw, "dataset_code")


# --- recipes and scalar functions -------------------------------------------------------


@query
def label_search(t: Tables) -> DataFrame:
    view = importer.labelled(_imported(t, fixtures.wide_sales(t), "LI"), "LI")
    return views.search_labels(view, "item_code", "item_label", "RING|bolt")


@query
def series_one(t: Tables) -> DataFrame:
    view = importer.labelled(_imported(t, fixtures.wide_sales(t), "LI"), "LI")
    chosen = {"area_label": "NATION_3", "element_label": "New"}
    return views.series(view, chosen, ["year", "item_code", "item_label", "value", "flag_code"])


@query
def series_many(t: Tables) -> DataFrame:
    view = importer.labelled(_imported(t, fixtures.wide_sales(t), "LI"), "LI")
    areas = ["NATION_3", "NATION_4", "NATION_20"]
    return views.compare(view, "area_label", areas, ["area_label", "year", "value"])


@query
def value_safe_cast(t: Tables) -> DataFrame:
    return fixtures.wide_orders(t).select("area_code", "year", "value", cells.as_number(F.col("value")).alias("number"))


@query
def content_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", cells.content_hash(F.col("text")).alias("sha256"))


@query
def parse_sizes(t: Tables) -> DataFrame:
    return fixtures.inventory(t).select("dataset_code", "file_size", cells.size_in_bytes(F.col("file_size")).alias("size_bytes"))


@query
def archive_names(t: Tables) -> DataFrame:
    return fixtures.inventory(t).select("dataset_code", "url", cells.archive_name(F.col("url"), F.col("dataset_code")).alias("archive_name"))
