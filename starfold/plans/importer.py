"""Import of one dataset: wide source to fact, dimensions, constants and mapping."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import col, safe_name
from starfold.functions.headers import DimensionGroup, dimension_groups, normalise_names, role_of
from starfold.operators.audit import pick_flag_member, pick_main_member
from starfold.operators.merge import append_members, merge_years, plan_merge
from starfold.operators.profile import widest_type
from starfold.operators.reduce import (
    Layout,
    Years,
    dimension,
    filter_years,
    incoming_years,
    plan_layout,
    repeated_keys,
    typed,
)
from starfold.operators.views import labelled_view, rehydrate
from starfold.plans.store import Store, escape_value
from starfold.session import SCHEDULER_POOL, materialise, scratch_dir, small_frame
from starfold.sources.archives import list_members, unpack_members
from starfold.sources.csv_files import (
    count_source_rows,
    csv_header,
    scan_csv,
    source_facts,
)
from starfold.sources.lookup import read_flag_legend

CONSTANTS, MAPPING = "meta_constant_column", "meta_column_mapping"
# Tables of one dataset that are written side by side.
WRITERS = 8
CONSTANT_SCHEMA = "dataset_code string, table_name string, column_name string, value string"
MAPPING_SCHEMA = """
    dataset_code string, table_name string, original_column_name string,
    normalized_column_name string, inferred_role string, type_name string, ordinal int
"""


def fact_table(dataset_code: str) -> str:
    return f"data_{safe_name(dataset_code)}"


def raw_table(dataset_code: str) -> str:
    return f"raw_{safe_name(dataset_code)}"


@dataclass(frozen=True)
class ImportResult:
    """What one import produced.

    ``row_count`` is the rows of the fact table afterwards; ``appended_rows`` is what
    this import brought when it merged into a stored fact. ``repeated_keys`` names the
    dimensions in which some key carries several sets of attributes, since a labelled
    view repeats the rows of such keys.
    """

    dataset_code: str
    table_name: str
    row_count: int
    source_row_count: int
    count_method: str
    years: tuple[int, ...] | None = None
    appended_rows: int | None = None
    flag_rows: int = 0
    repeated_keys: tuple[str, ...] = ()

    @property
    def lossless(self) -> bool:
        return self.years is not None or self.row_count == self.source_row_count


def recorded_constants(store: Store, dataset_code: str) -> dict[str, str | None]:
    """Constant columns on record for one dataset; at most one row per column."""
    if not store.has(CONSTANTS):
        return {}
    rows = store.read(CONSTANTS).where(F.col("dataset_code") == dataset_code)
    return {r["column_name"]: r["value"] for r in rows.collect()}


def _record_constants(store: Store, dataset_code: str, constants: dict[str, str | None]) -> None:
    table = fact_table(dataset_code)
    rows = [(dataset_code, table, name, value) for name, value in constants.items()]
    store.replace_rows(CONSTANTS, small_frame(store.spark, rows, CONSTANT_SCHEMA), dataset_code, not rows)


def recorded_types(store: Store, dataset_code: str) -> dict[str, str]:
    """Columns of a stored dataset's wide source, in order, with their types."""
    if not store.has(MAPPING):
        return {}
    rows = store.read(MAPPING).where(F.col("dataset_code") == dataset_code).orderBy("ordinal")
    return {r["normalized_column_name"]: r["type_name"] for r in rows.collect()}


def _record_mapping(store: Store, layout: Layout, raw_names: list[str], append: bool) -> None:
    """Record renames, roles and types; a merged slice only ever widens a type."""
    code = layout.dataset_code
    before = recorded_types(store, code) if append else {}
    rows = [
        (
            code,
            fact_table(code),
            raw,
            name,
            role_of(name),
            widest_type(before.get(name, found.type_name), found.type_name),
            ordinal,
        )
        for ordinal, (raw, (name, found)) in enumerate(zip(raw_names, layout.profiles.items()), 1)
    ]
    store.replace_rows(MAPPING, small_frame(store.spark, rows, MAPPING_SCHEMA), code, not rows)


def _store_dimension(store: Store, clean: DataFrame, layout: Layout, group: DimensionGroup, append: bool) -> None:
    members = dimension(clean, group, layout.dataset_code)
    if append and store.has(group.table):
        stored = store.read(group.table).where(F.col("dataset_code") == layout.dataset_code)
        known = [c for c in members.columns if c in stored.columns]
        fresh = append_members(stored.select(*known), members, group.key, only_new=True)
        store.widen(group.table, members)
        store.add_partitions(group.table, fresh)
    else:
        store.replace_dimension(group.table, members, layout.dataset_code, layout.row_count == 0)


def _repeated(store: Store, layout: Layout) -> tuple[str, ...]:
    """Dimensions of a dataset in which some key has several sets of attributes.

    Of all others the store notes that their keys are unique, which lets the planner
    leave out joins that a query of the labelled view does not need.
    """
    found = None
    for group in layout.groups:
        slice_ = store.read(group.table).where(F.col("dataset_code") == layout.dataset_code)
        hit = repeated_keys(slice_, group.key).select(F.lit(group.table).alias("name")).limit(1)
        found = hit if found is None else found.unionByName(hit)
    repeated = set() if found is None else {r["name"] for r in found.collect()}
    with store.batch():
        for group in layout.groups:
            if group.table not in repeated:
                store.mark_unique(group.table, escape_value(store.spark, layout.dataset_code), group.key)
    return tuple(sorted(repeated))


def _year_partition(df: DataFrame) -> str | None:
    """Facts are partitioned by year where the year is a whole number on every row."""
    return "year" if dict(df.dtypes).get("year") == "int" and len(df.columns) > 1 else None


def _merge(store: Store, clean: DataFrame, layout: Layout, years: tuple[int, ...]) -> None:
    """Bring a reduced year slice into the stored fact of its dataset.

    Only the folders of these years are written; the log knows which years there are. A
    constant that comes back is a value that the log has for the other years, and a wider
    type is a cast on read, so no stored row is read or rewritten for either.
    """
    code, table = layout.dataset_code, fact_table(layout.dataset_code)
    existing = store.read(table)
    incoming = clean.select(*[col(c) for c in layout.reduced_columns])
    constants = recorded_constants(store, code)
    plan = plan_merge(existing, constants, incoming, layout.profiles)
    arriving = plan.incoming_rows(incoming)
    if store.partition_column(table) == "year" and plan.types["year"] == "int":
        store.overwrite_partitions(
            table,
            arriving,
            tuple(str(y) for y in years),
            fills=plan.restored,
            widened=plan.changes_schema(existing),
        )
    else:
        merged = merge_years(plan.stored_rows(existing), arriving, list(years))
        store.replace(table, merged, _year_partition(merged))
    if plan.constants != constants:
        _record_constants(store, code, plan.constants)


def import_frame(
    store: Store,
    staged: DataFrame,
    dataset_code: str,
    *,
    raw_names: list[str] | None = None,
    years: Years | None = None,
    keep_raw: bool = False,
) -> ImportResult:
    """Import a staged, all-text, wide frame with normalised column names.

    One profile pass decides types, markers, dimensions and constants. All later
    passes read only the columns they need. With a year selection and a stored fact,
    the chosen years are merged into it; otherwise the dataset is replaced.
    """
    table = fact_table(dataset_code)
    layout = plan_layout(staged, dataset_code, years)
    clean = layout.clean(staged)
    applied: tuple[int, ...] | None = None
    if layout.years is not None:
        applied = tuple(sorted(layout.years.explicit))
        if layout.years.start is not None:
            applied = tuple(r["year"] for r in incoming_years(clean).collect())

    def write_raw() -> None:
        rows = typed(filter_years(staged, layout.years), layout.profiles)
        store.replace(raw_table(dataset_code), rows)

    def write_fact() -> None:
        if append:
            if applied:
                _merge(store, clean, layout, applied)
            return
        fact = clean.select(*[col(c) for c in layout.fact_columns])
        store.replace(table, fact, _year_partition(fact))
        if layout.row_count:
            _record_constants(store, dataset_code, layout.constants)

    context = store.spark.sparkContext
    own_pool = (SCHEDULER_POOL, context.getLocalProperty(SCHEDULER_POOL))
    writers = ThreadPoolExecutor(WRITERS, initializer=context.setLocalProperty, initargs=own_pool)
    with store.batch(), writers as pool:
        append = applied is not None and store.has(table)
        # The writes do not depend on each other: their jobs share the executors.
        writes = [write_fact, lambda: _record_mapping(store, layout, raw_names or list(staged.columns), append)]
        writes += [partial(_store_dimension, store, clean, layout, group, append) for group in layout.groups]
        writes += [write_raw] if keep_raw else []
        for done in [pool.submit(write) for write in writes]:
            done.result()
    repeated = _repeated(store, layout)
    # What was written is counted, not what was to be written: file footers tell.
    total = store.read(table).count()
    return ImportResult(
        dataset_code,
        table,
        total,
        layout.row_count,
        "staged-count",
        applied,
        layout.row_count if append else None,
        0,
        repeated,
    )


def import_csv(
    store: Store,
    path: str,
    dataset_code: str,
    *,
    years: Years | None = None,
    keep_raw: bool = False,
) -> ImportResult:
    """Import one CSV source. The text is parsed once, into a staged Parquet table.

    A line scan first settles the encoding, the physical line count and whether the
    file can be parsed in splits.
    """
    spark = store.spark
    facts = source_facts(spark, path)
    raw_names = csv_header(spark, path, facts.encoding)
    names = normalise_names(raw_names)
    parsed = scan_csv(spark, path, names, facts.encoding, facts.has_multi_line)
    with scratch_dir(spark, f"staged-{safe_name(dataset_code)}") as folder:
        parsed.write.parquet(folder)
        staged = spark.read.schema(parsed.schema).parquet(folder)
        result = import_frame(
            store, staged, dataset_code, raw_names=raw_names, years=years, keep_raw=keep_raw
        )
    source_rows, method = count_source_rows(spark, path, facts)
    return replace(result, source_row_count=source_rows, count_method=method)


def import_legend(store: Store, path: str, dataset_code: str) -> int:
    """Load a flag legend file into ``dim_flag``; returns its rows."""
    legend = read_flag_legend(store.spark, path, dataset_code)
    if legend is None:
        return 0
    rows = materialise(legend, "legend")
    n = rows.count()
    store.replace_dimension("dim_flag", rows, dataset_code, n == 0)
    return n


def import_archive(
    store: Store,
    archive: str,
    dataset_code: str,
    *,
    years: Years | None = None,
    keep_raw: bool = False,
) -> ImportResult:
    """Import the main CSV of an archive, then its flag legend if it has one.

    Members are unpacked into the shared folder and deleted after the import.
    """
    archives = small_frame(store.spark, [(archive,)], "archive string")
    members = materialise(list_members(archives), "members")
    ties, kept = ["member_index"], ["member_index", "name"]
    main, legend = pick_main_member(members, ties, kept), pick_flag_member(members, ties, kept)
    if main.isEmpty():
        raise ValueError(f"no CSV member in {archive}")
    flag_rows = 0
    with scratch_dir(store.spark, f"unpacked-{safe_name(dataset_code)}") as path:
        unpack_members(main).select("value").write.text(path)
        result = import_csv(store, path, dataset_code, years=years, keep_raw=keep_raw)
    if not legend.isEmpty():
        with scratch_dir(store.spark, "legend") as path:
            unpack_members(legend).select("value").write.text(path)
            flag_rows = import_legend(store, path, dataset_code)
    return replace(result, flag_rows=flag_rows)


# --- reading back ------------------------------------------------------------------


def _dataset_dimensions(store: Store, dataset_code: str) -> dict[str, DataFrame]:
    """Dimensions by stem, with only the attributes that this dataset fills."""
    filled = set(recorded_types(store, dataset_code))
    filled |= {"dataset_code", "flag_code", "flag_description"}
    dimensions = {}
    for table in store.tables():
        if table.startswith("dim_"):
            dim = store.read(table)
            names = [c for c in dim.columns if c in filled]
            dimensions[table[len("dim_") :]] = dim.select(*[col(c) for c in names])
    return dimensions


def labelled(store: Store, dataset_code: str) -> DataFrame | None:
    """Labelled view of a stored dataset."""
    fact = store.read(fact_table(dataset_code))
    value = escape_value(store.spark, dataset_code)
    dimensions = _dataset_dimensions(store, dataset_code)
    unique = {stem for stem in dimensions if store.unique_key(f"dim_{stem}", value)}
    return labelled_view(fact, dataset_code, dimensions, unique)


def rebuild_source(store: Store, dataset_code: str) -> DataFrame:
    """The typed wide source of a stored dataset, from fact, dimensions and constants."""
    types = recorded_types(store, dataset_code)
    return rehydrate(
        store.read(fact_table(dataset_code)),
        dataset_code,
        dimension_groups(list(types)),
        _dataset_dimensions(store, dataset_code),
        recorded_constants(store, dataset_code),
        types,
    )


def register_views(store: Store) -> list[str]:
    """A temporary view per table, and ``view_<code>_labelled`` per dataset, for plain SQL."""
    names = store.register_views()
    datasets = store.read(MAPPING).select("dataset_code", "table_name").distinct() if store.has(MAPPING) else None
    for row in datasets.collect() if datasets is not None else []:
        view = labelled(store, row["dataset_code"]) if store.has(row["table_name"]) else None
        if view is not None:
            name = f"view_{safe_name(row['dataset_code'])}_labelled"
            view.createOrReplaceTempView(name)
            names.append(name)
    return names
