"""Build of a whole store: audit, import, enrichment, provenance."""

from __future__ import annotations

import platform
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

import pyspark
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold import __version__
from starfold.functions.cells import archive_name, content_hash, size_in_bytes
from starfold.operators import audit, enrich
from starfold.operators.merge import upsert
from starfold.operators.reduce import Years
from starfold.plans.importer import ImportResult, fact_table, import_archive
from starfold.plans.store import Store, StoreConflict
from starfold.session import SCHEDULER_POOL, materialise, small_frame
from starfold.sources import manifest
from starfold.sources.archives import audit_archives
from starfold.sources.lookup import read_lookup

#: Datasets that are imported side by side.
AT_ONCE = 8

# Columns and types of the provenance tables.
MANIFEST = "meta_manifest"
DATASETS, BUILDS, AREAS = "meta_dataset", "meta_build", "area_classification"
OUTCOME_SCHEMA = "dataset_code string, rows_imported bigint, source_csv_rows bigint, import_status string"
BUILD_SCHEMA = """
    build_id string, started_at timestamp, completed_at timestamp, library_version string,
    spark_version string, python_version string, os string, metadata_snapshot_sha256 string,
    command_line string, config_sha256 string, datasets_imported bigint, datasets_failed bigint
"""


@dataclass(frozen=True)
class BuildResult:
    build_id: str
    imported: dict[str, ImportResult] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: tuple[str, ...] = ()


def _archives(inventory: DataFrame, folder: str) -> DataFrame:
    """Inventory rows with the path, integrity and size of their archives."""
    name = archive_name(F.col("file_location"), F.col("dataset_code"))
    located = inventory.withColumn("archive", F.concat(F.lit(folder.rstrip("/") + "/"), name))
    checked = audit_archives(located.select("archive").distinct())
    return materialise(located.join(checked, "archive", "left"), "archives")


def _note(store: Store, *changes: dict) -> None:
    """Append one line for each change of state; what a change leaves out keeps its value."""
    rows = [
        tuple({**change, "updated_at": f"{time.time_ns():020d}"}.get(f) for f in ["dataset_code", *manifest.FIELDS])
        for change in changes
    ]
    if rows:
        store.append(MANIFEST, small_frame(store.spark, rows, manifest.SCHEMA))


def states(store: Store) -> DataFrame:
    """Latest state of every dataset that any build of the store has seen."""
    return manifest.carried_states(store.read(MANIFEST), "updated_at")


def _unchanged(store: Store, archives: DataFrame) -> set[str]:
    """Datasets that are imported from just these bytes and whose fact is there."""
    if not store.has(MANIFEST):
        return set()
    done = states(store).where("state = 'imported'").select("dataset_code", F.col("archive_sha256").alias("sha256"))
    same = archives.where("ok").join(done, ["dataset_code", "sha256"]).select("dataset_code").collect()
    return {r["dataset_code"] for r in same if store.has(fact_table(r["dataset_code"]))}


def enrich_areas(store: Store, lookup_path: str, with_validity: bool = True) -> int:
    """(Re)build the area classification from ``dim_area`` and a curated lookup file."""
    if not store.has("dim_area"):
        return 0
    lookup = read_lookup(store.spark, lookup_path)
    areas = enrich.classify_areas(store.read("dim_area"), lookup)
    return store.replace(AREAS, enrich.fill_validity(areas, lookup) if with_validity else areas).count()


def _record_datasets(store: Store, archives: DataFrame, outcomes: list[tuple]) -> None:
    """Provenance of the datasets of this build; those of earlier builds stay."""
    done = small_frame(store.spark, outcomes, OUTCOME_SCHEMA)
    rows = archives.join(done, "dataset_code").select(
        "dataset_code",
        "dataset_name",
        "topic",
        "dataset_description",
        "contact",
        "email",
        "date_update",
        "compression_format",
        "file_type",
        "file_location",
        size_in_bytes(F.col("file_size")).alias("file_size_raw"),
        F.col("file_rows").alias("file_rows_declared"),
        "rows_imported",
        "source_csv_rows",
        F.current_timestamp().alias("recorded_at"),
        F.col("source_url").alias("source_metadata_url"),
        F.col("source_hash").alias("source_metadata_hash"),
        F.col("raw_json").alias("source_metadata_json"),
        F.col("sha256").alias("archive_sha256"),
        "import_status",
    )
    store.replace(DATASETS, upsert(store.read(DATASETS), rows, ["dataset_code"]) if store.has(DATASETS) else rows)


def _audited_state(row) -> dict:
    """State of a dataset after the audit of its archive."""
    bad = "failed" if row["reason"] == "missing" else "zip_invalid"
    return {
        "dataset_code": row["dataset_code"],
        "state": "zip_valid" if row["ok"] else bad,
        "archive_path": row["archive"],
        "archive_sha256": row["sha256"],
        "error": row["reason"],
    }


def _imported(store: Store, row, **options) -> ImportResult | Exception:
    """Import one audited archive through a store of its own; a failure is the result.

    The jobs of a dataset go to a pool of their own, so that a session with fair
    scheduling lets small datasets pass beside a large one.
    """
    code, own = row["dataset_code"], Store(store.spark, store.root)
    store.spark.sparkContext.setLocalProperty(SCHEDULER_POOL, f"import-{code}")
    try:
        _note(own, {"dataset_code": code, "state": "importing"})
        return import_archive(own, row["archive"], code, **options)
    except Exception as error:  # recorded with the dataset
        return error
    finally:
        store.spark.sparkContext.setLocalProperty(SCHEDULER_POOL, None)


def _imported_side_by_side(store: Store, rows: list, at_once: int, **options) -> dict:
    """Result or failure of every dataset; the store takes them over at the end.

    Datasets write different partitions, which the log merges. Whoever loses against
    another dataset all the same (a column of two types) is imported again, alone.
    """
    with ThreadPoolExecutor(at_once) as pool:
        found = dict(zip([r["dataset_code"] for r in rows], pool.map(lambda r: _imported(store, r, **options), rows)))
    for row in rows:
        if isinstance(found[row["dataset_code"]], StoreConflict):
            found[row["dataset_code"]] = _imported(store, row, **options)
    store.refresh()
    return found


def build(
    store: Store,
    inventory: DataFrame,
    folder: str,
    *,
    years: Years | None = None,
    keep_raw: bool = False,
    strict: bool = False,
    resume: bool = False,
    lookup_path: str | None = None,
    command_line: str = "",
    at_once: int = AT_ONCE,
) -> BuildResult:
    """Import every dataset of a (selected) inventory from a folder of archives.

    All archives are audited in one distributed job. Datasets are then imported as
    distributed jobs, ``at_once`` of them side by side; a failing one is recorded and the
    build goes on. With ``strict`` they come one by one, and the first failure is the end.
    Every change of a dataset's state is a line of the manifest; with
    ``resume``, datasets that are imported from the same archive bytes are left alone.
    Enrichment is an extra layer, and its failure spoils nothing.
    """
    spark, started = store.spark, datetime.now(timezone.utc)
    result = BuildResult(uuid.uuid4().hex)
    archives = _archives(inventory, folder)
    outcomes: list[tuple] = []
    found = archives.select("dataset_code", "archive", "ok", "reason", "sha256").orderBy("dataset_code").collect()
    skipped = _unchanged(store, archives) if resume else set()
    audited = [r for r in found if r["dataset_code"] not in skipped]
    _note(store, *[_audited_state(r) for r in audited])
    options = {"years": years, "keep_raw": keep_raw}
    groups = [[r] for r in audited] if strict else [audited]
    for group in groups:
        done = _imported_side_by_side(store, [r for r in group if r["ok"]], at_once, **options)
        for row in group:
            code, imported, status = row["dataset_code"], done.get(row["dataset_code"]), "imported"
            if not row["ok"]:
                status = _audited_state(row)["state"]
                result.failed[code] = row["reason"]
            elif isinstance(imported, Exception):
                status, result.failed[code], imported = "failed", str(imported), None
            else:
                result.imported[code] = imported
                if strict and not imported.lossless:
                    result.failed[code] = "row counts differ"
            counts = (imported.row_count, imported.source_row_count) if imported else (None, None)
            outcomes.append((code, *counts, status))
        ended = [(code, status) for code, *_, status in outcomes if code in done]
        _note(store, *[{"dataset_code": c, "state": s, "error": result.failed.get(c)} for c, s in ended])
        if strict and result.failed:
            break
    if lookup_path is not None:
        try:
            enrich_areas(store, lookup_path)
        except Exception as error:
            result.failed["enrichment"] = str(error)
    if outcomes:
        _record_datasets(store, archives, outcomes)
    snapshot = inventory.agg(F.max("source_hash").alias("hash"))
    versions = (result.build_id, started, datetime.now(timezone.utc), __version__, pyspark.__version__)
    counts = (len(result.imported), len(outcomes) - len(result.imported))
    record = spark.createDataFrame(
        [(*versions, platform.python_version(), platform.platform(), None, command_line, None, *counts)],
        BUILD_SCHEMA,
    )
    settings = f"{years!r} {keep_raw} {strict} {lookup_path}"
    record = record.withColumns(
        {
            "metadata_snapshot_sha256": F.lit(snapshot.first()["hash"]),
            "config_sha256": content_hash(F.lit(settings)),
        }
    )
    store.append(BUILDS, record)
    return replace(result, skipped=tuple(sorted(skipped)))


def info(store: Store) -> DataFrame:
    """Imported and failed datasets and the latest build of a store."""
    return audit.build_summary(store.read(DATASETS), store.read(BUILDS))


def problems(store: Store) -> DataFrame:
    """(table_name, problem): fact tables without rows or unreadable, or no fact at all."""
    found, counts = [], {}
    for table in (t for t in store.tables() if t.startswith("data_")):
        try:
            counts[table] = store.read(table).count()
        except Exception as error:  # a lost file or folder is the finding
            found.append((table, f"unreadable: {str(error).splitlines()[0][:200]}"))
    if not counts and not found:
        found.append(("data_*", "no fact table"))
    if counts:
        rows = small_frame(store.spark, list(counts.items()), "table_name string, row_count bigint")
        empty = audit.validate_facts(rows)
        return empty.unionByName(small_frame(store.spark, found, "table_name string, problem string"))
    return small_frame(store.spark, found, "table_name string, problem string")
