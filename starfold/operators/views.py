"""Labelled star views, the way back to the wide source, and the usual recipes."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import as_number, col, matches_label
from starfold.functions.headers import CODE_SUFFIX, DimensionGroup


def stem_of(column: str) -> str:
    """Stem of the dimension that a fact column may be the key of."""
    return column[: -len(CODE_SUFFIX)] if column.endswith(CODE_SUFFIX) else column


def _free_name(name: str, used: set[str]) -> str:
    candidate, number = name, 0
    while candidate in used:
        number += 1
        candidate = f"{name}_{number}"
    used.add(candidate)
    return candidate


def labelled_view(
    fact: DataFrame, dataset_code: str, dimensions: dict[str, DataFrame], unique: Collection[str] = ()
) -> DataFrame | None:
    """Left star join of a fact to every dimension that one of its columns keys.

    ``dimensions`` maps a stem to ``dim_<stem>``. Keys compare as text, because shared
    dimensions hold text while each fact keeps its own type. No join is hinted: the
    planner broadcasts a stored dimension only if its size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and else joins by shuffle, where AQE
    splits hot keys. Stems in ``unique`` have been proven to hold no key twice; told so, the
    planner leaves out their joins where a query uses none of their columns. Returns None
    when no dimension fits.
    """
    view, joined = fact, False
    used = {"dataset_code", *fact.columns}
    for key in fact.columns:
        dim = dimensions.get(stem_of(key))
        if dim is None or key not in dim.columns:
            continue
        attributes = [c for c in dim.columns if c not in ("dataset_code", key)]
        if not attributes:
            continue
        names = {a: _free_name(a, used) for a in attributes}
        side = dim.where(F.col("dataset_code") == dataset_code).select(
            col(key).alias("_key"), *[col(a).alias(n) for a, n in names.items()]
        )
        if stem_of(key) in unique:
            side = side.dropDuplicates(["_key"])
        view = view.join(side, col(key).cast("string") == F.col("_key"), "left").drop("_key")
        joined = True
    if not joined:
        return None
    return view.select(F.lit(dataset_code).alias("dataset_code"), *[col(c) for c in view.columns])


def rehydrate(
    fact: DataFrame,
    dataset_code: str,
    groups: list[DimensionGroup],
    dimensions: dict[str, DataFrame],
    constants: dict[str, str | None],
    types: dict[str, str],
) -> DataFrame:
    """Rebuild the typed wide source: constants first, then every dimension.

    Keys compare null-safe, so that the attributes of a NULL key come back too.
    """
    wide = fact.withColumns(
        {name: F.lit(value).cast(types[name]) for name, value in constants.items()}
    )
    for group in groups:
        side = dimensions[group.stem].where(F.col("dataset_code") == dataset_code).select(
            col(group.key).alias("_key"), *[col(a).cast(types[a]).alias(a) for a in group.attributes]
        )
        same = col(group.key).cast("string").eqNullSafe(F.col("_key"))
        wide = wide.join(side, same, "left").drop("_key")
    return wide.select(*[col(name) for name in types])


def dimension_join(
    fact: DataFrame, dataset_code: str, inner: dict[str, DataFrame], left: dict[str, DataFrame]
) -> DataFrame:
    """Hand-picked dimension joins: ``inner`` must match, ``left`` may miss."""
    view = fact
    for kind, sides in (("inner", inner), ("left", left)):
        for key, dim in sides.items():
            side = dim.where(F.col("dataset_code") == dataset_code).drop("dataset_code")
            side = side.withColumnRenamed(key, "_key")
            view = view.join(side, col(key).cast("string") == F.col("_key"), kind).drop("_key")
    return view


def unified_long(facts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """One long table over datasets of the classic shape, with all cells as text."""
    parts = [
        fact.select(
            F.lit(code).alias("dataset_code"),
            *[
                (col(c).cast("string") if c in fact.columns else F.lit(None).cast("string")).alias(c)
                for c in columns
            ],
        )
        for code, fact in facts.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


# --- recipes on a labelled view -------------------------------------------------


def search_labels(view: DataFrame, code: str, label: str, pattern: str) -> DataFrame:
    """Codes whose label matches a case-insensitive regular expression."""
    return view.where(matches_label(col(label), pattern)).select(code, label).distinct()


def series(view: DataFrame, equal: dict[str, str], columns: list[str]) -> DataFrame:
    """Time series of one selection, ordered by year."""
    for name, value in equal.items():
        view = view.where(col(name) == value)
    return view.select(*columns).orderBy("year")


def compare(view: DataFrame, column: str, values: list[str], columns: list[str]) -> DataFrame:
    """Rows of several members of one dimension, with the value as a number."""
    chosen = view.where(col(column).isin(values))
    return chosen.select(*[as_number(col(c)).alias(c) if c == "value" else col(c) for c in columns])
