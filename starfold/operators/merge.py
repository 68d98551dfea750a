"""Set and table-maintenance operators: replace, upsert, year slices, dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import col
from starfold.operators.profile import ColumnProfile, widest_type


def replace_slice(table: DataFrame, slice_: DataFrame, dataset_code: str) -> DataFrame:
    """Replace one dataset's rows of a shared table and widen it to new columns."""
    others = table.where(~F.col("dataset_code").eqNullSafe(dataset_code))
    return others.unionByName(slice_, allowMissingColumns=True)


def widen(table: DataFrame, slice_: DataFrame) -> DataFrame:
    """Append rows that may bring new columns; missing cells become NULL."""
    return table.unionByName(slice_, allowMissingColumns=True)


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace the rows of ``table`` with the same key."""
    untouched = table.join(changes.select(*keys), keys, "left_anti")
    return untouched.select(*table.columns).unionByName(changes, allowMissingColumns=True)


def append_members(dim: DataFrame, members: DataFrame, key: str, only_new: bool = False) -> DataFrame:
    """Add members whose key the dimension does not hold yet for their dataset.

    Keys compare null-safe, so that a NULL member is not added again on every run.
    ``only_new`` returns just the rows to add.
    """
    stored = dim.select(F.col("dataset_code").alias("_code"), col(key).alias("_key"))
    same = members["dataset_code"].eqNullSafe(stored["_code"]) & members[key].eqNullSafe(stored["_key"])
    fresh = members.join(stored, same, "left_anti")
    return fresh if only_new else dim.unionByName(fresh, allowMissingColumns=True)


def drop_years(existing: DataFrame, years: list[int]) -> DataFrame:
    """Rows outside the given years; rows without a whole-number year stay."""
    if not years:
        return existing
    chosen = F.coalesce(col("year").try_cast("bigint").isin(years), F.lit(False))
    return existing.where(~chosen)


def merge_years(existing: DataFrame, incoming: DataFrame, years: list[int]) -> DataFrame:
    """Replace exactly the given years by the incoming rows; keep all other years.

    No row is shuffled. Running it again with the same slice changes nothing.
    """
    if not years:
        return existing
    return drop_years(existing, years).unionByName(incoming, allowMissingColumns=True)


@dataclass(frozen=True)
class MergePlan:
    """How a stored fact and an incoming slice come to one schema."""

    types: dict[str, str]
    restored: dict[str, str | None] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    constants: dict[str, str | None] = field(default_factory=dict)

    def changes_schema(self, existing: DataFrame) -> bool:
        """True when stored rows must be rewritten."""
        return bool(self.restored) or dict(existing.dtypes) != self.types

    def _project(self, df: DataFrame, fill: dict[str, str | None]) -> DataFrame:
        def cell(name: str, kind: str) -> Column:
            if name in df.columns:
                return col(name).cast(kind).alias(name)
            return F.lit(fill.get(name)).cast(kind).alias(name)

        return df.select(*[cell(name, kind) for name, kind in self.types.items()])

    def stored_rows(self, existing: DataFrame) -> DataFrame:
        """Stored rows with restored constants and common types."""
        return self._project(existing, self.restored)

    def incoming_rows(self, incoming: DataFrame) -> DataFrame:
        return self._project(incoming, {})


def plan_merge(
    existing: DataFrame,
    constants: dict[str, str | None],
    incoming: DataFrame,
    profiles: dict[str, ColumnProfile],
) -> MergePlan:
    """Reconcile the schemas of a stored fact and an incoming, unreduced slice.

    A column that was dropped as constant stays dropped while the slice holds the same
    constant; otherwise it comes back, with the recorded value on the stored rows. A
    column the slice lacks is padded with NULL. Differing types widen, so that no cell
    is rounded or refused.
    """
    stored = dict(existing.dtypes)
    arriving = dict(incoming.dtypes)
    constants = dict(constants)
    types = dict(stored)
    restored: dict[str, str | None] = {}
    dropped: list[str] = []

    if "year" not in stored:
        if "year" not in constants:
            raise ValueError("cannot merge years: the stored fact has no year column")
        restored["year"] = constants.pop("year")
        types["year"] = arriving["year"]
    for name, kind in arriving.items():
        if name in stored:
            types[name] = widest_type(stored[name], kind)
        elif name not in restored:
            found = profiles[name]
            if name in constants and found.is_constant and found.constant_value == constants[name]:
                dropped.append(name)
                continue
            restored[name] = constants.pop(name, None)
            types[name] = widest_type(kind, _type_of_text(restored[name]))
    return MergePlan(types, restored, dropped, constants)


def _type_of_text(value: str | None) -> str:
    """Narrowest type of one recorded constant."""
    if value is None:
        return "int"
    try:
        whole = int(value)
    except ValueError:
        try:
            float(value)
        except ValueError:
            return "string"
        return "double"
    if str(whole) != value:
        return "string"
    return "int" if -(2**31) <= whole < 2**31 else "bigint" if -(2**63) <= whole < 2**63 else "double"


def latest_state(log: DataFrame, key: str, order: str, fields: list[str], carried: list[str]) -> DataFrame:
    """Latest entry per key of an append-only log.

    ``fields`` come from the last entry; ``carried`` fields keep their last non-null
    value. One partial aggregate per task, whatever the length of a key's history.
    """
    last = [F.max_by(col(f), col(order)).alias(f) for f in fields]
    kept = [
        F.expr(f"max_by(`{f}`, `{order}`) FILTER (WHERE `{f}` IS NOT NULL)").alias(f) for f in carried
    ]
    return log.groupBy(key).agg(*last, *kept)


def flag_legend(rows: DataFrame, dataset_code: str) -> DataFrame:
    """Flag legend of a dataset: one description per code, the smallest of several.

    Equal pairs collapse in a hash aggregate before the smallest is looked for.
    """
    pairs = rows.where("flag_code IS NOT NULL").select("flag_code", "flag_description").distinct()
    return (
        pairs.groupBy("flag_code")
        .agg(F.min("flag_description").alias("flag_description"))
        .select(F.lit(dataset_code).alias("dataset_code"), "flag_code", "flag_description")
    )


def legend_columns(names: list[str]) -> tuple[str, str | None] | None:
    """Code and description column of a legend by its normalised names.

    None when no column can be told to be the code.
    """
    codes = [n for n in names if n.endswith("flag_code")] or [n for n in names if "flag" in n]
    if not codes:
        return None
    known = ("description", "flag_description", "label", "flags")
    described = [n for n in names if n in known and n != codes[0]]
    described = described or [n for n in names if n != codes[0]]
    return codes[0], described[0] if described else None
