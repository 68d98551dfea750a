"""Reductions of one dataset: typing, year filter, markers, dimensions, constants."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import blank_to_null, col, unmarked
from starfold.functions.headers import DimensionGroup, dimension_groups
from starfold.operators.profile import (
    PROTECTED,
    ColumnProfile,
    constant_columns,
    marker_profile,
    profile_columns,
)


@dataclass(frozen=True)
class Years:
    """Years to keep: an explicit set, an open lower bound, or both together."""

    explicit: frozenset[int] = frozenset()
    start: int | None = None

    @classmethod
    def of(cls, *years: int, start: int | None = None) -> Years:
        return cls(frozenset(years), start)

    def predicate(self, year: Column) -> Column:
        """True for a chosen year; a label that is no whole number is never chosen."""
        number = year.try_cast("bigint")
        parts = []
        if self.explicit:
            parts.append(number.isin(sorted(self.explicit)))
        if self.start is not None:
            parts.append(number >= self.start)
        if not parts:
            raise ValueError("a year selection needs years or a start")
        chosen = parts[0] if len(parts) == 1 else parts[0] | parts[1]
        return F.coalesce(chosen, F.lit(False))


def rename_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column by position; none is dropped."""
    return df.toDF(*names)


def filter_years(df: DataFrame, years: Years | None) -> DataFrame:
    """Keep the chosen years; a frame without ``year`` is returned whole."""
    if years is None or "year" not in df.columns:
        return df
    return df.where(years.predicate(col("year")))


def incoming_years(df: DataFrame) -> DataFrame:
    """Whole-number years present in a frame, in order."""
    years = df.select(col("year").try_cast("bigint").alias("year")).distinct()
    return years.where("year IS NOT NULL").orderBy("year")


def typed(df: DataFrame, profiles: dict[str, ColumnProfile]) -> DataFrame:
    """Cast every text column to its profiled type; the profile proved that all fit."""
    return df.select(
        *[
            (
                blank_to_null(col(name))
                if profiles[name].type_name == "string"
                else blank_to_null(col(name)).cast(profiles[name].type_name)
            ).alias(name)
            for name in df.columns
        ]
    )


def strip_markers(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Remove the leading text marker from columns that bear it on every cell.

    Without ``names`` one scan finds them. The columns stay text, zeros and all.
    """
    if names is None:
        found = marker_profile(df).where("non_null > 0 AND marked = non_null").collect()
        names = [row["column_name"] for row in found]
    return df.withColumns({name: unmarked(col(name)) for name in names})


def dimension(df: DataFrame, group: DimensionGroup, dataset_code: str) -> DataFrame:
    """Distinct members of one dimension, all as text, tagged with their dataset.

    Integers are made distinct before they become text, which keeps the hash keys
    narrow. Doubles become text first, because ``-0.0`` and ``0.0`` are one number
    but two texts.
    """
    members = [group.key, *group.attributes]
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    narrow = df.select(
        *[(col(m).cast("string") if m in doubles else col(m)).alias(m) for m in members]
    ).distinct()
    return narrow.select(
        F.lit(dataset_code).alias("dataset_code"), *[col(m).cast("string").alias(m) for m in members]
    )


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys of a dimension that carry more than one set of attributes."""
    return dim.groupBy("dataset_code", key).count().where("count > 1")


@dataclass(frozen=True)
class Layout:
    """Everything one profile pass decides about a dataset."""

    dataset_code: str
    profiles: dict[str, ColumnProfile]
    groups: list[DimensionGroup]
    years: Years | None = None

    @property
    def row_count(self) -> int:
        return next(iter(self.profiles.values())).row_count

    @property
    def stripped(self) -> list[str]:
        return [name for name, p in self.profiles.items() if p.is_stripped]

    @property
    def reduced_columns(self) -> list[str]:
        """Columns left after the dimension attributes moved out."""
        moved = {a for group in self.groups for a in group.attributes}
        return [name for name in self.profiles if name not in moved]

    @property
    def constants(self) -> dict[str, str | None]:
        return {
            name: self.profiles[name].constant_value
            for name in self.reduced_columns
            if name not in PROTECTED and self.profiles[name].is_constant
        }

    @property
    def fact_columns(self) -> list[str]:
        """Columns of the reduced fact table."""
        constants = self.constants
        return [name for name in self.reduced_columns if name not in constants]

    def clean(self, source: DataFrame) -> DataFrame:
        """The typed, year-filtered, marker-free form of the wide source."""
        kept = typed(filter_years(source, self.years), self.profiles)
        return strip_markers(kept, self.stripped)


def plan_layout(source: DataFrame, dataset_code: str, years: Years | None = None) -> Layout:
    """Profile a wide all-text source once and settle its star layout."""
    applied = years if years is not None and "year" in source.columns else None
    keep = None if applied is None else applied.predicate(col("year"))
    profiles = profile_columns(source, keep)
    doubtful = [name for name, p in profiles.items() if p.is_doubtful]
    if doubtful:
        # Rare second pass over these columns only: their typed values decide.
        rows = typed(filter_years(source, applied), profiles).select(*[col(n) for n in doubtful])
        for row in constant_columns(rows, protect=()).collect():
            name = row["column_name"]
            profiles[name] = replace(
                profiles[name], is_constant=True, constant_value=row["constant_value"]
            )
    return Layout(dataset_code, profiles, dimension_groups(source.columns), applied)
