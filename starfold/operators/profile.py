"""One-pass column profile: types, text markers and constants of a whole dataset.

Every figure is a plain aggregate without DISTINCT, so a profile is a scan with partial
aggregation in each task and one small merge. Wide sources are profiled in slices of
columns, each of which reads its own columns only, so time stays linear in the width.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.cells import (
    DOUBLE,
    INTEGER,
    LONG,
    NULL,
    RANK_OF_TYPE,
    TEXT,
    TYPE_OF_RANK,
    cell_rank,
    cell_rank_sql,
    col,
    is_marked,
    quote_identifier,
    rank_type,
    unmarked,
)

# Columns that stay in a fact table even when every row holds the same value.
PROTECTED = ("value", "year")
# Rows looked at before the full scan, to settle what a few rows can settle.
HEAD_ROWS = 1000
# Columns in one aggregate. Beyond some dozens the generated code of a stage outgrows what
# the JVM compiles, and every cell is worked on by interpreted code.
SLICE = 24


@dataclass(frozen=True)
class ColumnProfile:
    """What the profile found for one column."""

    name: str
    rank: int
    row_count: int
    non_null: int | None
    marked: int | None
    is_constant: bool
    constant_value: str | None
    is_doubtful: bool = False

    @property
    def type_name(self) -> str:
        return TYPE_OF_RANK[self.rank]

    @property
    def is_stripped(self) -> bool:
        counted = self.marked is not None and self.marked == self.non_null > 0
        return counted and self.type_name == "string"


def _long_form(df: DataFrame, names: list[str], figures: Callable[[str], Column]) -> DataFrame:
    """One aggregated struct per column, turned into one row per column, slice by slice."""
    slices = []
    for start in range(0, max(len(names), 1), SLICE):
        part = names[start : start + SLICE]
        slots = [f"_p{i}" for i in range(len(part))]
        wide = df.agg(*[figures(name).alias(slot) for slot, name in zip(slots, part)])
        slices.append(wide.select(F.inline(F.array(*slots))))
    return reduce(DataFrame.unionAll, slices)


def infer_types(df: DataFrame) -> DataFrame:
    """Narrowest exact type of every column of an all-text frame, by a full scan."""

    def figures(name: str) -> Column:
        rank = F.max(cell_rank(name))
        return F.struct(F.lit(name).alias("column_name"), rank.alias("type_rank"))

    ranks = _long_form(df, df.columns, figures)
    return ranks.select("column_name", rank_type(F.col("type_rank")).alias("type_name"))


def marker_profile(df: DataFrame) -> DataFrame:
    """Non-null and marker-prefixed cells of every text column, in one scan."""

    def figures(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(col(name)).alias("non_null"),
            F.count_if(is_marked(col(name))).alias("marked"),
        )

    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return _long_form(df, text, figures)


@dataclass(frozen=True)
class Wanted:
    """Which figures of a column a scan has to find."""

    rank: bool = True
    marks: bool = True
    bounds: bool = True


def profile(
    df: DataFrame, keep: Column | None = None, wanted: dict[str, Wanted] | None = None
) -> DataFrame:
    """Profile of an all-text frame, one row per column, in one scan.

    Types come from every row. Markers and constants come from the rows that ``keep``
    accepts, because the year filter runs after typing and before the reductions.
    ``wanted`` leaves figures out; columns that need none are not read.

    A column is constant when all its cells are NULL, or none is and all hold the same
    value. Cells compare as text here; ``is_doubtful`` marks the rare numeric column
    whose least and greatest text are one number, such as ``1`` and ``1.0``, which only
    a look at the typed values can settle.
    """
    # Blank cells and the row choice are settled once, below the aggregates, which then
    # work on plain columns.
    cells = [F.nullif(col(name), F.lit("")).alias(name) for name in df.columns]
    kept_flag = [] if keep is None else [F.coalesce(keep, F.lit(False)).alias("_kept")]
    rows = df.select(*cells, *kept_flag)
    kept_rows = "count(1)" if keep is None else "count_if(_kept)"

    def figures(name: str) -> Column:
        want = Wanted() if wanted is None else wanted[name]
        cell = quote_identifier(name)
        kept = cell if keep is None else f"CASE WHEN _kept THEN {cell} END"
        rank = f"coalesce(max({cell_rank_sql(name)}), {NULL})" if want.rank else str(TEXT)
        counted = f"count({kept})" if want.marks or want.bounds else "CAST(NULL AS BIGINT)"
        marked = f"count_if(startswith({kept}, '\\''))" if want.marks else "CAST(NULL AS BIGINT)"
        low, high = (f"min({kept})", f"max({kept})") if want.bounds else ("CAST(NULL AS STRING)",) * 2
        text = name.replace("\\", "\\\\").replace("'", "\\'")
        return F.expr(
            f"""named_struct('column_name', '{text}', 'type_rank', {rank},
            'row_count', {kept_rows}, 'non_null', {counted}, 'marked', {marked},
            'low', {low}, 'high', {high})"""
        )

    return with_verdicts(_long_form(rows, df.columns, figures))


def _head_profile(df: DataFrame, keep: Column | None) -> dict[str, ColumnProfile]:
    """Profile of the first rows, cell by cell: one small aggregate for all columns."""
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    head = df.limit(HEAD_ROWS).withColumn("_kept", kept)
    cells = head.unpivot("_kept", [col(c) for c in df.columns], "column_name", "cell")
    cells = cells.withColumn("cell", F.nullif("cell", F.lit("")))
    chosen = F.when(F.col("_kept"), F.col("cell"))
    figures = cells.groupBy("column_name").agg(
        F.max(cell_rank("cell")).alias("type_rank"),
        F.count_if("_kept").alias("row_count"),
        F.count(chosen).alias("non_null"),
        F.count_if(is_marked(chosen)).alias("marked"),
        F.min(chosen).alias("low"),
        F.max(chosen).alias("high"),
    )
    found = collect_profile(with_verdicts(figures))
    unseen = ColumnProfile("", NULL, 0, 0, 0, False, None)
    return {name: found.get(name, replace(unseen, name=name)) for name in df.columns}


def profile_columns(df: DataFrame, keep: Column | None = None) -> dict[str, ColumnProfile]:
    """Exact profile of every column, at the price of the open questions only.

    A few rows are looked at first, and only where they settle a question for good: one
    text cell makes a column text, one cell without marker keeps it as it is, and two
    values mean that it is not constant. No answer is ever inferred from their silence;
    everything still open is decided by a scan of all rows, which reads just the
    columns in question.
    """
    head = _head_profile(df, keep)

    def open_questions(found: ColumnProfile) -> Wanted:
        mixed = 0 < found.non_null < found.row_count
        varies = found.non_null > 0 and not found.is_constant and not found.is_doubtful
        return Wanted(
            rank=found.rank != TEXT,
            marks=found.marked == found.non_null,
            bounds=not (mixed or varies) and found.name not in PROTECTED,
        )

    wanted = {name: open_questions(found) for name, found in head.items()}
    return collect_profile(profile(df, keep, wanted))


def with_verdicts(figures: DataFrame) -> DataFrame:
    """Add type name, strip and constant verdicts to raw profile figures."""
    rank, low, high = F.col("type_rank"), F.col("low"), F.col("high")
    is_number = rank.isin(INTEGER, LONG, DOUBLE)
    stripped = ~is_number & (F.col("non_null") > 0) & (F.col("marked") == F.col("non_null"))
    all_null = F.col("non_null") == 0
    filled = (F.col("non_null") == F.col("row_count")) & ~all_null
    number = low.try_cast("double")
    value = (
        F.when(rank.isin(INTEGER, LONG), low.try_cast("bigint").cast("string"))
        .when(rank == DOUBLE, number.cast("string"))
        .when(stripped, unmarked(low))
        .otherwise(low)
    )
    constant = (F.col("row_count") > 0) & (all_null | (filled & (low == high)))
    doubtful = is_number & filled & (low != high) & (number == high.try_cast("double"))
    return figures.select(
        "column_name",
        "type_rank",
        rank_type(rank).alias("type_name"),
        "row_count",
        "non_null",
        "marked",
        F.coalesce(stripped, F.lit(False)).alias("is_stripped"),
        F.coalesce(constant, F.lit(False)).alias("is_constant"),
        F.when(constant & ~all_null, value).alias("constant_value"),
        F.coalesce(doubtful, F.lit(False)).alias("is_doubtful"),
    )


def collect_profile(profiled: DataFrame) -> dict[str, ColumnProfile]:
    """The profile on the driver: one small row per column of the dataset."""
    return {
        row["column_name"]: ColumnProfile(
            row["column_name"],
            row["type_rank"],
            row["row_count"],
            row["non_null"],
            row["marked"],
            row["is_constant"],
            row["constant_value"],
            row["is_doubtful"],
        )
        for row in profiled.collect()
    }


def constant_columns(df: DataFrame, protect: tuple[str, ...] = PROTECTED) -> DataFrame:
    """Columns of a typed frame that hold one value (or only NULL) on every row.

    ``min = max`` finds them without counting distinct values.
    """

    def figures(name: str) -> Column:
        c = col(name)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count(c).alias("non_null"),
            F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias("same"),
            F.min(c).cast("string").alias("constant_value"),
        )

    checked = [name for name in df.columns if name not in protect]
    empty = "non_null = 0"
    return (
        _long_form(df, checked, figures)
        .where(f"row_count > 0 AND ({empty} OR (same AND non_null = row_count))")
        .select("column_name", "constant_value")
    )


def widest_type(first: str, second: str) -> str:
    """Common type of two numeric-or-text types that loses nothing."""
    return max(first, second, key=lambda name: RANK_OF_TYPE[name])
