"""Shards by a keyed permutation of global row numbers.

Every row has a number in the order of the given columns. A balanced Feistel network
permutes the smallest power of four that holds all numbers; a number that leaves the
range walks on along its cycle until it is back. Position p then goes to shard
p mod shards, slot p div shards. Both ways are computable for a single row, without the
table: ``place`` and its inverse ``row_at``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import stored, text_or_empty
from starfold.session import ship_by_value

ship_by_value(__name__)

ROUNDS = 6
#: Row numbers inside a partition take the low bits of Spark's increasing id.
LOW_BITS = 33


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A bijection of 0 .. n-1, the same for the same n and seed everywhere."""

    def __init__(self, n: int, seed: int = 0):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        steps = np.arange(1, ROUNDS + 1, dtype=np.uint64)
        self.keys = _mixed(np.uint64(seed) + steps * np.uint64(0x9E3779B97F4A7C15))

    def _round(self, half: np.ndarray, key: np.uint64) -> np.ndarray:
        return _mixed(half ^ key) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, rows, step) -> np.ndarray:
        at = step(np.asarray(rows).astype(np.uint64))
        while (out := at >= np.uint64(self.n)).any():
            at[out] = step(at[out])
        return at.astype(np.int64)

    def forward(self, rows) -> np.ndarray:
        return self._walk(rows, self._forward)

    def backward(self, positions) -> np.ndarray:
        return self._walk(positions, self._backward)


def place(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    at = int(Permutation(n, seed).forward([row])[0])
    return at % shards, at // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """Row number that lies in a slot of a shard."""
    return int(Permutation(n, seed).backward([slot * shards + shard])[0])


def permuted(row: Column, n: int, seed: int = 0) -> Column:
    """Position of a row number, for whole Arrow batches at a time."""

    @F.pandas_udf("long")
    def position(rows: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, seed).forward(rows.to_numpy()))

    return position(row)


def numbered(df: DataFrame, order: list[str], row: str = "row") -> tuple[DataFrame, int]:
    """Add gapless row numbers from 0 in the order of the columns; and the number of rows.

    Rows are dealt by range, numbered inside each range, and written once, so that a
    repeated task cannot number them otherwise. Nulls come first. Rows that are equal
    in all order columns are told apart by a seeded number, so that many of them
    spread over ranges; which of them comes first is open. A column that has the
    name ``row`` is replaced.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c != row]
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    dealt = stored(
        df.select(*kept, F.rand(17).alias("_tie"))
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .drop("_tie"),
        "numbered",
    )
    part = F.shiftright("_id", LOW_BITS)
    # One row for each range: as many as shuffle partitions.
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    n = dealt.count()
    number = F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    rows = dealt.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return rows.select(*kept, number.alias(row)), n


def shard_rows(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long); shards differ by one row at most.

    An empty table gives an empty result. Nulls and repeated rows are rows like any
    other. Columns named row, shard or slot are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    kept = [c for c in df.columns if c not in ("row", "shard", "slot")]
    rows, n = numbered(df.select(*kept), order)
    at = rows.withColumn("_at", permuted(F.col("row"), max(n, 1), seed))
    return at.select(
        *kept,
        "row",
        (F.col("_at") % shards).cast("int").alias("shard"),
        F.expr(f"_at div {shards}").alias("slot"),
    )


def shard_documents(documents: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Size, checksum and place of every document, by the law of equal row counts.

    A null text has size 16 and the checksum of an empty text, 0.
    """
    text = text_or_empty()
    narrow = documents.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = shard_rows(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row",
    )
