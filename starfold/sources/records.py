"""Records of delimited text put together from lines, in splits of files.

A line ends a record if the number of quotes before its end is even. Blocks are summed up
first: the parity of a block's quotes is all that later blocks need of it. Tasks then walk
their blocks in one of two states, inside a quoted cell or not, and put records together.
What a block cannot finish, the end of the last block's record and the beginning of the
next one's, are fragments; only these are shuffled and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.session import materialise, ship_by_value

ship_by_value(__name__)

#: Kinds of what a block gives: the rest of an earlier record, a block inside one record,
#: the beginning of a later one, and a whole record.
HEAD, MIDDLE, TAIL, WHOLE = 0, 1, 2, 3
SCHEMA = "file string, block long, kind int, record binary"
_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("record", pa.binary())])


def _blocks_inside(lines: DataFrame) -> np.ndarray:
    """Numbers of the blocks that begin inside a quoted cell, ascending.

    One long for such a block, whatever its size: eight megabytes for a million blocks.
    """
    blocks = lines.groupBy("file", "block").agg(F.sum(F.col("odd").cast("long")).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    found = blocks.withColumn("inside", inside).where("inside").select(F.xxhash64("file", "block").alias("number"))
    return np.sort(np.array([r["number"] for r in found.collect()], np.int64))


class _Walk:
    """One block, line by line."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block = file, block
        self.inside, self.begun_inside = inside, inside
        self.first = block == 0
        self.held: list[bytes] = []

    def lines(self, column: pa.Array, odd: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
        """(kind, records) of some lines."""
        if not odd.any() and not self.inside:
            if self.first and len(column):
                column, self.first = column[1:], False  # the header
            yield WHOLE, column
            return
        whole = []
        for line, turns in zip(column.to_pylist(), odd.tolist()):
            self.held.append(line)
            self.inside ^= turns
            if not self.inside:
                record, self.held = b"\n".join(self.held), []
                if self.begun_inside:
                    self.begun_inside = False
                    yield HEAD, [record]
                elif self.first:
                    self.first = False
                else:
                    whole.append(record)
        if whole:
            yield WHOLE, whole

    def end(self) -> Iterator[tuple[int, list[bytes]]]:
        if self.held and not self.first:
            yield MIDDLE if self.begun_inside else TAIL, [b"\n".join(self.held)]


def _walked(inside):
    """Task function: (file, block, line, odd) in order to (file, block, kind, record)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Walk | None = None

        def rows(walk: _Walk, found) -> Iterator[pa.RecordBatch]:
            for kind, records in found:
                n = len(records)
                column = records.cast(pa.binary()) if isinstance(records, pa.Array) else pa.array(records, pa.binary())
                columns = [pa.array([walk.file] * n), np.full(n, walk.block), np.full(n, kind, np.int32), column]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=_ARROW)

        for batch in batches:
            files, blocks, numbers = batch.column(0), batch.column(1).to_numpy(), batch.column(4).to_numpy()
            odd = np.array(batch.column(3).to_pylist(), bool)
            new = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])).tolist() if len(numbers) else []
            for a, b in zip(new, [*new[1:], len(numbers)]):
                file, block = files[a].as_py(), int(blocks[a])
                if held is None or (held.file, held.block) != (file, block):
                    if held is not None:
                        yield from rows(held, held.end())
                    at = np.searchsorted(inside.value, numbers[a])
                    held = _Walk(file, block, bool(at < len(inside.value) and inside.value[at] == numbers[a]))
                yield from rows(held, held.lines(batch.column(2)[a:b], odd[a:b]))
        if held is not None:
            yield from rows(held, held.end())

    return run


def whole_records(lines: DataFrame) -> DataFrame:
    """(record) of files given as (file, block, line, odd), without their first records.

    ``odd`` says whether a line has an odd number of quotes. Lines of a block must come in
    order, as a text scan gives them. A record that a file does not finish is one too.
    """
    spark = lines.sparkSession
    inside = spark.sparkContext.broadcast(_blocks_inside(lines.select("file", "block", "odd")))
    numbered = lines.select("file", "block", "line", "odd", F.xxhash64("file", "block").alias("number"))
    walked = numbered.mapInArrow(_walked(inside), SCHEMA)

    # A fragment that begins a record opens a chain; those up to the next one belong to it.
    fragments = materialise(walked.where(F.col("kind") != WHOLE), "fragments")
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    chained = fragments.withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "record")))
    joined = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.element_at(parts, 1)["record"],
        lambda text, part: F.concat(text, F.lit(b"\n"), part["record"]),
    )
    across = chained.where("chain > 0").groupBy("file", "chain").agg(joined.alias("record"))
    return walked.where(F.col("kind") == WHOLE).select("record").unionByName(across.select("record"))
