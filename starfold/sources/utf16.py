"""Lines and records of UTF-16 files, counted by code unit in splits.

Spark cuts files at every 0x0A byte, which in UTF-16 need not be a line feed. Whether one
is depends on the byte order and on whether it lies at an even place of the file, which a
block of a file cannot know. So each block is summed up once for either byte order, either
parity of the bytes before it, and either parity of the quotes before it; the short sums of
a file's blocks are then put together in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.session import ship_by_value

ship_by_value(__name__)

LITTLE, BIG = 0, 1
LINE_FEED, QUOTE = 0x0A, 0x22
SUM_SCHEMA = "file string, block long, mark int, size long, sums array<long>"
#: Numbers in ``sums`` for each byte order and parity of the bytes before.
#: feeds, feeds with an even and with an odd number of quotes before them in the block,
#: quotes, parity of the quotes at the last feed, bytes after it.
FIELDS = 6


class _BlockSum:
    """Sums of one block, fed with its pieces in order."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.mark, self.size = file, block, -1, 0
        self.sums = np.zeros((2, 2, FIELDS), np.int64)

    def feed(self, data: np.ndarray, offset: np.ndarray) -> None:
        """Pieces data[offset[i]:offset[i + 1]], each followed by a 0x0A that is not in it."""
        n = len(offset) - 1
        first, last = offset[:-1], offset[1:] - 1
        filled = last >= first
        base = int(offset[0])
        if self.block == 0 and self.size == 0 and last[0] > first[0]:
            self.mark = {b"\xff\xfe": LITTLE, b"\xfe\xff": BIG}.get(data[base : base + 2].tobytes(), -1)
        # Place in the block of each piece, and of each quote.
        place = self.size + first - base + np.arange(n)
        at = np.flatnonzero(data[base : offset[-1]] == QUOTE) + base
        piece = np.searchsorted(offset, at, side="right") - 1
        at_place = self.size + at - base + piece
        after = np.where(at < last[piece], data[np.minimum(at + 1, len(data) - 1)], 255)
        before = np.where(at > first[piece], data[np.maximum(at - 1, 0)], 255)
        begins_null = np.zeros(n, bool)
        begins_null[filled] = data[first[filled]] == 0
        ends_null = np.zeros(n, bool)
        ends_null[filled] = data[last[filled]] == 0
        size = offset[1:] - first
        whole = self.size + int(offset[-1]) - base + n
        for parity in (0, 1):
            # Little end first: 0x0A at an even place, and the next piece begins with 0.
            quote = piece[(after == 0) & ((at_place + parity) % 2 == 0)]
            feed = begins_null & ((place - 1 + parity) % 2 == 0)
            if self.block == 0 and self.size == 0:
                feed[0] = False  # nothing before the first piece of a file
            self._add(LITTLE, parity, feed, np.searchsorted(quote, np.flatnonzero(feed)), len(quote), whole, place + 1)
            # Big end first: 0x0A at an odd place, and its own piece ends with 0.
            quote = piece[(before == 0) & ((at_place + parity) % 2 == 1)]
            feed = ends_null & ((place + size + parity) % 2 == 1)
            self._add(BIG, parity, feed, np.searchsorted(quote, np.flatnonzero(feed), side="right"), len(quote), whole, place + size + 1)
        self.size = whole

    def _add(self, order: int, parity: int, feed: np.ndarray, quotes_before: np.ndarray, quotes: int, whole: int, end: np.ndarray) -> None:
        sums = self.sums[order, parity]
        odd = (sums[3] + quotes_before) % 2
        sums[0] += len(odd)
        sums[1] += int((odd == 0).sum())
        sums[2] += int(odd.sum())
        sums[3] += quotes
        if len(odd):
            sums[4] = odd[-1]
            sums[5] = whole - int(end[np.flatnonzero(feed)[-1]])
        else:
            sums[5] += whole - self.size

    def row(self) -> dict:
        return {"file": self.file, "block": self.block, "mark": self.mark, "size": self.size, "sums": self.sums.ravel().tolist()}


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, piece) in order to one row for each block."""
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("mark", pa.int32()), ("size", pa.int64()), ("sums", pa.list_(pa.int64()))]
    )
    held: _BlockSum | None = None
    for batch in batches:
        pieces = batch.column(2).cast(pa.large_binary())
        offset = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        data = data if len(data) else np.zeros(1, np.uint8)
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        new = [i for i in range(len(files)) if i == 0 or blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
        for a, b in zip(new, [*new[1:], len(files)]):
            if held is None or (held.file, held.block) != (files[a], blocks[a]):
                if held is not None:
                    yield pa.RecordBatch.from_pylist([held.row()], schema)
                held = _BlockSum(files[a], int(blocks[a]))
            held.feed(data, offset[a : b + 1])
    if held is not None:
        yield pa.RecordBatch.from_pylist([held.row()], schema)


def _put_together(blocks: pd.DataFrame) -> pd.DataFrame:
    """(file, lines, records) of one file from the sums of its blocks; the header counts too."""
    blocks = blocks.sort_values("block")
    order = max(int(blocks["mark"].iloc[0]), LITTLE)
    parity = quotes = lines = records = 0
    open_line = open_record = False
    for size, sums in zip(blocks["size"], blocks["sums"]):
        feeds, even, odd, own, last, after = np.reshape(sums, (2, 2, FIELDS))[order, parity].tolist()
        lines += feeds
        records += odd if quotes else even
        if feeds:
            # One byte alone is the 0x0A that a last piece was lent.
            open_line = after > 1
            open_record = after > 1 or (last + quotes) % 2 == 1
        elif size:
            open_line = open_record = True
        parity, quotes = (parity + size) % 2, (quotes + own) % 2
    return pd.DataFrame({"file": blocks["file"].iloc[:1], "lines": [lines + open_line], "records": [records + open_record]})


def utf16_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, lines, records) of UTF-16 files, less their headers; records end at line
    feeds with an even number of quotes before them, and an unfinished one counts.

    The last piece of a file without a line feed is taken to have one more byte, which
    changes no count.
    """
    pieces = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    rows = pieces.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )
    sums = rows.mapInArrow(_summed, SUM_SCHEMA)
    found = sums.groupBy("file").applyInPandas(_put_together, "file string, lines long, records long")
    less = lambda c: F.greatest(F.col(c) - 1, F.lit(0)).alias(c)
    return found.select("file", less("lines"), less("records"))
