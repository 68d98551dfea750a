"""Texts in chunk files, so that what is found out about rows goes to the texts.

Texts are the large side of every join with them. Here they are written once, without a
shuffle, a few megabytes to a file in the shared folder; each row has a reference (chunk,
row). Later steps send their narrow findings to the chunk and read its texts there. A
chunk's name is drawn anew by each attempt of a task, and only the references of the
attempt that Spark commits count, so repeated tasks cannot mix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.llm.words import slices
from starfold.session import ship_by_value

ship_by_value(__name__)

TOGETHER = 4 << 20
TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
REF_SQL = "chunk long, row int, doc_id long"


def _name(chunk: int) -> str:
    return f"chunk-{chunk}.arrow"


class Chunks:
    """Chunk files of all rows of ``documents``, and ``refs``: one row for each of theirs.

    ``facts`` computes more columns of ``refs`` from a batch of texts. Nulls in text
    become empty; a null doc_id stays.
    """

    def __init__(self, documents: DataFrame, facts: Callable[[pa.RecordBatch], list[pa.Array]] | None = None, facts_sql: str = ""):
        self.folder = work_dir(documents.sparkSession, "chunks")
        folder = self.folder
        names = [x.split()[0] for x in f"{REF_SQL}, {facts_sql}".split(", ") if x]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
            for batch in batches:
                for part in slices(batch, 1, TOGETHER):
                    chunk = uuid.uuid4().int >> 65
                    part = pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(part.columns, TEXTS.types)], schema=TEXTS)
                    with whole_file(folder, _name(chunk)) as out:
                        with pa.ipc.new_file(out, TEXTS, options=options) as file:
                            file.write_batch(part)
                    n = part.num_rows
                    places = [pa.array([chunk] * n, pa.int64()), pa.array(range(n), pa.int32()), part.column(0)]
                    yield pa.RecordBatch.from_arrays(places + (facts(part) if facts else []), names=names)

        rows = documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        schema = f"{REF_SQL}, {facts_sql}" if facts_sql else REF_SQL
        self.refs = stored(rows.mapInArrow(run, schema), "refs")

    def map(self, findings: DataFrame, f: Callable[[pa.RecordBatch, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """Apply ``f(texts, findings)`` to each chunk that findings (chunk, row, ...) name."""
        folder, at = self.folder, findings.columns.index("chunk")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk, held = None, []

            def done() -> Iterator[pa.RecordBatch]:
                if held:
                    with open_file(folder, _name(chunk)) as source:
                        texts = pa.ipc.open_file(source).get_batch(0)
                    yield from f(texts, pa.Table.from_batches(held))

            for batch in batches:
                ids = batch.column(at).to_numpy()
                start = 0
                while start < len(ids):
                    end = start + 1
                    while end < len(ids) and ids[end] == ids[start]:
                        end += 1
                    if ids[start] != chunk:
                        yield from done()
                        chunk, held = int(ids[start]), []
                    held.append(batch.slice(start, end - start))
                    start = end
            yield from done()

        dealt = findings.repartition("chunk").sortWithinPartitions("chunk", "row")
        return dealt.mapInArrow(run, schema)

    def every(self) -> DataFrame:
        """(chunk, row) that names each chunk once."""
        return self.refs.select("chunk").distinct().withColumn("row", F.lit(-1))
