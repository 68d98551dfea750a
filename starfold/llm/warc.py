"""Web archives and a global capture index, merged from locally sorted runs.

A task writes its pages as one gzipped WARC file, a member for each record, and beside it
runs of captures sorted by (URL key, timestamp, page). The index is an external merge:
key ranges are dealt to tasks, each of which seeks to its range in the runs that reach
into it and merges the slices with a loser tree. No task opens more than FAN_IN runs: where
there are more, earlier passes merge bunches of them into longer runs, first over the
whole key space, then over ever narrower ranges, so that tasks stay about equally long.
Ranges are cut between single captures, not between URLs, so one URL may have any share
of all captures.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import stored, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.llm.loser_tree import LoserTree
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Payloads below this size are always stored.
LEAST_BYTES = 100
#: Captures in a run, and in one batch of a run's file.
RUN_ROWS, BATCH_ROWS = 100_000, 1024
#: Runs that one task merges, at most.
FAN_IN = 64
#: At most so many run keys decide where key ranges are cut; they only balance tasks.
SAMPLE_KEYS = 20_000

# Names of the WARC format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)

CAPTURE = pa.schema(
    [
        ("url_key", pa.string()),
        ("timestamp", pa.string()),
        ("page", pa.string()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
CAPTURE_SQL = "url_key string, timestamp string, page string, archive string, offset long, length long"
KEY = CAPTURE.names[:3]
KEY_SQL = "url_key string, timestamp string, page string"
RUN_SQL = f"run long, range_no long, name string, first struct<{KEY_SQL}>, last struct<{KEY_SQL}>"
RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Host labels in reverse, then the path: captures of a site sort together."""
    found = re.match(r"(?:[a-zA-Z][\w+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url or "")
    host, path = found[1].lower(), found[2] or "/"
    return f"{','.join(reversed(host.split('.')))}){path}"


def captured_at(page_id: int | None) -> str:
    """A second of the year that the page's id fixes; pages carry no time of their own."""
    at = EPOCH + timedelta(seconds=(page_id or 0) % (365 * 86_400))
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record; ``first`` is the page that a revisit refers to, None for a response."""
    kind = "response" if first is None else "revisit"
    block = HTTP + (payload if first is None else b"")
    # Nothing in a URL may end its header line.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:no-url")
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {captured_at(page_id)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_record(member: bytes) -> dict:
    """The record of one gzip member; a response's payload is hashed again and compared."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    page = lambda name: int(fields[name][10:-1]) if len(fields.get(name, "")) > 11 else None
    block = rest[: int(fields["Content-Length"])]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("damaged payload")
    return {
        "page_id": page("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
    }


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def _batches(rows: Iterable[tuple], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while held := list(islice(rows, size)):
        yield _batch(held, schema)


def _write_run(folder: str, name: str, captures: Iterable[tuple]) -> None:
    """Captures in order to a file of small batches, held one batch at a time."""
    with whole_file(folder, name) as out, pa.ipc.new_file(out, CAPTURE) as file:
        for batch in _batches(captures, BATCH_ROWS, CAPTURE):
            file.write_batch(batch)


def _write_archive(folder: str):
    """Task function: rows of pages to one archive and its runs; returns keys of each run.

    These are the first key of every batch and the last key, with the run's file name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        archive = f"pages-{part:06d}.warc.gz"
        captures, runs, offset, keys = [], 0, 0, []

        def close_run() -> None:
            nonlocal captures, runs
            name = f"pages-{part:06d}-{runs:04d}.run"
            captures.sort()
            _write_run(folder, name, captures)
            keys.extend((name, *c[:3]) for c in (*captures[::BATCH_ROWS], captures[-1]))
            captures, runs = [], runs + 1

        with whole_file(folder, archive) as out:
            for batch in batches:
                for page_id, url, html, digest, first in zip(*batch.columns):
                    page_id, first, url = page_id.as_py(), first.as_py(), url.as_py()
                    payload = html.as_buffer().to_pybytes()
                    record = record_bytes(page_id, url, payload, digest.as_py(), first)
                    packer = zlib.compressobj(4, wbits=31)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    page = "" if page_id is None else f"{page_id:020d}"
                    captures.append(
                        (url_key(url), captured_at(page_id), page, archive, offset, len(member))
                    )
                    offset += len(member)
                    if len(captures) == RUN_ROWS:
                        close_run()
        if captures:
            close_run()
        yield _batch(keys, pa.schema([("name", pa.string()), *list(CAPTURE)[:3]]))

    return run


def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, first: the page that a record refers to, or null.

    Only pages of equal payloads are looked up, by narrow rows; the payload itself moves
    once, by page.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(payload, "UTF-8").alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    narrow = rows.where(F.octet_length("payload") >= LEAST_BYTES).select("page_id", "digest")
    firsts = (
        narrow.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select(F.col("digest").alias("_digest"), "first")
    )
    revisits = (
        narrow.distinct()
        .join(firsts, F.col("digest") == F.col("_digest"))
        .where("page_id is null or page_id <> first")
        .select(F.col("page_id").alias("_page"), "_digest", "first")
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "first")


def write_archives(pages: DataFrame, folder: str) -> tuple[DataFrame, list[tuple]]:
    """Write all pages below ``folder``; returns (runs as RUN_SQL, bounded sample of keys).

    A null html is an empty payload, a null url a capture without URL; a null page_id
    is no reference for others. Repeated rows are records each.
    """
    rows = classified(pages).sortWithinPartitions("page_id", "digest", "url")
    keys = stored(rows.mapInArrow(_write_archive(folder), f"name string, {KEY_SQL}"), "warc-keys")
    by_key = keys.groupBy("name").agg(
        F.min(F.struct(*KEY)).alias("first"), F.max(F.struct(*KEY)).alias("last")
    )
    # Consecutive numbers deal runs to bunches; there is one row for RUN_ROWS captures.
    numbered = stored(by_key, "warc-bounds").withColumn(
        "run", F.row_number().over(Window.orderBy("name")).cast("long") - 1
    )
    runs = numbered.select("run", F.lit(0).cast("long").alias("range_no"), "name", "first", "last")
    mixed = keys.select(*KEY).withColumn("_h", F.xxhash64(*KEY)).orderBy("_h").limit(SAMPLE_KEYS)
    return stored(runs, "warc-runs"), sorted(tuple(r) for r in mixed.select(*KEY).collect())


def _slice(folder: str, name: str, low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """Captures of a run from ``low`` on and below ``high``; seeks, then reads on."""
    with open_file(folder, name) as source:
        run = pa.ipc.open_file(source)
        key = lambda b, i: tuple(c[i].as_py() for c in b.columns[:3])
        first, last = 0, run.num_record_batches
        while low is not None and last - first > 1:  # the last batch that starts at or below low
            middle = (first + last) // 2
            first, last = (middle, last) if key(run.get_batch(middle), 0) < low else (first, middle)
        for number in range(first, run.num_record_batches):
            for row in zip(*(c.to_pylist() for c in run.get_batch(number).columns)):
                if high is not None and row[:3] >= high:
                    return
                if low is None or row[:3] >= low:
                    yield row


def merge_units(runs: DataFrame, cuts: list[tuple], width: int, wider: int) -> DataFrame:
    """One row for each merge of a pass: bunch, range_no, low, high, names (FAN_IN at most).

    Ranges hold ``width`` of the narrowest ranges that ``cuts`` divide, those of the pass
    before held ``wider``, a multiple of it. Only runs that reach into a range are named.
    """
    at = range(0, len(cuts) + 1, width)
    low_high = [
        (i, start // wider, cuts[start - 1] if start else None, (cuts + [None])[min(start + width - 1, len(cuts))])
        for i, start in enumerate(at)
    ]
    key = f"struct<{KEY_SQL}>"
    ranges = runs.sparkSession.createDataFrame(
        low_high, f"range_no long, wide long, low {key}, high {key}"
    )
    reaches = (F.col("low").isNull() | (F.col("last") >= F.col("low"))) & (
        F.col("high").isNull() | (F.col("first") < F.col("high"))
    )
    bunch = F.floor(F.col("run") / FAN_IN).alias("bunch")
    return (
        runs.withColumnRenamed("range_no", "wide")
        .join(ranges, "wide")
        .where(reaches)
        .groupBy(bunch, "range_no")
        .agg(F.first("low").alias("low"), F.first("high").alias("high"), F.sort_array(F.collect_list("name")).alias("names"))
    )


def _merges(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[tuple[int, int, LoserTree]]:
    """(bunch, range_no, captures in order) of every unit in the batches."""
    for batch in batches:
        for unit in batch.to_pylist():
            low, high = (tuple(b.values()) if (b := unit[n]) else None for n in ("low", "high"))
            tree = LoserTree(_slice(folder, n, low, high) for n in unit["names"])
            yield unit["bunch"], unit["range_no"], tree


def _longer_runs(folder: str, level: int):
    """Task function: units to one run each; returns rows of RUN_SQL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = pa.struct(list(CAPTURE)[:3])
        schema = pa.schema([("run", pa.int64()), ("range_no", pa.int64()), ("name", pa.string()), ("first", key), ("last", key)])
        for bunch, number, tree in _merges(batches, folder):
            name, ends = f"merged-{level:02d}-{bunch:08d}-{number:06d}.run", [None, None]

            def noted() -> Iterator[tuple]:
                for capture in tree:
                    ends[0], ends[1] = ends[0] or capture, capture
                    yield capture

            _write_run(folder, name, noted())
            if ends[0]:
                first, last = (dict(zip(KEY, e)) for e in ends)
                yield _batch([(bunch, number, name, first, last)], schema)

    return run


def merged_index(runs: DataFrame, folder: str, sample: list[tuple], ranges: int) -> DataFrame:
    """All captures of the runs in global order: range_no, position, and CAPTURE.

    There are at least as many ranges as bunches of runs, as far as the sample of keys
    can tell them apart.
    """
    n = max(1, runs.count())
    passes, left = 1, n
    while left > FAN_IN:
        passes, left = passes + 1, -(-left // FAN_IN)
    step = max(1, len(sample) // max(ranges, -(-n // FAN_IN)))
    cuts = sorted(set(sample[step::step]))
    base = 1
    while passes > 1 and base ** (passes - 1) <= len(cuts):
        base += 1
    widths = [base ** (passes - p) if passes > 1 else 1 for p in range(1, passes + 1)]
    wider = len(cuts) + 1
    for level, width in enumerate(widths[:-1], 1):
        units = merge_units(runs, cuts, width, wider)
        tasks = units.repartitionByRange(-(-n // FAN_IN), "range_no", "bunch")
        runs = stored(tasks.mapInArrow(_longer_runs(folder, level), RUN_SQL), "warc-runs")
        wider = width

    out = pa.schema([("range_no", pa.int32()), ("position", pa.int64()), *CAPTURE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, number, tree in _merges(batches, folder):
            rows = ((number, i, *capture) for i, capture in enumerate(tree))
            yield from _batches(rows, BATCH_ROWS * 8, out)

    tasks = merge_units(runs, cuts, 1, wider).repartitionByRange(len(cuts) + 1, "range_no")
    return tasks.mapInArrow(run, f"range_no int, position long, {CAPTURE_SQL}")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that an index points at (see RECORD), archive by archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, open_file(folder, archive)
                source.seek(offset)
                rows.append(read_record(source.read(length)))
            yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
        if source is not None:
            source.close()

    places = index.select("archive", "offset", "length").repartition("archive")
    return places.sortWithinPartitions("archive", "offset").mapInArrow(run, RECORD_SQL)


def archive_pages(pages: DataFrame) -> tuple[DataFrame, str]:
    """(index, folder): archives of all pages and their merged index, both written."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    runs, sample = write_archives(pages, folder)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stored(merged_index(runs, folder, sample, ranges), "warc-index"), folder
