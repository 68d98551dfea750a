"""ZIP archives: integrity audit, member listing, unpacking into the shared folder.

Spark has no ZIP reader, so these are the only places where Python runs inside tasks. The
work is spread over rows, one for each archive or member, and streams have bounded size.
"""

from __future__ import annotations

import codecs
import contextlib
import hashlib
import io
import itertools
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.session import materialise, ship_by_value

ship_by_value(__name__)

BLOCK = 1 << 20
#: Members that are read by one task after the other: so many bytes of them, or so many.
CHUNK_BYTES, CHUNK_MEMBERS = 64 << 20, 1024
#: Rows, counting the members in them, that a task gathers before it passes them on.
AT_ONCE = 8192
MEMBER_SCHEMA = "archive string, member_index int, name string, size bigint"


def _stream(archive: str, content: bytes | None, options: dict | None = None):
    """The archive as a seekable stream: from its row, or from its file system.

    s3a and s3n are Hadoop's names of what pyarrow calls s3; ``options`` go to that
    file system.
    """
    if content is not None:
        return io.BytesIO(content)
    from pyarrow import fs

    scheme, found, rest = archive.partition("://")
    if scheme in ("s3", "s3a", "s3n") and found:
        return fs.S3FileSystem(**(options or {})).open_input_file(rest)
    if archive.startswith("file:"):
        archive, found = "/" + archive[len("file:") :].lstrip("/"), ""
    system, path = fs.FileSystem.from_uri(archive) if found else (fs.LocalFileSystem(), archive)
    return system.open_input_file(path)


def _spread(archives: DataFrame, *keys: str) -> DataFrame:
    """Rows over all shuffle partitions: short paths would else be packed into one."""
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.repartition(parts, *keys)


def _given(frame: DataFrame, *names: str) -> DataFrame:
    return frame.select(*[c for c in (*names, "content") if c in frame.columns])


def _tuples(batches: Iterator[pd.DataFrame], *names: str) -> Iterator[tuple]:
    for batch in batches:
        content = batch["content"] if "content" in batch else [None] * len(batch)
        yield from zip(*(batch[n] for n in names), content)


def _gathered(rows: Iterator[tuple[tuple, int]], names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of many of the (row, weight), since a frame for each row costs more than the row."""
    held, weight = [], 0
    for row, own in rows:
        held.append(row)
        weight += own
        if weight >= AT_ONCE:
            yield pd.DataFrame(held, columns=names)
            held, weight = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def _chunked(pack: zipfile.ZipFile) -> list[tuple[str, int]]:
    """(name, chunk) of every member, in the order of the directory."""
    out, chunk, held, count = [], 0, 0, 0
    for member in pack.infolist():
        if count and (held + member.compress_size > CHUNK_BYTES or count == CHUNK_MEMBERS):
            chunk, held, count = chunk + 1, 0, 0
        held, count = held + member.compress_size, count + 1
        out.append((member.filename, chunk))
    return out


def archive_facts(archives: DataFrame, options: dict | None = None) -> DataFrame:
    """(archive, sha256, members, problem): digest of the bytes, and the directory.

    A member comes with the chunk that it is read in. ``problem`` is "missing" or what
    keeps an archive from being opened; whatever goes wrong with one archive stays with it.
    """

    def found(batches):
        for archive, content in _tuples(batches, "archive"):
            digest, members, problem = None, None, None
            try:
                with _stream(archive, content, options) as stream:
                    digest = hashlib.file_digest(stream, "sha256").hexdigest()
                    members = [{"name": n, "chunk": c} for n, c in _chunked(zipfile.ZipFile(stream))]
            except FileNotFoundError:
                problem = "missing"
            except Exception as error:  # one unreadable archive is one finding
                problem = f"bad zip: {error}"
            yield (archive, digest, members, problem), 1 + len(members or ())

    def facts(batches):
        return _gathered(found(batches), ["archive", "sha256", "members", "problem"])

    schema = "archive string, sha256 string, members array<struct<name: string, chunk: int>>, problem string"
    return _spread(_given(archives, "archive"), "archive").mapInPandas(facts, schema)


def damaged_members(members: DataFrame, options: dict | None = None) -> DataFrame:
    """(archive, member_index, name, problem) of members whose bytes fail their check sum.

    Takes (archive, chunk, member_index, name[, content]). The members of a chunk come to
    one task one after the other, which opens the archive once for all of them.
    """

    def damaged(batches):
        rows = _tuples(batches, "archive", "chunk", "member_index", "name")
        for (archive, _), chunk in itertools.groupby(rows, key=lambda r: r[:2]):
            with contextlib.ExitStack() as opened:
                pack = None
                for *_, index, name, content in chunk:
                    try:
                        if pack is None:
                            stream = opened.enter_context(_stream(archive, content, options))
                            pack = opened.enter_context(zipfile.ZipFile(stream))
                        with pack.open(pack.infolist()[index]) as member:
                            while member.read(BLOCK):
                                pass
                    except zipfile.BadZipFile as error:
                        problem = "crc mismatch" if "CRC" in str(error) else f"bad zip: {error}"
                    except Exception as error:  # zlib.error, EOFError, a lost connection
                        problem = f"bad zip: {error}"
                    else:
                        continue
                    yield (archive, index, name, problem), 1

    def read(batches):
        return _gathered(damaged(batches), ["archive", "member_index", "name", "problem"])

    spread = _spread(_given(members, "archive", "chunk", "member_index", "name"), "archive", "chunk")
    ordered = spread.sortWithinPartitions("archive", "chunk", "member_index")
    return ordered.mapInPandas(read, "archive string, member_index int, name string, problem string")


def audit_archives(archives: DataFrame, options: dict | None = None) -> DataFrame:
    """(archive, ok, sha256, bad_member, reason): readable, and all check sums right.

    Takes ``archive`` (a path) and optionally ``content`` (its bytes). Members are read
    in chunks, so one archive of many members is no long task, and its directory is read
    once a chunk. Digests and directories are written to the shared folder, so that no
    archive is read twice for them.
    """
    archives = _given(archives, "archive")
    facts = materialise(archive_facts(archives, options), "archive-facts")
    found = F.posexplode("members").alias("member_index", "member")
    members = facts.where("problem is null").select("archive", found).select("archive", "member_index", "member.*")
    if "content" in archives.columns:
        members = members.join(archives, "archive")
    worst = damaged_members(members, options).groupBy("archive").agg(
        F.min(F.struct("member_index", "name", "problem")).alias("bad")
    )
    reason = F.coalesce("problem", "bad.problem")
    crc = F.col("bad.problem") == "crc mismatch"
    return facts.join(worst, "archive", "left").select(
        "archive",
        reason.isNull().alias("ok"),
        F.when(reason.isNull(), F.col("sha256")).alias("sha256"),
        F.when(crc, F.col("bad.name")).alias("bad_member"),
        reason.alias("reason"),
    )


def list_members(archives: DataFrame, options: dict | None = None) -> DataFrame:
    """Directory of every archive, one row per member that is not a folder."""

    def members(batches):
        for archive, content in _tuples(batches, "archive"):
            with _stream(archive, content, options) as stream, zipfile.ZipFile(stream) as pack:
                infos = [(archive, i, m.filename, m.file_size) for i, m in enumerate(pack.infolist()) if not m.is_dir()]
            yield pd.DataFrame(infos, columns=["archive", "member_index", "name", "size"])

    return _given(archives, "archive").mapInPandas(members, MEMBER_SCHEMA)


def unpack_members(chosen: DataFrame, options: dict | None = None) -> DataFrame:
    """Bytes of the chosen members (archive, name[, content]) in blocks of whole lines.

    A deflate stream can only be read from its start, so one task inflates one member,
    once, and holds one block at a time. Blocks are cut at a line-feed byte, which is
    left out: written as lines of one text file, they are the member again, in its own
    encoding. What that is, the line scan of the file tells; only UTF-16, whose line
    feeds have two bytes, becomes UTF-8 here.
    """
    marks = (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)

    def blocks(batches):
        for archive, name, content in _tuples(batches, "archive", "name"):
            with _stream(archive, content, options) as stream, zipfile.ZipFile(stream) as pack:
                with pack.open(name) as member:
                    part, held, wide = 0, [], None
                    while block := member.read(BLOCK):
                        if wide is None:
                            wide = codecs.getincrementaldecoder("utf-16")() if block.startswith(marks) else False
                        block = wide.decode(block).encode() if wide else block
                        whole, feed, rest = block.rpartition(b"\n")
                        if feed:
                            yield pd.DataFrame({"archive": [archive], "part": [part], "value": [b"".join([*held, whole])]})
                            part, held = part + 1, []
                        held.append(rest)
                    if any(held):
                        yield pd.DataFrame({"archive": [archive], "part": [part], "value": [b"".join(held)]})

    rows = _given(chosen, "archive", "name").mapInPandas(blocks, "archive string, part bigint, value binary")
    # A string column of any bytes: the text writer puts them out as they are.
    return rows.withColumn("value", F.col("value").cast("string"))
