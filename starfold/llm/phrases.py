"""Phrase collocations by Rabin-Karp fingerprints.

Texts are written once to chunk files. A prefix polynomial over the bytes of a chunk gives
the fingerprint of any run of words by one subtraction and one product, so every n-gram is
hashed by numpy without touching its text again. Tasks count fingerprints chunk by chunk,
shuffles add the counts and keep a first and a last pointer to an occurrence. A run of
words is counted only if its shorter runs may be frequent: a bitmap of the frequent
fingerprints of the pass before, of bounded size, says so. It may err towards counting, so
nothing is lost.

Two polynomials are used, one modulo 2^64 and one modulo a prime; counts are kept for
pairs of both. The texts at the first and last pointer of each frequent pair are read and
compared, and only these are ever made into strings.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm.common import stored, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.llm.words import mixed, slices
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Words of a phrase, at most; occurrences of a candidate, at least; phrases of a language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A phrase is dropped for a longer one with so many per cent of its occurrences.
WITHIN = 80
#: Bytes of text in a chunk, about.
CHUNK = 2 << 20
#: Bits of a bitmap for each frequent fingerprint, and the logarithms of its least and most bits.
BITS_EACH, BITMAP_BITS = 16, (20, 28)
PARTS = 256
#: A pointer is a place in a chunk, the chunk, and a length: 26 + 35 + 2 bits, so that least
#: and greatest pointers lie in all chunks alike. Chunks are numbered by the task that wrote
#: them (22 bits) and their place among its chunks (13 bits).
PLACE_BITS, SEQUENCE_BITS, TASK_BITS = 26, 13, 22
CHUNK_BITS = SEQUENCE_BITS + TASK_BITS
#: Chunks that a task reads, and tasks beyond which it reads more.
CHUNKS_EACH, MOST_TASKS = 8, 100_000

BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
PRIME, PRIME_BASE = (1 << 31) - 1, 1_237_940_039

UND = "und"
_SPACE, _SPLIT = 1, 2
CHUNK_SCHEMA = pa.schema([("lang", pa.string()), ("text", pa.large_binary())])


def _byte_classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = _SPACE
    kind[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = _SPLIT
    return kind


def _lower() -> np.ndarray:
    byte = np.arange(256, dtype=np.uint8)
    byte[65:91] += 32
    return byte


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder modulo PRIME, which is 2^31 - 1."""
    high = x >> 31
    high += x & PRIME
    return high


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME of numbers from 0 on, without a division."""
    x = _folded(_folded(x))
    x -= PRIME * (x >= PRIME)
    return x


def _powers_mod(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo PRIME, by doubling."""
    out = np.ones(1, np.int64)
    step = base % PRIME
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), PRIME) % PRIME])
    return out[:n] if step else out


class Powers:
    """Tables of powers; they grow with the longest chunk a worker has seen."""

    def __init__(self):
        self.size = 0
        value = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(STEP))
        self.value, self.small = value, (value % np.uint64(PRIME - 1)).astype(np.int64) + 1
        self.kind, self.lower = _byte_classes(), _lower()

    def reach(self, n: int) -> Powers:
        if n > self.size:
            self.size = max(n, 3 * CHUNK // 2 + 1)
            inverse = pow(BASE, -1, 1 << 64)
            ones = np.full(self.size, BASE, np.uint64), np.full(self.size, inverse, np.uint64)
            for table in ones:
                table[0] = 1
            self.power, self.inverse = (np.cumprod(t, dtype=np.uint64) for t in ones)
            self.power_mod = _powers_mod(PRIME_BASE, self.size)
            self.inverse_mod = _powers_mod(pow(PRIME_BASE, -1, PRIME), self.size)
        return self


_POWERS: list[Powers] = []


def powers(n: int) -> Powers:
    """The tables that calls in one worker share."""
    if not _POWERS:
        _POWERS.append(Powers())
    return _POWERS[0].reach(n)


def lang_number(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Grams:
    """Words of a chunk and the fingerprints of their runs."""

    def __init__(self, langs: list[str], texts: pa.Array, bits: int = 64):
        offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low, high = int(offset[0]), int(offset[-1])
        data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
        offset = offset - low
        self.langs, self.bits = langs, bits
        self.tables = tables = powers(len(data) + 1)
        kind = tables.kind[data]
        inside = kind == 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = np.diff(offset) > 0
        begins[offset[:-1][filled]] = inside[offset[:-1][filled]]
        ends[offset[1:][filled] - 1] = inside[offset[1:][filled] - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(offset, start, side="right") - 1
        splits = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind == _SPLIT, out=splits[1:])
        #: Whether word i and the next one are in one piece.
        self.joined = (splits[start[1:]] == splits[end[:-1]]) & (self.row[1:] == self.row[:-1])
        # Words with one space between them: a phrase is then a run of bytes.
        keep = inside
        keep[end[end < len(data)]] = True
        moved = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
        np.cumsum(keep, out=moved[1:])
        self.start, self.end = moved[start].astype(np.int64), moved[end - 1].astype(np.int64) + 1
        text = tables.lower[data]
        text[tables.kind[data] > 0] = 32
        self.data = text[keep]
        self._prefix_mod = None
        self.salt = np.array([lang_number(x) for x in langs], np.uint64)
        self.salt_mod = (self.salt % np.uint64(PRIME)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.start)

    @cached_property
    def prefix(self) -> np.ndarray:
        """Sums over the bytes so far; who only counts words needs none."""
        prefix, terms = np.zeros(len(self.data) + 1, np.uint64), self.tables.value[self.data]
        terms *= self.tables.power[: len(self.data)]
        np.cumsum(terms, dtype=np.uint64, out=prefix[1:])
        return prefix

    def places(self, k: int) -> np.ndarray:
        """Where k words of one piece begin."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for j in range(k - 1):
            ok &= self.joined[j : j + n]
        return np.flatnonzero(ok)

    def fingerprint(self, place: np.ndarray, k: int | np.ndarray) -> np.ndarray:
        """Numbers below 2^64 of the k words from each place on; of other languages others."""
        a, b = self.start[place], self.end[place + k - 1]
        run = (self.prefix[b] - self.prefix[a]) * self.tables.inverse[a]
        out = mixed(run + self.salt[self.row[place]] + (b - a).astype(np.uint64) * np.uint64(STEP))
        return out if self.bits == 64 else out >> np.uint64(64 - self.bits) << np.uint64(64 - self.bits)

    def check(self, place: np.ndarray, k: int | np.ndarray) -> np.ndarray:
        """The same by the other polynomial, modulo PRIME."""
        if self._prefix_mod is None:
            terms = self.tables.small[self.data]
            terms *= self.tables.power_mod[: len(self.data)]
            self._prefix_mod = np.zeros(len(self.data) + 1, np.int64)
            # Terms below 2^62 fold below 2^32, so sums over 2^31 bytes fit.
            np.cumsum(_folded(terms), out=self._prefix_mod[1:])
        a, b = self.start[place], self.end[place + k - 1]
        run = _mod(self._prefix_mod[b] - self._prefix_mod[a])
        run *= self.tables.inverse_mod[a]
        run += self.salt_mod[self.row[place]]
        return _mod(run)

    def phrases(self, place: np.ndarray, k: np.ndarray) -> pa.Array:
        """The words as strings with one space between them."""
        a, b = self.start[place], self.end[place + k - 1]
        offset = np.concatenate([np.zeros(1, np.int64), np.cumsum(b - a)])
        at = np.arange(offset[-1]) + np.repeat(a - offset[:-1], b - a)
        buffers = [None, pa.py_buffer(offset), pa.py_buffer(self.data[at])]
        return pa.Array.from_buffers(pa.large_string(), len(place), buffers).cast(pa.string())


# --- chunk files ---------------------------------------------------------------------


def _pieces_of(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts that end at the end of a piece, each about ``size`` bytes."""
    splits = np.flatnonzero(_byte_classes()[np.frombuffer(text, np.uint8)] == _SPLIT) + 1
    at = 0
    while len(text) - at > size:
        nearest = np.searchsorted(splits, at + size)
        if nearest == len(splits):
            break
        yield text[at : splits[nearest]]
        at = int(splits[nearest])
    yield text[at:]


def _groups(batch: pa.RecordBatch, size: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """Rows together that have about ``size`` bytes; longer texts are split at pieces."""
    for part in slices(batch, 1, size):
        langs, texts = [], []
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
            for piece in _pieces_of(text, size) if len(text) > size else [text]:
                if len(piece) > size // 2 and texts:
                    yield langs, texts
                    langs, texts = [], []
                langs.append(lang)
                texts.append(piece)
        if texts:
            yield langs, texts


def _write_chunks(folder: str, size: int):
    """Task function: (chunk, file, lang, n_words) of the chunks that it writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))
        for batch in batches:
            for langs, texts in _groups(batch, size):
                if task >> TASK_BITS or sequence >> SEQUENCE_BITS:
                    raise ValueError("too many chunks for a pointer: read in larger partitions")
                rows = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts, pa.large_binary())], schema=CHUNK_SCHEMA)
                grams = Grams(langs, rows.column(1))
                if len(grams) >> PLACE_BITS:
                    raise ValueError("a piece of text has too many words for a pointer")
                name = f"{uuid.uuid4().hex}.arrow"
                with whole_file(folder, name) as out, pa.ipc.new_file(out, CHUNK_SCHEMA, options=options) as file:
                    file.write_batch(rows)
                each = np.bincount(grams.row, minlength=len(langs))
                sums: dict[str, int] = {}
                for lang, n in zip(langs, each.tolist()):
                    sums[lang] = sums.get(lang, 0) + n
                chunk = [task << SEQUENCE_BITS | sequence] * len(sums)
                yield pa.RecordBatch.from_pydict(
                    {"chunk": chunk, "file": [name] * len(sums), "lang": list(sums), "n": list(sums.values())}
                )
                sequence += 1

    return run


def _read_chunk(folder: str, name: str, bits: int) -> Grams:
    with open_file(folder, name) as source:
        rows = pa.ipc.open_file(source).get_batch(0)
    return Grams(rows.column(0).to_pylist(), rows.column(1), bits)


# --- counting ------------------------------------------------------------------------


def _may_be(bitmap: np.ndarray, number: np.ndarray) -> np.ndarray:
    at = number >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _count(folder: str, lengths: tuple[int, ...], known: int, bitmap, bits: int):
    """Task function: (fp, check, n, at) of the runs of these lengths in each chunk.

    Only runs whose every part of ``known`` words may be frequent by the bitmap count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = _read_chunk(folder, name, bits)
                may = None
                if bitmap is not None:
                    place = grams.places(known)
                    may = np.zeros(len(grams), bool)
                    may[place[_may_be(bitmap.value, grams.fingerprint(place, known))]] = True
                for k in lengths:
                    place = grams.places(k)
                    if may is not None:
                        for j in range(k - known + 1):
                            place = place[may[place + j]]
                    if not len(place):
                        continue
                    number, check = grams.fingerprint(place, k), grams.check(place, k).astype(np.int32)
                    order = np.argsort(number)
                    number, check = number[order], check[order]
                    new, other = np.ones(len(order), bool), np.ones(len(order), bool)
                    new[1:], other[1:] = number[1:] != number[:-1], check[1:] != check[:-1]
                    if (other & ~new).any():  # one number with several checks
                        again = np.lexsort((check, number))
                        order, number, check = order[again], number[again], check[again]
                        other[1:] = check[1:] != check[:-1]
                        new |= other
                    first = np.flatnonzero(new)
                    at = place[order[first]] << (CHUNK_BITS + 2) | chunk << 2 | (k - 1)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "fp": number[first].view(np.int64),
                            "check": check[first],
                            "n": np.diff(np.append(first, len(order))),
                            "at": at,
                        }
                    )

    return run


def _bitmap(frequent: DataFrame, column: str = "fp") -> np.ndarray:
    """One bit for the leading bits of each frequent fingerprint; at most 2^28 bits."""
    n = max(frequent.count(), 1)
    bits = min(max((n * BITS_EACH).bit_length(), BITMAP_BITS[0]), BITMAP_BITS[1])
    each = (1 << bits) // 8 // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            part, inside = at // np.uint64(8 * each), at % np.uint64(8 * each)
            for p in np.unique(part).tolist():
                own = inside[part == p]
                place = parts.setdefault(p, np.zeros(each, np.uint8))
                np.bitwise_or.at(place, own >> np.uint64(3), np.uint8(1) << (own & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(list(parts), pa.int64()), "bits": pa.array([zlib.compress(p.tobytes(), 1) for p in parts.values()], pa.binary())}
        )

    part = F.shiftrightunsigned(F.col(column), 64 - 8).alias("part")  # PARTS is 2^8
    rows = frequent.select(part, column).repartition("part").mapInArrow(run, "part long, bits binary").collect()
    out = np.zeros((PARTS, each), np.uint8)
    for row in rows:
        out[row["part"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return out.ravel()


class PhraseCounts:
    """Frequent runs of words of all documents: chunk files, counts and pointers."""

    def __init__(self, documents: DataFrame, longest: int = LONGEST, least: int = LEAST, chunk_bytes: int = CHUNK, bits: int = 64):
        self.spark: SparkSession = documents.sparkSession
        self.longest, self.least, self.bits = longest, least, bits
        self.folder = work_dir(self.spark, "phrases")
        rows = documents.select(
            F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        written = rows.mapInArrow(_write_chunks(self.folder, chunk_bytes), "chunk long, file string, lang string, n long")
        self.written = stored(written, "phrase-chunks")
        self.chunks = self.written.select("chunk", "file").distinct()
        n = self.chunks.count()
        least = min(n, 4 * self.spark.sparkContext.defaultParallelism)
        self.tasks = max(1, least, min(n // CHUNKS_EACH, MOST_TASKS))

    def words(self) -> DataFrame:
        """(lang, n): all word occurrences of each language."""
        return self.written.groupBy("lang").agg(F.sum("n").alias("n"))

    def counted(self, lengths: tuple[int, ...], known: int = 0, bitmap: np.ndarray | None = None) -> DataFrame:
        """(fp, check, a, first, last) of the runs of these lengths with enough occurrences."""
        shared = None if bitmap is None else self.spark.sparkContext.broadcast(bitmap)
        entries = self.chunks.repartition(self.tasks).mapInArrow(
            _count(self.folder, lengths, known, shared, self.bits), "fp long, check int, n long, at long"
        )
        sums = entries.groupBy("fp", "check").agg(
            F.sum("n").alias("a"), F.min("at").alias("first"), F.max("at").alias("last")
        )
        return stored(sums.where(F.col("a") >= self.least), f"phrases-{lengths[-1]}")

    def frequent(self) -> tuple[DataFrame, DataFrame]:
        """(frequent words, frequent phrases of two words and more)."""
        words = self.counted((1,))
        phrases = pairs = self.counted((2,), 1, _bitmap(words))
        if self.longest > 2:
            longer = self.counted(tuple(range(3, self.longest + 1)), 2, _bitmap(pairs))
            phrases = pairs.union(longer)
        return words, phrases

    def texts(self, phrases: DataFrame) -> DataFrame:
        """(fp, check, lang, phrase, k, parts) of phrases, read from their first and last occurrence.

        ``parts`` has from, length, fp and check of every shorter run of words inside. A
        pair of fingerprints that stands for two texts ends the job.
        """
        folder, bits = self.folder, self.bits
        both = phrases.select("fp", "check", F.explode(F.array_distinct(F.array("first", "last"))).alias("at"))
        pointers = both.withColumn("chunk", F.shiftright("at", 2).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))).join(self.chunks, "chunk")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, held = None, []

            def done() -> Iterator[pa.RecordBatch]:
                if held:
                    yield from _materialised(_read_chunk(folder, name, bits), pa.Table.from_batches(held))

            for batch in batches:
                names = batch.column(0)
                runs = pa.compute.run_end_encode(names)
                start = 0
                for end, own in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                    if own != name:
                        yield from done()
                        name, held = own, []
                    held.append(batch.slice(start, end - start))
                    start = end
            yield from done()

        part = "struct<`from`:int,length:int,fp:long,check:int>"
        schema = f"fp long, check int, lang string, phrase string, k int, parts array<{part}>"
        dealt = pointers.select("file", "fp", "check", "at").repartition(self.tasks, "file").sortWithinPartitions("file")
        read = dealt.mapInArrow(run, schema)
        same = (F.min("phrase") == F.max("phrase")) & (F.min("lang") == F.max("lang"))
        return read.groupBy("fp", "check").agg(
            F.when(same, F.min("lang")).otherwise(F.raise_error(F.lit("two phrases share both fingerprints"))).alias("lang"),
            F.min("phrase").alias("phrase"),
            F.min("k").alias("k"),
            F.first("parts").alias("parts"),
        )


def _materialised(grams: Grams, found: pa.Table) -> Iterator[pa.RecordBatch]:
    at = found.column("at").to_numpy()
    lengths, places = (at & 3) + 1, at >> (CHUNK_BITS + 2)
    for k in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == k)
        place = places[own]
        inner = [(s, m) for m in range(1, k) for s in range(k - m + 1)]
        numbers = np.stack([grams.fingerprint(place + s, m).view(np.int64) for s, m in inner], 1)
        checks = np.stack([grams.check(place + s, m).astype(np.int32) for s, m in inner], 1)
        fields = {
            "from": np.tile(np.array([s for s, _ in inner], np.int32), len(own)),
            "length": np.tile(np.array([m for _, m in inner], np.int32), len(own)),
            "fp": numbers.ravel(),
            "check": checks.ravel(),
        }
        parts = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
        offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(inner))
        rows = found.take(pa.array(own)).combine_chunks()
        langs = pa.array(grams.langs).take(pa.array(grams.row[place]))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("fp").combine_chunks(),
                rows.column("check").combine_chunks(),
                langs,
                grams.phrases(place, np.full(len(own), k)),
                pa.array(np.full(len(own), k, np.int32)),
                pa.ListArray.from_arrays(offsets, parts),
            ],
            names=["fp", "check", "lang", "phrase", "k", "parts"],
        )


def _score(first: str, rest: str) -> Column:
    """floor(2000000 a / (l + r)) in whole decimals."""
    return F.expr(f"cast(cast(a as decimal(27,0)) * 2000000 div ({first} + {rest}) as long)")


def collocations(documents: DataFrame, top: int | None = TOP, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK, bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases whose words keep together most.

    A null lang counts as ``und``, a null text as empty; a null or repeated doc_id changes
    nothing, each row counts. Equal scores go by occurrences, then by the bytes of the
    phrase. ``top`` None keeps all. An empty table gives an empty result. ``bits`` cuts
    the first fingerprint, for tests of collisions; ``longest`` is 2 to 4.
    """
    counts = PhraseCounts(documents, longest, least, chunk_bytes, bits)
    words, phrases = counts.frequent()
    texts = stored(counts.texts(phrases), "phrase-texts")
    known = texts.join(phrases.select("fp", "check", "a"), ["fp", "check"])
    parts = stored(known.select("fp", "check", "a", F.inline("parts").alias("from", "length", "part", "part_check")), "phrase-parts")

    # A part of a candidate has at least its occurrences, so it is frequent itself.
    every = words.union(phrases).select(F.col("fp").alias("part"), F.col("check").alias("part_check"), F.col("a").alias("f"))
    cuts = parts.join(every, ["part", "part_check"]).groupBy("fp", "check", "a")
    at = lambda s, m: F.max(F.when((F.col("from") == s) & (F.col("length") == m), F.col("f")))
    of_part = {}
    for k in range(2, longest + 1):
        for j in range(1, k):
            of_part[f"_0_{j}"], of_part[f"_{j}_{k - j}"] = at(0, j), at(j, k - j)
    sums = cuts.agg(*[c.alias(name) for name, c in of_part.items()])
    longer = parts.where("length > 1").groupBy(F.col("part").alias("fp"), F.col("part_check").alias("check")).agg(F.max("a").alias("_longer"))

    rows = texts.drop("parts").join(sums, ["fp", "check"]).join(longer, ["fp", "check"], "left")
    rows = rows.where(F.col("_longer").isNull() | (F.col("_longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * WITHIN))
    best = None
    for k in range(2, longest + 1):
        cut = [
            F.struct(_score(f"_0_{j}", f"_{j}_{k - j}").alias("score"), F.lit(j).alias("j"), F.col(f"_0_{j}").alias("l"), F.col(f"_{j}_{k - j}").alias("r"))
            for j in range(1, k)
        ]
        least_cut = F.least(*cut) if len(cut) > 1 else cut[0]
        best = F.when(F.col("k") == k, least_cut) if best is None else best.when(F.col("k") == k, least_cut)
    rows = rows.withColumn("_best", best).select("lang", "phrase", "a", "_best.l", "_best.r", "_best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(counts.words(), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
