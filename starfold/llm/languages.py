"""Language identification by sparse multinomial logistic regression.

Features are runs of one to three characters of the words of a text, each word with its
bounds, hashed to buckets and weighed by frequency in the text and rarity over all texts
that may be learned from. Follow-the-regularised-leader fits the weights one text after
another; the first penalty keeps most of them at zero, the second keeps them small. Texts
of the sample that the fit did not see set a temperature, so that scores are probabilities.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import stored, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.llm.words import slices
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Texts that weights and temperature are fitted on, about: an equal quota of each language,
#: at least LEAST_EACH, drawn by a hash of the id. Rarity is counted over all texts.
SAMPLE, LEAST_EACH = 8000, 50
#: Every so manieth text of the sample, in drawn order, serves the temperature only.
ASIDE = 5
#: Logarithm of the number of buckets; longest run of characters.
BITS, LONGEST = 18, 3
#: Parts that document frequencies move in.
PARTS = 64
TOGETHER = 2 << 20
#: Characters of one text that are looked at together; longer ones are cut at a space.
BLOCK = 1 << 20
UND = "und"


# --- features ------------------------------------------------------------------------


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """The table that calls in one worker share."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0]


def _blocks(text: str) -> Iterator[str]:
    """A long text in parts of BLOCK characters at most, each up to a space if it has one."""
    at = 0
    while len(text) - at > BLOCK:
        space = text.rfind(" ", at + 1, at + BLOCK)
        end = space if space > 0 else at + BLOCK
        yield text[at:end]
        at = end
    yield text[at:]


def runs(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all runs of characters, one length after the other.

    Lower-cased letters count; everything else is a bound, and a run has bounds at its
    ends only. A run without letters does not count.
    """
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lowered])
    letter = letters()[code]
    before = np.zeros(len(letter), bool)
    before[1:] = letter[:-1]
    keep = letter | before  # a letter, or the bound after one
    code, row, letter = code[keep], row[keep], letter[keep]
    code = np.where(letter, code, 0).astype(np.uint32)
    # The bound before a word is that of the word before it; the first word has one too.
    code, letter = np.concatenate([np.zeros(1, np.uint32), code]), np.concatenate([np.zeros(1, bool), letter])
    row = np.concatenate([np.zeros(1, np.int32), row])
    n = len(code)
    factor = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)
    for k in range(1, LONGEST + 1):
        m = n - k + 1
        if m <= 0:
            return
        hashed = np.full(m, k * 0x68E31DA4 & 0xFFFFFFFF, np.uint32)
        ok = letter[:m].copy() if k == 1 else np.ones(m, bool)
        for j in range(k):
            hashed = (hashed ^ code[j : j + m]) * np.uint32(factor[j])
            hashed ^= hashed >> np.uint32(15)
            if 0 < j < k - 1:
                ok &= letter[j : j + m]
        # A run's row is that of its last character: its first may be the bound of the row before.
        yield row[k - 1 :][ok], (hashed * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BITS))[ok].astype(np.int64)


def _text_groups(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, parts of their texts) with about BLOCK characters together."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for part in _blocks(text):
            if size + len(part) > BLOCK and parts:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, parts


def counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text, buckets ascending."""
    table = np.zeros(1 << BITS, np.int64)
    for text in texts:
        for part in _blocks(text):
            for _, bucket in runs([part]):
                table += np.bincount(bucket, minlength=1 << BITS) if len(bucket) > 1 << BITS else 0
                if len(bucket) <= 1 << BITS:
                    np.add.at(table, bucket, 1)
        found = np.flatnonzero(table)
        yield found, table[found]
        table[found] = 0


# --- rarity over all texts -----------------------------------------------------------


def _texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of this task, and in how many of them each bucket occurs, in parts."""
    total, n, seen = np.zeros(1 << BITS, np.int64), 0, np.zeros(1 << BITS, bool)

    def text_done() -> None:
        found = np.flatnonzero(seen)
        total[found] += 1
        seen[found] = False

    for batch in batches:
        for part in slices(batch, 0, TOGETHER):
            texts, last = part.column(0).to_pylist(), None
            n += len(texts)
            for rows, parts in _text_groups(texts):
                found = [(row, bucket) for row, bucket in runs(parts)]
                starts = [np.searchsorted(row, np.arange(len(rows) + 1)) for row, _ in found]
                for i, row in enumerate(rows):
                    if row != last and last is not None:
                        text_done()
                    last = row
                    for (_, bucket), start in zip(found, starts):
                        seen[bucket[start[i] : start[i + 1]]] = True
            text_done()
    packed = [zlib.compress(c.tobytes(), 1) for c in np.split(total, PARTS)]
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(range(PARTS), pa.int32()), "n": pa.array([n] * PARTS, pa.int64()), "counts": pa.array(packed, pa.binary())}
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for part, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(zlib.decompress(packed), np.int64)
            held = sums.setdefault(part, [0, np.zeros(len(own), np.int64)])
            held[0] += n
            held[1] += own
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array(list(sums), pa.int32()),
            "n": pa.array([n for n, _ in sums.values()], pa.int64()),
            "counts": pa.array([zlib.compress(c.tobytes(), 1) for _, c in sums.values()], pa.binary()),
        }
    )


def rarity(texts: DataFrame) -> np.ndarray:
    """log((1 + texts) / (1 + texts with the bucket)) + 1 of each bucket: 2^BITS floats.

    Counts of tasks are added up in parts; a fixed two megabytes come to the driver.
    """
    schema = "part int, n long, counts binary"
    rows = texts.mapInArrow(_texts_with, schema).repartition("part").mapInArrow(_added, schema).collect()
    n, table = 0, np.zeros((PARTS, (1 << BITS) // PARTS), np.int64)
    for row in rows:
        n = row["n"]
        table[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return (np.log((1 + n) / (1 + table.ravel())) + 1).astype(np.float32)


# --- fit -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Ftrl:
    """Learning rate, its start, the two penalties, and passes over the sample."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    passes: int = 2


#: Weights of features are means over thousands of runs; they are brought near one.
SPREAD = 32.0


def features(bucket: np.ndarray, count: np.ndarray, rare: np.ndarray) -> np.ndarray:
    return SPREAD * count / max(count.sum(), 1) * rare[bucket]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """(weights, biases) after some passes over (buckets, values, class)."""
    s = settings
    z, n = (np.zeros(((1 << BITS) + 1, classes)) for _ in range(2))
    rng = np.random.default_rng(0)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        kept = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -kept / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    for _ in range(s.passes):
        for i in rng.permutation(len(rows)):
            bucket, value, own = rows[i]
            bucket, value = np.append(bucket, 1 << BITS), np.append(value, 1.0)  # the last one is the bias
            zb, nb = z[bucket], n[bucket]
            w = weights(zb, nb)
            error = _softmax(value @ w)
            error[own] -= 1
            g = value[:, None] * error
            square = g * g
            z[bucket] = zb + g - (np.sqrt(nb + square) - np.sqrt(nb)) / s.alpha * w
            n[bucket] = nb + square
    w = weights(z, n)
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, own: np.ndarray) -> float:
    """The divisor of the logits at which their classes are likeliest, by golden section."""
    if not len(own):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(own)), own], 1e-300)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _fit(folder: str, langs: list[str], rare, settings: Ftrl):
    """Task function: fits the bounded sample and writes the model; returns its file's name."""
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, aside = [], []
        for batch in batches:
            for lang, bucket, count in zip(batch.column(0), batch.column(2), batch.column(3)):
                bucket = bucket.values.to_numpy().astype(np.int64)
                if len(bucket):
                    value = features(bucket, count.values.to_numpy(), rare.value)
                    held = aside if (len(rows) + len(aside)) % ASIDE == ASIDE - 1 else rows
                    held.append((bucket, value, number[lang.as_py()]))
        weight, bias = follow_the_leader(rows, len(langs), settings)
        logits = np.array([value @ weight[bucket] + bias for bucket, value, _ in aside]).reshape(-1, len(langs))
        own = np.array([y for *_, y in aside], np.int64)
        heat = temperature(logits, own)
        used = np.flatnonzero(np.abs(weight).max(1) > 0)
        folded = (SPREAD * weight[used] * rare.value[used, None] / heat).astype(np.float32)
        packed, name = io.BytesIO(), f"{uuid.uuid4().hex}.npz"
        np.savez(packed, langs=np.frombuffer(json.dumps(langs).encode(), np.uint8), used=used, weight=folded, bias=bias / heat)
        with whole_file(folder, name) as out:
            out.write(packed.getvalue())
        right = float((logits.argmax(1) == own).mean()) if len(own) else None
        yield pa.RecordBatch.from_pydict(
            {"file": [name], "temperature": [heat], "aside_accuracy": pa.array([right], pa.float64()), "buckets_used": [len(used)]}
        )

    return run


def held_out(documents: DataFrame) -> Column:
    """Whether a document is kept from learning; one without doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Where a fitted model lies in the shared folder, and what is known of its fit."""

    folder: str
    file: str
    temperature: float
    aside_accuracy: float | None
    buckets_used: int


def learn(documents: DataFrame, settings: Ftrl = Ftrl(), sample: int = SAMPLE) -> Model | None:
    """Fit on documents that have doc_id, text and lang and are not held out; None if there are none.

    Rows that repeat a doc_id in one language are one text of the sample, the least of
    theirs.
    """
    spark = documents.sparkSession
    known = documents.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), held_out(documents).alias("_out")
    ).where("not _out and doc_id is not null and lang is not null and text is not null")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    if not langs:
        return None
    rare = spark.sparkContext.broadcast(rarity(known.select("text")))
    quota = max(sample // len(langs), LEAST_EACH)
    drawn = Window.partitionBy("lang").orderBy("key", "doc_id")
    ids = (
        known.select("doc_id", "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("key"))
        .distinct()
        .withColumn("_rank", F.row_number().over(drawn))
        .where(F.col("_rank") <= quota)
        .drop("_rank")
    )
    ids = stored(ids, "language-sample")
    chosen = known.join(ids, ["doc_id", "lang"]).groupBy("key", "doc_id", "lang").agg(F.min("text").alias("text"))

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, TOGETHER):
                found = list(counts(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                        pa.array([c for _, c in found], pa.list_(pa.int64())),
                    ],
                    names=["lang", "key", "bucket", "count"],
                )

    counted = chosen.select("lang", "key", "text").mapInArrow(count_rows, "lang string, key long, bucket array<int>, count array<long>")
    folder = work_dir(spark, "language-model")
    fitted = counted.repartition(1).sortWithinPartitions("key", "lang").mapInArrow(
        _fit(folder, langs, rare, settings), "file string, temperature double, aside_accuracy double, buckets_used long"
    )
    return Model(folder, *stored(fitted, "language-fit").first())


# --- prediction ----------------------------------------------------------------------


class Scorer:
    """A model as a worker holds it."""

    def __init__(self, folder: str, name: str):
        with open_file(folder, name) as source:
            held = np.load(io.BytesIO(source.read()))
        self.langs = json.loads(held["langs"].tobytes())
        self.bias = held["bias"]
        self.weight = np.zeros((len(self.langs), 1 << BITS), np.float32)
        self.weight[:, held["used"]] = held["weight"].T

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        sums, total = np.zeros((n, len(self.langs))), np.zeros(n, np.int64)
        for rows, parts in _text_groups(texts):
            rows = np.array(rows)
            for row, bucket in runs(parts):
                total += np.bincount(rows[row], minlength=n)
                for k, weight in enumerate(self.weight):
                    sums[:, k] += np.bincount(rows[row], weight[bucket], n)
        p = _softmax(sums / np.maximum(total, 1)[:, None] + self.bias)
        best = p.argmax(1)
        none = total == 0
        return [UND if empty else self.langs[k] for k, empty in zip(best.tolist(), none)], np.where(none, 0.0, p.max(1))


_SCORERS: dict[str, Scorer] = {}


def scorer(folder: str, name: str) -> Scorer:
    """The model that calls in one worker share; only the last one is held."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(folder, name)
    return _SCORERS[name]


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    A null text, or one without a letter, is ``und`` with score 0; so is everything if
    there was nothing to learn from. Of equally likely languages the first by name comes.
    Nulls and repeats of doc_id change nothing. An empty table gives an empty result.
    """
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    names = ["doc_id", "held_out", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(model.folder, model.file)
        for batch in batches:
            for part in slices(batch, 2, TOGETHER):
                langs, score = own.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(score)], names=names)

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(documents).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(run, schema)
