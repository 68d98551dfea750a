"""Long repeats across documents, found by recompression of their words.

Each round replaces pairs of neighbouring symbols by new ones; before the first, runs of
one word become one symbol. A symbol's name is a number computed from what it stands for,
so all tasks name alike without a common dictionary, and equal passages have the same
symbols inside. Which pairs merge is fixed by one bit of each name: a symbol of the left
kind merges with a following one of the right kind.

Bounds of the symbols of the third round are anchors. A passage of WINDOW words has an
anchor among its first WINDOW - KEY + 1 places that only its own words decide:
  a run that reaches out of the passage hides its first word, and each of three rounds
  may hide one symbol more, of up to 1, 2 and 4 words, so the first sure bound comes
  after 1 + 1 + 2 + 4 words at most;
  a run inside has an anchor at each of its words.
So two equal passages share a key, the KEY words from an anchor on. Shared keys reveal
where documents can have passages in common; there, all windows of WINDOW words are
compared by their numbers, which verifies the repeats and finds the least document of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.chunks import Chunks
from starfold.llm.common import stored
from starfold.llm.words import Words, mixed, word_reader
from starfold.session import ship_by_value

ship_by_value(__name__)

WINDOW, KEY, ROUNDS = 13, 5, 3
#: Places before an anchor at which a window with this anchor can start.
REACH = WINDOW - KEY
#: Keys are filters, so fewer bits are enough; they shuffle better.
KEY_BITS = 48
PAIR, RUN = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def anchors(words: Words) -> np.ndarray:
    """Places of anchors that have KEY words of their row from there on, in order."""
    row = words.row()
    name, place = words.number, np.arange(len(words.number))
    # Runs: the first word of a run stands for it, all its words are anchors.
    same = np.zeros(len(name), bool)
    same[1:] = (name[1:] == name[:-1]) & (row[1:] == row[:-1])
    in_run = same.copy()
    in_run[:-1] |= same[1:]
    place = place[~same]
    length = np.diff(np.append(place, len(name))).astype(np.uint64)
    name = np.where(length > 1, mixed(name[place] + length * RUN), name[place])
    for level in range(ROUNDS):
        left = (mixed(name ^ np.uint64(level + 1)) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (row[place[:-1]] == row[place[1:]])
        merged = np.zeros(len(name), bool)
        merged[1:] = pair[:-1]
        both = name.copy()
        both[:-1] = np.where(pair[:-1], mixed(name[:-1] * PAIR + name[1:]), name[:-1])
        name, place = both[~merged], place[~merged]
    chosen = in_run
    chosen[place] = True
    found = np.flatnonzero(chosen)
    return found[found + KEY <= words.first[1:][row[found]]]


def least_documents(number: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is of the least document with its number here, number is in several documents)."""
    order = np.lexsort((doc, number))
    n, d = number[order], doc[order]
    first = np.ones(len(n), bool)
    first[1:] = n[1:] != n[:-1]
    group = np.cumsum(first) - 1
    low = d[first][group] if len(n) else d
    several = np.zeros(int(first.sum()), bool)
    several[group[d != low]] = True
    least, shared = np.empty(len(n), bool), np.empty(len(n), bool)
    least[order], shared[order] = d == low, several[group]
    return least, shared


def _keys(texts: pa.RecordBatch, _: pa.Table) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, shared, least): distinct keys of each document; shared as known here."""
    words = word_reader().read(texts.column(1))
    at = anchors(words)
    key = words.windows_at(at, KEY) >> np.uint64(64 - KEY_BITS)
    named = texts.column(0).is_valid().to_numpy(zero_copy_only=False)[words.row()[at]]
    at, key = at[named], key[named]
    doc = texts.column(0).fill_null(0).to_numpy()[words.row()[at]]
    order = np.lexsort((doc, key))
    once = np.ones(len(order), bool)
    once[1:] = (key[order][1:] != key[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    kept = np.sort(order[once])  # rows of a document stay together and compress
    key, doc = key[kept], doc[kept]
    least, shared = least_documents(key, doc)
    yield pa.RecordBatch.from_arrays(
        [pa.array(key.astype(np.int64)), pa.array(doc), pa.array(shared), pa.array(least)],
        names=["key", "doc_id", "shared", "least"],
    )


def _rows_of(found: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(row of the texts, value) of a list column of findings, one pair for each value."""
    lists = found[name].combine_chunks()
    counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    return np.repeat(found["row"].to_numpy(), counts), lists.flatten().to_numpy()


def _windows(texts: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
    """(window, doc_id, chunk, row, place, least) near the shared keys of documents."""
    words = word_reader().read(texts.column(1))
    row, at = words.row(), anchors(words)
    key = (words.windows_at(at, KEY) >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    at = at[_contains(*_rows_of(found, "keys"), row[at], key)]
    n = len(words.number)
    marks = np.zeros(n + 1, np.int64)  # windows from REACH before an anchor up to it
    np.add.at(marks, np.maximum(at - REACH, words.first[row[at]]), 1)
    np.add.at(marks, at + 1, -1)
    near = np.flatnonzero(np.cumsum(marks)[:n] > 0)
    place = near[near + WINDOW <= words.first[1:][row[near]]]
    number = words.windows_at(place, WINDOW).astype(np.int64)
    doc = texts.column(0).fill_null(0).to_numpy()[row[place]]
    least, _ = least_documents(number, doc)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(number),
            pa.array(doc),
            pa.array(np.full(len(place), found["chunk"][0].as_py())),
            pa.array(row[place].astype(np.int32)),
            pa.array((place - words.first[row[place]]).astype(np.int32)),
            pa.array(least),
        ],
        names=["window", "doc_id", "chunk", "row", "place", "least"],
    )


def _contains(owner: np.ndarray, known: np.ndarray, row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which (row, key) are among the (owner, known)."""
    salt = lambda r, k: mixed(k.astype(np.uint64) ^ mixed(r.astype(np.uint64)))
    return np.isin(salt(row, key), salt(owner, known))


def _kept(texts: pa.RecordBatch, found: pa.Table) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, n_removed, kept) from texts, covered places and whole copies."""
    words = word_reader().read(texts.column(1))
    row, n, count = words.row(), len(words.number), np.diff(words.first)
    owner, place = _rows_of(found, "places")
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, words.first[owner] + place, 1)
    np.add.at(marks, words.first[owner] + place + WINDOW, -1)
    copy = np.zeros(len(count), bool)
    copy[found["row"].to_numpy()[found["copy"].to_numpy()]] = True
    copy &= count >= WINDOW
    removed = (np.cumsum(marks)[:n] > 0) | copy[row]
    total = np.append(0, np.cumsum(removed))
    gone = total[words.first[1:]] - total[words.first[:-1]]
    data, keep = words.data.tobytes(), np.flatnonzero(~removed)
    pieces = [data[a:b] for a, b in zip(words.start[keep].tolist(), words.end[keep].tolist())]
    ends = np.searchsorted(keep, words.first)
    kept = [b" ".join(pieces[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    yield pa.RecordBatch.from_arrays(
        [texts.column(0), pa.array(count), pa.array(gone), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept"],
    )


def _text_numbers(texts: pa.RecordBatch) -> list[pa.Array]:
    """128 bits for each text."""
    digests = [hashlib.blake2b(t.as_buffer(), digest_size=16).digest() for t in texts.column(1)]
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row without words of earlier passages.

    A word goes if any WINDOW consecutive words that cover it also occur in a document
    of smaller doc_id, judged on the texts as given. ``kept`` joins the words that stay
    by one space. A null text has no words; a row without doc_id keeps all its words
    and is no earlier document; rows of one doc_id don't count as earlier than each
    other. Empty tables give empty results.
    """
    chunks = Chunks(documents, _text_numbers, "h1 long, h2 long")
    named = chunks.refs.where("doc_id is not null")
    # Documents whose whole text an earlier one has need no comparison of passages.
    least = named.groupBy("h1", "h2").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    several = least.where("_least < _most").drop("_most")
    copies = named.join(several, ["h1", "h2"]).where("doc_id > _least").select("chunk", "row")
    copies = stored(copies, "copies")

    # Rows that are not of the least document of their chunk are shared for sure. A group
    # of equal keys gets one document of each chunk; the others are groups of their own,
    # so no frequent passage makes a large group.
    apart = F.when(F.col("least"), F.lit(None)).otherwise(F.col("doc_id"))
    keys = chunks.map(chunks.every(), _keys, "key long, doc_id long, shared boolean, least boolean")
    by_key = Window.partitionBy("key", apart)
    meets = F.min("doc_id").over(by_key) < F.max("doc_id").over(by_key)
    shared = keys.withColumn("_shared", F.col("shared") | meets).where("_shared")
    known = shared.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    originals = named.select("chunk", "row", "doc_id").join(copies, ["chunk", "row"], "left_anti")
    # Keys grow with the corpus; the planner must not take them for a small side.
    found = originals.join(known.hint("merge"), "doc_id").select("chunk", "row", "keys")
    schema = "window long, doc_id long, chunk long, row int, place int, least boolean"
    windows = chunks.map(found, _windows, schema)
    by_window = Window.partitionBy("window", apart)
    earlier = ~F.col("least") | (F.col("doc_id") > F.min("doc_id").over(by_window))
    covered = windows.withColumn("_covered", earlier).where("_covered")
    places = covered.groupBy("chunk", "row").agg(F.collect_list("place").alias("places"))
    nothing = F.lit(None).cast("array<int>")
    marks = (
        places.withColumn("copy", F.lit(False))
        .unionByName(copies.withColumns({"places": nothing, "copy": F.lit(True)}))
        .unionByName(chunks.every().withColumns({"places": nothing, "copy": F.lit(False)}))
    )
    return chunks.map(marks, _kept, "doc_id long, n_words long, n_removed long, kept string")
