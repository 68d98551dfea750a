"""Patched frame-of-reference blocks of token ids, and the shard files made of them.

A block holds BLOCK ids: their minimum, the differences packed at the width that a given
percentile of them needs, and a list of exceptions (place, whole difference) for the rest.

Shard file, little-endian:
    MAGIC, blocks, block starts (u64 each), documents (id i64, null flag u8, ids u64),
    footer (blocks u64, documents u64, ids u64, start of the block starts u64), MAGIC
Block: minimum u32, width u8, exceptions u16, ids u16, packed words, places u8, values u32
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

from starfold.session import ship_by_value

ship_by_value(__name__)

MAGIC = b"PFORIDS1"
BLOCK, GROUP = 256, 64
PERCENTILE = 90
HEAD, FOOT = "<IBHH", "<4Q8s"
HEAD_SIZE, FOOT_SIZE = struct.calcsize(HEAD), struct.calcsize(FOOT)
DOCUMENT = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8")])
#: Blocks that are packed or unpacked together.
TOGETHER = 2048


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) numbers below 2^width as (n, BLOCK * width / 64) words."""
    v = values.astype(np.uint64).reshape(len(values), -1, GROUP)
    out = np.zeros((*v.shape[:2], width), np.uint64)
    for i in range(GROUP if width else 0):
        word, shift = divmod(i * width, 64)
        out[:, :, word] |= v[:, :, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= v[:, :, i] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(len(words), BLOCK // GROUP, width)
    out = np.zeros((*w.shape[:2], GROUP), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(GROUP if width else 0):
        word, shift = divmod(i * width, 64)
        v = w[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (w[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, i] = v & mask
    return out.reshape(len(words), BLOCK)


def _widths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of the ids in order; a last short block repeats its last id as filling."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    full = np.full(n * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(n, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    at = (BLOCK - 1) * PERCENTILE // 100
    width = _widths(np.partition(diff, at, axis=1)[:, at])
    patched = (diff.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    kept = np.where(patched, 0, diff)
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        words = _pack(kept[rows], int(w))
        for row, data in zip(rows, words):
            packed[row] = data.astype("<u8").tobytes()
    row, place = np.nonzero(patched)
    value = diff[row, place].astype("<u4")
    place = place.astype(np.uint8)
    ends = np.searchsorted(row, np.arange(n + 1))
    blocks = []
    for i in range(n):
        a, b = ends[i], ends[i + 1]
        count = BLOCK if i < n - 1 else len(ids) - BLOCK * (n - 1)
        head = struct.pack(HEAD, int(low[i]), int(width[i]), int(b - a), count)
        blocks.append(head + packed[i] + place[a:b].tobytes() + value[a:b].tobytes())
    return blocks


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks; ``starts`` are their places in ``data``."""
    heads = [struct.unpack_from(HEAD, data, s) for s in starts.tolist()]
    width = np.array([h[1] for h in heads])
    raw = np.frombuffer(data, np.uint8)
    out = np.empty((len(heads), BLOCK), np.uint64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = BLOCK // 8 * int(w)
        at = starts[rows][:, None] + HEAD_SIZE + np.arange(size)
        out[rows] = _unpack(np.ascontiguousarray(raw[at]).view("<u8"), int(w))
    for i, (_, w, e, _) in enumerate(heads):
        if e:
            at = int(starts[i]) + HEAD_SIZE + BLOCK // 8 * w
            out[i, raw[at : at + e]] = np.frombuffer(data, "<u4", e, at + e)
    out += np.array([h[0] for h in heads], np.uint64)[:, None]
    return out.ravel()[: BLOCK * (len(heads) - 1) + heads[-1][3]].astype("<u4")


class ShardWriter:
    """Streams documents into a shard file; holds no more than TOGETHER blocks of ids."""

    def __init__(self, out):
        self.out, self.at, self.total = out, len(MAGIC), 0
        self.starts: list[int] = []
        self.documents: list[tuple] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is None, len(ids)))
        self.total += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK * TOGETHER:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate([np.empty(0, np.uint32), *self.waiting])
        end = len(ids) // BLOCK * BLOCK if whole else len(ids)
        for first in range(0, end, BLOCK * TOGETHER):
            for block in encode_blocks(ids[first : min(end, first + BLOCK * TOGETHER)]):
                self.starts.append(self.at)
                self.at += len(block)
                self.out.write(block)
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(whole=False)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array(self.documents, DOCUMENT).tobytes())
        sizes = len(self.starts), len(self.documents), self.total, self.at
        self.out.write(struct.pack(FOOT, *sizes, MAGIC))


class ShardReader:
    """Random access to a shard file through its block starts."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - FOOT_SIZE)
        n, documents, self.total, at, magic = struct.unpack(FOOT, source.read(FOOT_SIZE))
        if magic != MAGIC:
            raise ValueError("not a shard file")
        source.seek(at)
        self.starts = np.append(np.frombuffer(source.read(8 * n), "<u8"), at).astype(np.int64)
        self.documents = np.frombuffer(source.read(DOCUMENT.itemsize * documents), DOCUMENT)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from place ``start`` on and before ``end``, from just the blocks they lie in."""
        if start >= end:
            return np.empty(0, "<u4")
        a, b = start // BLOCK, -(-end // BLOCK)
        low = int(self.starts[a])
        self.source.seek(low)
        data = self.source.read(int(self.starts[b]) - low)
        return decode_blocks(data, self.starts[a:b] - low)[start - a * BLOCK : end - a * BLOCK]

    def stream(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document's place, ids before it in its text, ids) in order, in bounded pieces."""
        step, at, document, done = BLOCK * TOGETHER, 0, 0, 0
        while document < len(self.documents):
            piece, used = self.ids(at, min(at + step, self.total)), 0
            while document < len(self.documents):
                left = int(self.documents[document]["n"]) - done
                take = min(left, len(piece) - used)
                yield document, done, piece[used : used + take]
                used, done = used + take, done + take
                if take < left:
                    break
                document, done = document + 1, 0
            at += len(piece)
