"""Exact round trips of packed blocks and shard files."""

import io
import struct

import numpy as np
import pyarrow as pa
import pytest

from starfold.llm import pfor


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50_257, 1 << 32])
def test_blocks_give_back_their_ids(n, top):
    rng = np.random.default_rng(n + top % 1000)
    ids = rng.integers(0, top, n).astype(np.uint32)
    if n > 10:
        ids[::10] = top - 1
    blocks = pfor.encode_blocks(ids)
    if not n:
        assert blocks == []
        return
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert (pfor.decode_blocks(b"".join(blocks), starts) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.full(256, 1000, np.uint32)
    ids[:20] += 7
    ids[5] = 4_000_000_000
    (block,) = pfor.encode_blocks(ids)
    low, width, exceptions, count = struct.unpack_from(pfor.HEAD, block)
    assert (low, width, exceptions, count) == (1000, 0, 20, 256)


def test_shard_file_streams_documents_and_seeks(monkeypatch):
    monkeypatch.setattr(pfor, "TOGETHER", 2)
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 60_000, n).astype(np.uint32) for n in (1, 3000, 0, 511, 512, 1)]
    out = io.BytesIO()
    writer = pfor.ShardWriter(out)
    for doc, ids in zip([None, 4, 5, 5, 9, 10], texts):
        writer.add(doc, ids)
    writer.close()
    reader = pfor.ShardReader(pa.BufferReader(out.getvalue()))
    found = [np.empty(0, np.uint32) for _ in texts]
    for document, done, ids in reader.stream():
        assert done == len(found[document])
        found[document] = np.concatenate([found[document], ids])
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, texts))
    everything = np.concatenate(texts)
    assert (reader.ids(700, 2000) == everything[700:2000]).all()
    assert reader.documents["null"].tolist() == [1, 0, 0, 0, 0, 0]


def test_empty_shard():
    out = io.BytesIO()
    pfor.ShardWriter(out).close()
    reader = pfor.ShardReader(pa.BufferReader(out.getvalue()))
    assert list(reader.stream()) == [] and reader.total == 0
