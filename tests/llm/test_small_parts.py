"""Parts that run without Spark: permutations, merges, DivideSkip, EM, escapes, encoders."""

import heapq
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from starfold.llm import ann, chat, decontam, jaccard_join, quality, sharding, token_blocks, warc
from starfold.llm.common import released
from starfold.llm.loser_tree import LoserTree
from starfold.llm.token_blocks import Encoder
from starfold.llm.words import slices

some_text = st.text(alphabet=st.sampled_from(list("ab<#\\:/turn> \nlhcé")), max_size=30)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = sharding.Permutation(n, seed=3)
    at = p.forward(np.arange(n))
    assert sorted(at.tolist()) == list(range(n))
    assert (p.backward(at) == np.arange(n)).all()


def test_place_and_its_inverse():
    for row in range(101):
        shard, slot = sharding.place(row, 101, 7, seed=1)
        assert sharding.row_at(shard, slot, 101, 7, seed=1) == row
    moved = sharding.Permutation(1000, 1).forward(np.arange(1000)) != np.arange(1000)
    assert moved.mean() > 0.9


@given(st.lists(st.lists(st.integers(0, 30), max_size=8).map(sorted), max_size=9))
def test_loser_tree_merges(runs):
    assert list(LoserTree(runs)) == list(heapq.merge(*runs))


@given(st.lists(st.sets(st.integers(0, 12)).map(sorted), max_size=9), st.integers(1, 9))
def test_divide_skip_counts(lists, least):
    counts = Counter(x for one in lists for x in one)
    assert jaccard_join.divide_skip(lists, least) == {k: v for k, v in counts.items() if v >= least}


def test_divide_skip_probes_long_lists():
    lists = [list(range(1000)), list(range(0, 1000, 2)), [4, 7, 8], [4, 9], [8]]
    assert jaccard_join.divide_skip(lists, 4) == {4: 4, 8: 4}


@given(some_text)
def test_escapes_are_reversible_and_hide_marks(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and "<" not in hidden and "#" not in hidden


@given(st.lists(st.tuples(some_text, some_text), max_size=4))
def test_turns_read_back(turns):
    for role, text in turns:
        row = chat.format_turn(role, [{"kind": "text", "text": text}], chat.Costs(), 0)
        assert chat.read_turn(row["formatted"]) == (role, text, [])


def test_typed_parts_become_placeholders_in_order():
    parts = [
        {"kind": "text", "text": "see <image 0 9>"},
        {"kind": "image", "uri": "a.png", "width": 28, "height": 15},
        None,
        {"kind": "audio", "uri": "b.wav", "seconds": 1.5},
        {"kind": None, "text": None},
        {"kind": "document", "uri": "c.pdf", "pages": None},
    ]
    row = chat.format_turn("assistant", parts, chat.Costs(), 3)
    assert row["formatted"] == "### assistant: see \\limage 0 9><image 3 4><audio 4 38><document 5 1024></turn>\n"
    assert [(a["n"], a["kind"], a["uri"], a["tokens"]) for a in row["attachments"]] == [
        (3, "image", "a.png", 4),
        (4, "audio", "b.wav", 38),
        (5, "document", "c.pdf", 1024),
    ]
    spans = [row["formatted"][s["start"] : s["end"]] for s in row["loss_spans"]]
    assert [chat.unescape(s) for s in spans] == ["see <image 0 9>"]
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video"}], chat.Costs(), 0)


def test_em_finds_the_accuracies_of_labellers():
    rng = np.random.default_rng(5)
    bad = rng.random(20_000) < 0.2
    right = np.array([0.95, 0.9, 0.7, 0.85])
    votes = np.where(rng.random((20_000, 4)) < right, bad[:, None], ~bad[:, None])
    votes = np.where(rng.random(votes.shape) < 0.1, 1, np.where(votes, 0, 2))
    found, counts = np.unique(quality.pattern(votes), return_counts=True)
    model = quality.expectation_maximisation(found, counts.astype(float), 4)
    assert abs(model.prior - 0.2) < 0.02
    assert np.abs(model.accuracy() - right).max() < 0.04
    assert ((model.posterior(quality.pattern(votes)) > 0.5) == bad).mean() > 0.96


def test_em_without_documents():
    model = quality.expectation_maximisation(np.empty(0, np.int64), np.empty(0), 3)
    assert 0 < model.prior < 1


def test_scorer_learns_a_word():
    row = np.repeat(np.arange(200), 2)
    feature = np.stack([np.arange(200) % 50 + 100, np.where(np.arange(200) % 4 == 0, 77, 78)], 1).ravel()
    weights = quality.fit_scorer(row, feature, np.ones(400), (np.arange(200) % 4 == 0).astype(float))
    score = np.bincount(row, weights[feature]) + weights[-1]
    assert ((score > 0) == (np.arange(200) % 4 == 0)).all()


def test_best_bins_visits_every_leaf_once():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 8))
    tree = ann.fit_tree(x, 40, 4, 1)
    order = tree.best_bins(x[0], tree.n_leaves)
    assert sorted(order) == list(range(tree.n_leaves)) and tree.n_leaves > 20
    assert set(tree.assign(x)) <= set(order)


def test_visited_leaves_are_the_best_bins():
    rng = np.random.default_rng(5)
    tree = ann.fit_tree(rng.normal(size=(3000, 8)), 120, 4, 1)
    queries = rng.normal(size=(60, 8))
    for visits in (1, 2, 3, 7, 20, tree.n_leaves - 1, tree.n_leaves, tree.n_leaves + 5):
        for q, seen in zip(queries, tree.visited(queries, visits)):
            assert set(np.flatnonzero(seen)) == set(tree.best_bins(q, visits))


def test_best_keeps_the_largest_scores_and_smaller_ids_of_ties():
    rng = np.random.default_rng(6)
    scores = rng.integers(0, 40, (9, 4000)).astype(float)
    ids = rng.permutation(4000)
    best = ann.Best(9, 21)
    best.most = 100
    for a in range(0, 4000, 250):
        rows = rng.permutation(9)
        best.add(rows[:5], scores[rows[:5], a : a + 250], ids[a : a + 250])
        best.add(rows[5:], scores[rows[5:], a : a + 250], ids[a : a + 250])
    best.settle()
    for row in range(9):
        order = np.lexsort((ids, -scores[row]))[:21]
        assert best.ids[row].tolist() == ids[order].tolist() and best.scores[row].tolist() == scores[row, order].tolist()


def test_tree_of_equal_vectors_is_one_leaf():
    tree = ann.fit_tree(np.ones((50, 3)), 8, 4, 0)
    assert tree.n_leaves == 1 and tree.assign(np.ones((2, 3))).tolist() == [0, 0]


def test_band_rows_find_the_least_similar_hit():
    for n_item in (1, 10, 55):
        for largest in (1, 3, 63, 1023):
            rows = decontam.rows_for(n_item, largest)
            hits = -(-3 * n_item // 4)
            if rows:
                similarity = hits / (largest + n_item - hits)
                assert (1 - min(similarity, 1) ** rows) ** (decontam.HASHES // rows) <= decontam.MISS


def test_url_keys_and_records():
    assert warc.url_key("https://a.B.org:8080/x?q=1#f") == "org,b,a)/x?q=1"
    assert warc.url_key(None) == ")/"
    body = "é\r\n\r\nWARC/1.1".encode()
    import hashlib
    import zlib

    digest = hashlib.sha256(body).hexdigest()
    for first in (None, 3):
        record = warc.record_bytes(7, "http://x/a b\r\nEvil: 1", body, digest, first)
        packer = zlib.compressobj(6, wbits=31)
        read = warc.read_record(packer.compress(record) + packer.flush())
        kind = "response" if first is None else "revisit"
        assert read == {"page_id": 7, "payload_bytes": len(body), "payload_digest": digest, "record_type": kind, "refers_to": first}
    with pytest.raises(ValueError):
        packer = zlib.compressobj(6, wbits=31)
        warc.read_record(packer.compress(warc.record_bytes(7, "u", b"x", digest, None)) + packer.flush())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab,.!? \n\t'é1字<|endoftext|>")), max_size=25), max_size=5))
def test_word_lookup_gives_the_library_ids(texts):
    encoder = _encoder()
    found = [ids.tolist() for ids in encoder.encode(texts)]
    plain = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert found == [e.ids + [0] for e in plain]


def test_encoder_forgets_only_words_that_do_not_come_again(monkeypatch):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(token_blocks, "REMEMBERED", 60)
    for lot in range(30):
        often = " ".join(f"common{c}" for c in "abcdefgh")
        once = " ".join(f"rare{chr(97 + lot % 26)}{chr(97 + lot // 26)}{chr(97 + i)}" for i in range(20))
        texts = [f"{often} {once}, 7.\n{often}!", ""]
        found = [ids.tolist() for ids in encoder.encode(texts)]
        assert found == [e.ids + [0] for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
        assert len(encoder.numbers) <= 60 + 40
        assert lot < 2 or "commonb" in encoder.numbers
    assert "rareaaa" not in encoder.numbers


def test_encoder_remembers_words_without_punctuation_and_lines_apart():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.encode(["a Haus.\nHof, Haus,\nHof! Haus|"])
    assert [k for k in encoder.numbers if isinstance(k, str)] == ["Haus", "\nHof"]


def test_encoder_of_the_pipeline_needs_little_memory():
    """Its executors are full of earlier stages. With op5's own bound this took 92 MB."""
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), corpus_pipeline.REMEMBERED)
    rng, letters = np.random.default_rng(10), np.array(list("abcdefghijklmnop"))
    texts = [" ".join("".join(w) for w in letters[rng.integers(0, 16, (1500, 8))]) for _ in range(160)]
    batch, most, found = pa.RecordBatch.from_pydict({"text": texts}), 0, []
    tracemalloc.start()
    try:
        for part in slices(batch, 0, encoder.together()):
            found += [ids.tolist() for ids in encoder.encode(part.column(0).to_pylist())][::40]
            most = max(most, len(encoder.numbers))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most <= 130_000 and peak < 60e6
    assert found[0] == encoder.library.encode(texts[0], add_special_tokens=False).ids + [0]


_ENCODERS = []


def _encoder():
    if not _ENCODERS:
        _ENCODERS.append(Encoder(public_tokenizers.path("byte_bpe_50k.json")))
    return _ENCODERS[0]


def test_merged_counts_equal_counting():
    rng = np.random.default_rng(8)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(rng.integers(0, 12))]
        least = int(rng.integers(1, 8))
        every = Counter(int(i) for x in lists for i in x)
        ids, counts = jaccard_join.merged_counts(lists, least)
        assert dict(zip(ids.tolist(), counts.tolist())) == {i: c for i, c in every.items() if c >= least}


def test_entries_keep_their_values():
    rng = np.random.default_rng(9)
    parts, dense = [], np.zeros((30, quality.FEATURES), np.float32)
    for first in (0, 10, 20):
        at = np.unique(rng.integers(0, 10 * 64, 80))
        row, feature = first + at // 64, at % 64
        value = np.where(feature < quality.SHAPES, rng.random(len(at)), 1)
        dense[row, feature] = value
        parts.append(quality._Entries.of(row, feature, value))
    rows, features = rng.random(30) < 0.7, rng.random(quality.FEATURES) < 0.7
    row, feature, value = quality._Entries.joined([p.where(rows, features) for p in parts])
    found = np.zeros_like(dense)
    for i in range(0, len(row), 7):
        end = min(i + 7, len(row))
        found[row[i:end], feature[i:end]] = value[i:end]
    assert (found == dense * rows[:, None] * features[None, :]).all()


def test_a_task_gives_its_memory_back():
    """The worker lives on; what its task has freed must not stay with it."""

    def own_mb():
        status = open("/proc/self/status").read()
        return int(re.search(r"RssAnon:\s+(\d+)", status).group(1)) / 1024

    def task(batches):
        for batch in batches:
            # Blocks too small to be mapped one by one, and one that keeps the heap's end.
            held = [np.ones(8000) for _ in range(4000)]
            kept.append(np.ones(8000))
            del held
            yield batch

    kept, batch = [], pa.RecordBatch.from_pydict({"a": [1]})
    before = own_mb()
    assert list(task(iter([batch]))) == [batch] and own_mb() - before > 100
    assert list(released(task)(iter([batch]))) == [batch] and own_mb() - before < 50
