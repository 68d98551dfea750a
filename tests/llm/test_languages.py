"""Language identification: features and fit in plain Python, and accuracy on held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from starfold.llm import languages
from starfold.llm.common import table

SCHEMA = "doc_id long, text string, lang string, score int, held_out string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def plain_runs(text):
    """All runs of up to three characters of the words with their bounds."""
    out, words = Counter(), "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for word in words:
        padded = " " + word + " "
        for k in (1, 2, 3):
            out.update(g for i in range(len(padded) - k + 1) if (g := padded[i : i + k]).strip())
    return out


TEXTS = ["Ab c.", "", "éa-b\n\nÉ", "日本 go", "a", "...", "İstanbul ŞEHIR x1y2", "word " * 50, "z"]


def test_runs_are_those_of_padded_words():
    size = [0] * len(TEXTS)
    distinct = [set() for _ in TEXTS]
    for row, bucket in languages.runs(TEXTS):
        for r, b in zip(row.tolist(), bucket.tolist()):
            size[r] += 1
            distinct[r].add(b)
    expected = [plain_runs(t) for t in TEXTS]
    assert size == [sum(e.values()) for e in expected]
    assert [len(d) for d in distinct] == [len(e) for e in expected]
    counted = list(languages.counts(TEXTS))
    assert [sorted(c.tolist()) for _, c in counted] == [sorted(e.values()) for e in expected]


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = "some words of any length here " * 40
    whole = [(b.tolist(), c.tolist()) for b, c in languages.counts([text, "x", text])]
    monkeypatch.setattr(languages, "BLOCK", 100)
    assert [(b.tolist(), c.tolist()) for b, c in languages.counts([text, "x", text])] == whole


def test_rarity_counts_texts(spark):
    rare = languages.rarity(spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3))
    for (bucket, _), text in zip(languages.counts(TEXTS), TEXTS):
        for b in bucket.tolist():
            n = sum(b in found for found, _ in languages.counts(TEXTS))
            assert rare[b] == pytest.approx(math.log((1 + len(TEXTS)) / (1 + n)) + 1, rel=1e-6)


def test_fit_is_sparse_and_right():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        own = i % 3
        bucket = np.unique(np.append(rng.integers(100, 5000, 30), [own, 10 + own]))
        rows.append((bucket, np.ones(len(bucket)), own))
    weight, bias = languages.follow_the_leader(rows[:500], 3, languages.Ftrl(l1=1.0))
    assert (np.abs(weight).max(1) > 0).mean() < 0.02
    logits = np.array([v @ weight[b] + bias for b, v, _ in rows[500:]])
    assert (logits.argmax(1) == [y for *_, y in rows[500:]]).all()


def test_temperature_makes_scores_probabilities():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(20000, 4)) * 2
    p = languages._softmax(logits)
    own = (p.cumsum(1) < rng.random((20000, 1))).sum(1)
    assert languages.temperature(logits * 3, own) == pytest.approx(3, rel=0.05)
    assert languages.temperature(np.zeros((0, 4)), np.zeros(0, int)) == 1


def test_held_out_documents_are_identified(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = languages.learn(docs)
    found = {r.doc_id: r for r in languages.identify(docs, model).collect()}
    known = {r.doc_id: r for r in docs.collect()}
    assert found.keys() == known.keys()
    out = [d for d in known if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in found.items() if r.held_out} == set(out) and len(out) > 100
    right = [found[d].lang_pred == known[d].lang for d in out if plain_runs(known[d].text)]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert model.buckets_used < 1 << (languages.BITS - 1)


def test_labels_of_held_out_documents_are_not_learned(spark):
    rows = [(i, "alpha beta gamma" if i % 2 else "delta omega sigma", "one" if i % 2 else "two") for i in range(200)]
    secret = [(i, t, "secret" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    secret += [(None, "unknown", "nobody"), (500, None, "nothing"), (501, "12 34 !", None), (3, "alpha beta gamma", "one")]
    df = frame(spark, secret).repartition(3)
    found = languages.identify(df, languages.learn(df)).collect()
    assert len(found) == len(secret)
    for r in found:
        if r.doc_id in (500, 501):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == ("one" if r.doc_id % 2 else "two") and r.score > 0.5
    assert {r.lang_pred for r in found} == {"one", "two", "und"}


def test_nothing_to_learn_from(spark):
    assert languages.learn(frame(spark, [])) is None
    df = frame(spark, [(1, "word", None), (2, None, "en"), (None, "x", "en")])
    assert [(r.lang_pred, r.score) for r in languages.identify(df, languages.learn(df)).collect()] == [("und", 0.0)] * 3
    one = frame(spark, [(1, "word", "xx"), (3, "", "xx")])
    found = languages.identify(one, languages.learn(one)).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in found] == [(1, "xx", 1.0), (3, "und", 0.0)]
