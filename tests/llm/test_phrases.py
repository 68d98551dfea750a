"""Collocations against a count of all runs of words in plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from starfold.llm import phrases

SCHEMA = "doc_id long, text string, lang string, a int, rank int, chunk string, file string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "c", "f") for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute_force(rows, least, longest=4, top=2000):
    count, words = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = count.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            words[lang] += len(w)
            for k in range(1, longest + 1):
                f.update(w[i : i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        dropped = set()
        for q in candidates:
            for m in range(2, len(q)):
                for s in range(len(q) - m + 1):
                    if 100 * f[q] >= 80 * f[q[s : s + m]]:
                        dropped.add(q[s : s + m])
        found = []
        for p in candidates:
            if p not in dropped:
                score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(out)


def corpus():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Été", "ÉTÉ", "a-b", "x y", "日本", "😀"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", ";", "\n", "\r\n", "!", " ? ", "\x0b"]
    rows = []
    for i in range(200):
        parts = []
        for _ in range(rng.integers(1, 40)):
            parts += [vocabulary[min(int(rng.exponential(4)), len(vocabulary) - 1)], gaps[rng.integers(len(gaps))]]
        rows.append(("".join(parts), ["en", "de", None, ""][min(i % 7, 3)]))
    passage = "New York City hall is here. " * 5
    rows += [(passage, "en")] * 4 + [(None, "en"), ("", "fr"), (" .,;\n", "fr"), ("one", "fr")]
    return rows


def answer(spark, rows, **settings):
    found = phrases.collocations(frame(spark, rows).repartition(4), **settings).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found)


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 300}, {"bits": 6}, {"top": 3}, {"longest": 2}, {"longest": 3}])
def test_collocations_equal_brute_force(spark, settings):
    rows = corpus()
    expected = brute_force(rows, 5, settings.get("longest", 4), settings.get("top", 2000))
    assert len(expected) > 8 and answer(spark, rows, least=5, **settings) == expected


def test_a_very_long_text_is_cut_between_pieces(spark):
    rows = [("some words here again, " * 3000, "en"), ("no end " * 2000, "en")]
    assert answer(spark, rows, least=30, chunk_bytes=1000) == brute_force(rows, 30)


def test_texts_that_share_both_fingerprints_end_the_job(spark, monkeypatch):
    monkeypatch.setattr(phrases.Grams, "check", lambda self, place, k: np.zeros(len(place), np.int64))
    with pytest.raises(PySparkException, match="share both fingerprints"):
        answer(spark, corpus(), least=5, bits=2)


def test_no_documents(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(None, None), ("", "en")]) == []


def test_bitmap_has_a_bit_for_each_number(spark):
    rng = np.random.default_rng(2)
    known = rng.integers(-(2**63), 2**63 - 1, 5000)
    bitmap = phrases._bitmap(spark.createDataFrame([(int(x),) for x in known], "fp long"))
    assert phrases._may_be(bitmap, known.view(np.uint64)).all()
    assert phrases._may_be(bitmap, rng.integers(0, 2**63, 5000).view(np.uint64)).mean() < 0.1


def test_remainders_without_a_division():
    rng = np.random.default_rng(4)
    p = phrases.PRIME
    x = np.concatenate([[0, 1, p - 1, p, p + 1, 2 * p, p * p, 2**62, 2**63 - 1], rng.integers(0, 2**63 - 1, 10_000)])
    assert (phrases._mod(x) == x % p).all()


def test_counting_words_computes_no_prefix():
    grams = phrases.Grams(["en"], pa.array([b"one two, three"], pa.large_binary()))
    assert len(grams) == 3 and "prefix" not in vars(grams)
    grams.fingerprint(grams.places(2), 2)
    assert "prefix" in vars(grams)
