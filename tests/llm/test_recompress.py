"""Recompression against brute force, on texts full of runs, repeats and near repeats."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starfold.llm import recompress
from starfold.llm.words import WordReader


def brute_force(rows):
    """(doc_id, n_words, n_removed, kept) by comparing all windows."""
    words = [(d, (t or "").split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            if d is not None:
                x = tuple(w[i : i + 13])
                first[x] = min(first.get(x, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def sure_anchors(text):
    words = WordReader().read(pa.array([text]))
    return words, set(recompress.anchors(words).tolist())


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from("abc"), min_size=13, max_size=13),
    st.lists(st.sampled_from("abc"), max_size=12),
    st.lists(st.sampled_from("abc"), max_size=12),
    st.lists(st.sampled_from("abc"), max_size=12),
    st.lists(st.sampled_from("abc"), max_size=12),
)
def test_equal_passages_share_an_anchor(passage, a, b, c, d):
    """Whatever stands around a passage, both places have an anchor in common."""
    _, one = sure_anchors(" ".join(a + passage + b))
    _, two = sure_anchors(" ".join(c + passage + d))
    reach = range(recompress.REACH + 1)
    assert {i for i in reach if len(a) + i in one} & {i for i in reach if len(c) + i in two}


def test_words_are_those_of_the_contract():
    texts = ["  a\tb\n", None, "", "\x0b\x0c", "é x y", "z" * 3_000_000 + " q", "a b"]
    words = WordReader().read(pa.array(texts))
    assert np.diff(words.first).tolist() == [2, 0, 0, 0, 2, 2, 2]
    assert (words.number[:2] == words.number[-2:]).all()
    assert len(set(words.number.tolist())) == 6


def test_lower_case_touches_ascii_only():
    plain = WordReader().read(pa.array(["abc É"])).number
    lower = WordReader(lower=True).read(pa.array(["ABC É", "abc é"])).number
    assert lower[0] == lower[2] and lower[1] != lower[3] and plain[0] == lower[0]


@pytest.mark.parametrize("seed", [0, 1])
def test_documents_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    parts = [" ".join(rng.choice(list("abcdefgh"), n)) for n in (5, 13, 14, 30, 60)]
    parts += ["x " * 40, "p q " * 20, "", "\n u v "]
    texts = ["\n".join(rng.choice(parts, rng.integers(0, 5))) for _ in range(60)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(60), texts)]
    rows += [(None, texts[3]), (5, None), (7, "k " + texts[4]), rows[0], (100, texts[5]), (101, texts[5])]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, key string")
    found = [tuple(r) for r in recompress.remove_repeats(df.repartition(5)).collect()]
    assert sorted(found, key=str) == brute_force(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert recompress.remove_repeats(df).collect() == []
