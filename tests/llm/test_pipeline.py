"""The pipeline and the registered queries on the smallest tables, against brute force."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from oracle import connect, differences
from starfold.llm import mixing
from starfold.llm.common import stored, table
from starfold.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_all_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_each_stage_equals_brute_force_on_its_input(spark):
    docs, kept = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        kept[name] = docs.collect()
    columns = table(spark, SF_DIR, "documents").columns
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    labels = {r.doc_id: r for r in table(spark, SF_DIR, "labels").collect()}

    good = {r.doc_id for r in kept["quality_classifier"]}
    known = [d for d in texts if d in labels]
    right = np.mean([(d in good) == (labels[d].quality == 1 and labels[d].toxic == 0) for d in known])
    assert right > 0.95

    sets = {d: shingles(texts[d]) for d in good}
    root = {d: d for d in good}
    for a in sorted(good):
        for b in sorted(good):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    single = {d for d in good if root[d] == d}
    assert {r.doc_id for r in kept["ngram_jaccard_join"]} == single

    whole = lambda t: {s for s in shingles(t) if len(s) == 5}
    items = [whole(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = {d for d in single if not any(s and len(s & whole(texts[d])) >= 0.75 * len(s) for s in items)}
    assert {r.doc_id for r in kept["benchmark_decontamination"]} == clean

    mixed = kept["source_mixing"]
    assert [list(r.asDict()) for r in mixed[:1]] == [columns]
    assert max(Counter(r.doc_id for r in mixed).values()) <= mixing.MOST and {r.doc_id for r in mixed} <= clean

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for r in sorted(mixed, key=lambda r: r.doc_id):
        ids = library.encode(r.text, add_special_tokens=False).ids + [0]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, kept["token_output"]), key=lambda r: r[1]) == expected
