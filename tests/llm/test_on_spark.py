"""Operators on small tables with nulls, ties, repeats, empty tables and clashing columns."""

import itertools
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from starfold.llm import ann, chat, decontam, jaccard_join, mixing, quality, sharding, token_blocks, warc
from starfold.session import shared_dir
from starfold.llm.components import connected

DOCS = "doc_id long, text string, source string, row int, shard string, size string"


def documents(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


# Nearest neighbours


def brute_force_neighbours(rows, k):
    good = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and len(v) == 4 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    }
    out = {}
    for q in (i for i in good if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q].tolist(), good[i].tolist())), i) for i in good if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_neighbours_equal_brute_force_where_all_leaves_are_visited(spark):
    rng = np.random.default_rng(0)
    vectors = rng.integers(-3, 4, (300, 4)).astype(float).tolist()  # many equal vectors and ties
    rows = list(enumerate(vectors)) + [(1000, None), (1001, []), (1002, [0.0] * 4), (1003, [1.0, None, 0.0, 0.0])]
    rows += [(1004, [math.nan, 1.0, 0.0, 0.0]), (1005, [math.inf, 1.0, 0.0, 0.0]), (None, [1.0] * 4), (1006, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    settings = ann.Settings(leaf=30, branch=3, recall=1.0, cell=50)
    found = ann.nearest(df, "vec_id % 20 = 0", 20, settings).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = brute_force_neighbours(rows, 20)
    assert got.keys() == expected.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 20 for q in got])
    assert recall > 0.97
    for q in got:
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) and len(got[q]) == 20


def test_neighbours_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (5, [2.0, 1.0])], schema)
    assert [tuple(r) for r in ann.nearest(few, "vec_id % 20 = 0").collect()] == [(0, 1, 5, 4.0)]
    assert ann.nearest(spark.createDataFrame([], schema), "vec_id % 20 = 0").collect() == []


def test_visits_store_no_row_for_each_query_and_leaf(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1200, 16)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    top = Path(shared_dir(spark).removeprefix("file:"), "starfold-llm")
    before = set(top.iterdir()) if top.exists() else set()
    found = ann.nearest(df, "true", 5, ann.Settings(leaf=3, recall=1.0)).collect()
    rows = {d.name.split("-")[0]: sum(pq.read_metadata(f).num_rows for f in d.glob("*.parquet")) for d in set(top.iterdir()) - before}
    assert rows["visits"] and max(rows.values()) <= 1200
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    true = {q: set(np.argsort(-s)[:5].tolist()) for q, s in enumerate(scores)}
    assert np.mean([r.vec_id in true[r.query_id] for r in found]) > 0.97 and len(found) == 6000


def test_neighbours_among_vectors_of_very_different_length(spark):
    """Single precision only tells which pairs to look at: all 20 are those of double products."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(800, 12)) * 10.0 ** rng.integers(-20, 18, 800)[:, None]
    vectors[:300] = vectors[0] + rng.normal(size=(300, 12)) * 1e-6 * np.abs(vectors[0]).max()  # products that differ in the last digits
    vectors = vectors.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    found = ann.nearest(df, "vec_id % 20 = 0", 20, ann.Settings(leaf=10_000)).collect()
    for q in range(0, 800, 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        np.testing.assert_allclose([x[2] for x in got], np.sort(scores)[::-1][:20], rtol=1e-12)
        np.testing.assert_allclose([scores[x[1]] for x in got], [x[2] for x in got], rtol=1e-12)


@pytest.mark.parametrize("shared", [0, 200_000])
def test_neighbours_of_vectors_that_many_rows_have(spark, monkeypatch, shared):
    """Queries that are not among the ids kept of their vector, repeated rows, an id of two vectors."""
    monkeypatch.setattr(ann, "CROWD", 30)
    monkeypatch.setattr(ann, "SHARED", shared)
    a, b, c = [1.0, 0.0], [0.6, 0.8], [-0.0, 1.0]
    rows = [(i, a) for i in range(100)] + [(i, b) for i in range(100, 112)] + [(7, c), (200, c), (201, [0.0, 1.0])]
    df = spark.createDataFrame([*rows, *rows[:50] * 5, *rows[100:104] * 12], "vec_id long, embedding array<float>").repartition(3)
    found = ann.nearest(df, "vec_id % 20 = 7 or vec_id = 103", 4).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    ones = [(i, 1.0) for i in range(8)]
    for q in (27, 47, 67, 87):
        assert got[q] == ones[:4]
    assert got[103] == [(100, 1.0), (101, 1.0), (102, 1.0), (104, 1.0)]
    assert got[107] == [(100, 1.0), (101, 1.0), (102, 1.0), (103, 1.0)]
    assert set(got) == {7, 27, 47, 67, 87, 103, 107}


# Jaccard join


def shingles(text):
    w = text.lower().split() if text else []
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(25):
        base = prose(rng, rng.integers(5, 120)).split()
        for _ in range(rng.integers(1, 6)):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(0, len(copy))] = "edited%d" % rng.integers(0, 50)
            texts.append(" ".join(copy + ["tail"] * rng.integers(0, 3)))
    texts += ["a b c", "A b  c", "a b", "", None, None, " \n ", "one"]
    rows = [(int(i), t, None) for i, t in zip(rng.permutation(len(texts)) * 3, texts)]
    sets = {d: shingles(t) for d, t, _ in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    expected = {(d, len(s), root(d)) for d, s in sets.items()}
    table = documents(spark, [*rows, rows[0], (None, rows[1][1], None)]).repartition(4)
    found = [tuple(r) for r in jaccard_join.near_copies(table).collect()]
    assert set(found) - {(None, len(shingles(rows[1][1])), None)} == expected
    assert len(found) == len(rows) + 2


def test_a_large_group_of_near_copies_equals_brute_force(spark, monkeypatch):
    """Copies of one text, most of them too far apart to link: lists stay in many components."""
    monkeypatch.setattr(jaccard_join, "LIST_PART", 7)
    monkeypatch.setattr(jaccard_join, "AT_ONCE", 500)
    rng = np.random.default_rng(12)
    base, rows = prose(rng, 80, 10**6).split(), []
    for i in range(150):
        copy = list(base)
        for at in rng.choice(80, rng.integers(0, 7), replace=False):
            copy[at] = f"own{i}x{at}"
        rows.append((int(i * 7 % 150), " ".join(copy + ["end"] * (i % 3)), None))
    sets = {d: shingles(t) for d, t, _ in rows}
    least = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sorted(sets), 2):
            if least[a] != least[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    assert 20 < len(set(least.values())) < 120
    found = {r.doc_id: r.component_id for r in jaccard_join.near_copies(documents(spark, rows).repartition(3)).collect()}
    assert found == least


def test_no_documents_to_join(spark):
    assert jaccard_join.near_copies(documents(spark, [])).collect() == []


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100), (7, 200), (300, 301), (301, 300)]
    found = {tuple(r) for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(i, 0) for i in [*range(51), 200]} | {(300, 300), (301, 300)}


# Chat


def test_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, None, None, None), (None, 0, "user", "x")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[2].n_turns, found[None].n_turns) == (3, 2, 1, 1)
    assert found[2].formatted_chars == len("### : </turn>\n")
    empty = spark.createDataFrame([], df.schema)
    assert chat.read_back(chat.format_conversations(empty)).collect() == []


def test_conversation_parts_keep_their_attachments(spark):
    part = ("image", None, "a.png", 14, 14, None, None)
    df = spark.createDataFrame(
        [(1, 0, "user", "x", [part, part]), (1, 1, "user", "plain", None), (1, 2, "user", None, [part])],
        f"conv_id long, turn long, role string, text string, parts array<{chat.PART}>",
    )
    formatted = chat.format_conversations(df)
    assert [[a.n for a in r.attachments] for r in formatted.orderBy("seq").collect()] == [[0, 1], [], [2]]
    (r,) = chat.read_back(formatted).collect()
    assert (r.n_attachments, r.attachment_tokens) == (3, 3)


# Benchmark decontamination


def test_hits_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 6, 14, 40, 59])] + [(6, None), (7, ""), (None, "a b c d e f")]
    items += [(8, " Xq "), (9, "xq\tyq zq  VQ"), (10, "xq yq"), (10, "xq yq zq vq uq tq")]
    rows = [(9, None, None), (10, "", None), (11, "a b", None)]
    for d in range(30):
        parts = [prose(rng, 30)]
        for i in rng.integers(0, 6, 2):
            w = items[i][1].split()
            parts += [" ".join(w[: len(w) - rng.integers(0, 3)]).upper(), prose(rng, 9)]
        rows.append((20 + d, "\n".join(parts), None))
    rows.append((99, " ".join(t for _, t in items if t) * 2, None))
    for d, text in enumerate(["xq", "a xq yq b", "Xq yq zq\nvq", "xq yq zq vq uq tq", "xq xq", "x q", "yq zq vq"]):
        rows.append((60 + d, text, None))
    sets = {}
    for i, item in items:
        sets.setdefault(i, set()).update(shingles(item))
    expected = set()
    for d, t, _ in rows:
        words = (t or "").lower().split()
        held = {tuple(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}
        for i, s in sets.items():
            if i is not None and s and len(s & held) >= 0.75 * len(s):
                expected.add((d, i, len(s), len(s & held)))
    assert {(r[0], r[1]) for r in expected} >= {(60, 8), (62, 9), (63, 9), (63, 10)} and (61, 10) not in expected
    table = documents(spark, [*rows, rows[5], (None, rows[-1][1], None)])
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    assert {tuple(r) for r in decontam.search(table, bench).collect()} == expected
    kept = decontam.decontaminate(table, bench)
    assert kept.columns == table.columns
    hit = {e[0] for e in expected}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in [*rows, rows[5], (None,)] if r[0] not in hit)
    none = bench.where("false")
    assert decontam.search(table, none).collect() == [] and decontam.decontaminate(table, none).count() == len(rows) + 2


# Mixing


def test_mix_of_nulls_ties_and_small_sources(spark):
    rng = np.random.default_rng(3)
    rows = [(i, prose(rng, 40), "abc"[i % 3]) for i in range(300)] + [(i, prose(rng, 10), "tiny") for i in range(300, 303)]
    rows += [(400, None, None), (401, "x y", None), (402, "", "a"), (None, "n n", "b"), rows[0], rows[0]]
    df = documents(spark, rows)
    taken = mixing.taken_words(df, block=16).collect()
    assert len(taken) == len(rows)
    sources = {}
    for r in taken:
        assert 0 <= r.taken <= 3 * r["size"]
        x = sources.setdefault(r.source, [r.target, 0])
        x[1] += r.taken
    assert abs(sum(t for t, _ in sources.values()) - sum(r["size"] for r in taken)) < 1e-6
    for target, got in sources.values():
        assert abs(target - got) <= 3 * 16
    assert [t for t in sources if t is None] == [None]
    again = mixing.taken_words(df.repartition(3), block=16).collect()
    assert Counter(map(tuple, taken)) == Counter(map(tuple, again))
    mixed = mixing.mix_documents(df, block=16)
    assert mixed.columns == df.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert all(abs(words[s] - target) <= 0.1 * target + 100 for s, (target, _) in sources.items())


def _long_tail():
    """A hot source, sources somewhat longer than a block, and sources much shorter."""
    rows = [(i, "w " * 2000, "hot") for i in range(100)]
    rows += [(1000 + i, "w " * 1100, f"long{i:03d}") for i in range(180)]
    return rows + [(2000 + i, "w " * 60, f"short{i % 130:03d}") for i in range(650)]


@pytest.mark.parametrize("which", ["sf0.001", "long tail"])
def test_every_source_gets_its_target_at_the_production_block_size(spark, which):
    df = documents(spark, _long_tail()) if which == "long tail" else spark.read.parquet(f"/root/testdata/{which}/documents.parquet")
    rows = mixing.taken_words(df).collect()
    targets, taken, longest = {r.source: r.target for r in rows}, Counter(), Counter()
    for r in rows:
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    order = mixing.mixed_order(df).collect()
    assert len({(r.slot, r.source) for r in order}) == len({r.slot for r in order}) == max(r.slot for r in order) + 1
    words, by_document = Counter(), Counter()
    for r in order:
        words[r.slot] += r.words
        by_document[r.doc_id] += r.words
    assert max(words.values()) <= 1024
    assert by_document == Counter({r.doc_id: r.taken for r in rows if r.taken})
    whole = Counter()
    for r in mixing.mix_documents(df).collect():
        whole[r.source] += len(r.text.split())
    assert all(abs(whole[s] - t) <= longest[s] / 2 + 1 for s, t in targets.items())


def test_nothing_to_mix(spark):
    assert mixing.taken_words(documents(spark, [])).collect() == []
    assert mixing.mix_documents(documents(spark, [])).collect() == []
    (row,) = mixing.taken_words(documents(spark, [(1, None, "a")])).collect()
    assert (row["size"], row.target, row.taken) == (0, 0.0, 0)


# Quality


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen, held_out = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    rows = quality.classify(docs, seen).join(held_out, "doc_id").collect()
    right = np.mean([r["keep"] == (r["quality"] == 1 and r["toxic"] == 0) for r in rows])
    assert len(rows) > 100 and right > 0.95


def test_classifier_on_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "A plain sentence with words.", "c"), (None, "More words here.", "d"), (3, "A plain sentence with words.", "c")]
    table = documents(spark, rows)
    labels = spark.createDataFrame([(3, 1, None), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(quality.classify(table, labels).collect()) == 5
    kept = quality.keep_good(table)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} <= {3, None}
    assert quality.classify(documents(spark, []), labels.where("false")).collect() == []


def test_rare_insults_are_learned(spark):
    """0.5% of the documents insult; each word of the lexicons is in few of the sample."""
    rng = np.random.default_rng(11)
    lexicons = (quality.INSULTS, quality.CONTEMPT)
    rows = []
    for i in range(6000):
        words = [*rng.choice(quality.COMMON, 12), *(f"word{j}" for j in rng.integers(0, 300, 40))]
        if i % 200 == 7:
            words += [w for lexicon in lexicons for w in rng.choice(lexicon, 2, replace=False)]
        rows.append((i, " ".join(rng.permutation(words)) + ".", "a"))
    keep = {r.doc_id: r["keep"] for r in quality.classify(documents(spark, rows).repartition(4), None, sample=2000).collect()}
    assert np.mean([keep[i] for i in keep if i % 200 == 7]) < 0.1
    assert np.mean([keep[i] for i in keep if i % 200 != 7]) > 0.98


# Token ids


def test_token_ids_with_nulls_and_repeats(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, 30) + ".\n\n x", None) for i in range(40)] + [(7, None, None), (None, "x", None), (50, "", None), (3, "long " * 5000, None)]
    rows += [(60 + i, t, None) for i, t in enumerate(["a <|endoftext|> b", " lead", "trail ", "\nb c\n", "'s it's.", "x. y, z!?"])]
    found = token_blocks.token_ids(documents(spark, rows).repartition(5), path).collect()
    library = Tokenizer.from_file(path)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for doc, text, _ in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert token_blocks.token_ids(documents(spark, []), path).collect() == []


# Web archives


def test_archives_and_index(spark):
    big = "<p>" + "x" * 200
    rows = [(5, "http://b.org/", big), (2, "http://a.org/z", big), (9, None, big), (None, "http://a.org/", big), (3, "http://a.org/", "small"), (4, "http://a.org/", "small"), (6, "http://c.org", None), (2, "http://a.org/z", big)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, offset int").repartition(3)
    index, folder = warc.archive_pages(df)
    order = [(r.url_key, r.timestamp, r.page) for r in index.orderBy("range_no", "position").collect()]
    assert order == sorted(order) and len(order) == len(rows)
    found = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(index, folder).collect())
    n = len(big)
    assert found == Counter(
        [(5, "revisit", 2, n), (2, "response", None, n), (2, "response", None, n), (9, "revisit", 2, n), (None, "revisit", 2, n)]
        + [(3, "response", None, 5), (4, "response", None, 5), (6, "response", None, 0)]
    )
    index, folder = warc.archive_pages(df.where("false"))
    assert warc.read_archives(index, folder).collect() == []


def test_one_url_spreads_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "BATCH_ROWS", 4)
    monkeypatch.setattr(warc, "RUN_ROWS", 16)
    df = spark.createDataFrame([(i, "http://a.org/", "") for i in range(100)], "page_id long, url string, html string")
    folder = warc.work_dir(spark, "warc-test")
    runs, sample = warc.write_archives(df.repartition(3), folder)
    index = warc.merged_index(runs, folder, sample, 5).collect()
    assert len(index) == 100 and len({r.range_no for r in index}) >= 4
    assert [r.page for r in sorted(index, key=lambda r: (r.range_no, r.position))] == sorted(r.page for r in index)


@pytest.mark.parametrize("ranges", [1, 7])
def test_many_runs_merge_in_passes_of_bounded_fan_in(spark, monkeypatch, ranges):
    monkeypatch.setattr(warc, "BATCH_ROWS", 2)
    monkeypatch.setattr(warc, "RUN_ROWS", 5)
    monkeypatch.setattr(warc, "FAN_IN", 3)
    opened, plain = [], warc.merge_units

    def noted(*args):
        units = plain(*args)
        opened.append([len(u.names) for u in units.collect()])
        return units

    monkeypatch.setattr(warc, "merge_units", noted)
    # A third of all captures are of one URL; one row comes twice.
    rows = [(i, "http://hot.org/" if i % 3 == 0 else f"http://h{i * 7 % 50}.org/{i % 4}", "x" * (i % 5)) for i in range(150)]
    df = spark.createDataFrame([*rows, rows[3], (None, None, None)], "page_id long, url string, html string")
    folder = warc.work_dir(spark, "warc-test")
    runs, sample = warc.write_archives(df.repartition(3), folder)
    assert 27 < runs.count() <= 81
    index = warc.stored(warc.merged_index(runs, folder, sample, ranges), "warc-test")
    assert len(opened) == 4 and max(map(max, opened)) <= 3
    order = [(r.url_key, r.timestamp, r.page) for r in index.orderBy("range_no", "position").collect()]
    assert order == sorted(order) and len(order) == 152
    assert sorted(r.page for r in index.collect()) == sorted(["", f"{3:020d}", *(f"{i:020d}" for i in range(150))])
    assert warc.read_archives(index, folder).count() == 152


# Shards


def test_shards_are_even_and_gapless(spark):
    rows = [(i % 90, f"t{i % 7}", None) for i in range(203)] + [(None, None, None), (1, "", None)]
    placed = sharding.shard_documents(documents(spark, rows).repartition(4), 10).collect()
    assert len(placed) == 205
    slots = {}
    for r in placed:
        slots.setdefault(r.shard, []).append(r.slot)
        assert (r.shard, r.slot) == sharding.place(r["row"], 205, 10)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {20, 21}
    assert sorted(r["row"] for r in placed) == list(range(205))
    (null,) = [r for r in placed if r.doc_id is None]
    assert (null["size"], null.text_crc32, null["row"]) == (16, 0, 0)
    again = sharding.shard_documents(documents(spark, rows).repartition(9), 10).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, placed))
    assert sharding.shard_documents(documents(spark, []), 10).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(documents(spark, []), ["doc_id"], 0)


def test_lists_meet_where_they_lie(spark):
    rows = [(t, d, 10 + d % 3, d % 2, 0, False) for t in range(40) for d in range(t % 5 + 1)]
    lists = spark.createDataFrame(rows, "token long, doc long, n int, band int, salt int, split boolean")
    table = jaccard_join._bucketed(lists, "lists", "token", "salt")
    try:
        with_least = jaccard_join._with_least(spark.table(table), "token", "salt", "band")
        stars = jaccard_join._stars(with_least).select("a", "b")
        assert "Exchange" not in stars._jdf.queryExecution().executedPlan().toString()
        found = sorted(tuple(r) for r in stars.collect())
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    assert found == sorted((d % 2, d) for t in range(40) for d in range(t % 5 + 1) if d > 1)


@pytest.mark.parametrize("list_part", [1, 128])
def test_documents_that_are_still_apart_equal_counting(spark, monkeypatch, list_part):
    """Lists whole and in parts, of several components: pairs with enough lists in common, each once."""
    monkeypatch.setattr(jaccard_join, "LIST_PART", list_part)
    rng = np.random.default_rng(11)
    n, component = rng.integers(3, 9, 24), rng.integers(0, 6, 24)
    docs = {t: sorted(set(rng.integers(0, 24, rng.integers(1, 9)).tolist())) for t in range(60)}
    rows = [(t, d, int(n[d]), d % 3 if t % 2 else 0, bool(t % 2), int(component[d])) for t, own in docs.items() for d in own]
    placed = spark.createDataFrame(rows, "token long, doc long, n int, salt int, split boolean, component long")
    found = sorted(tuple(r) for r in jaccard_join._still_apart(placed).collect())
    common = Counter((a, b) for own in docs.values() for a in own for b in own if a < b and component[a] != component[b])
    least = {(a, b): max(int(jaccard_join._least_common(n[a], n[b])), 1) for a, b in common}
    fits = {(a, b) for a, b in common if 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b])}
    assert found == sorted(p for p in fits if common[p] >= least[p])
    assert found
