"""Benchmark items inside documents: containment search by MinHash over size classes.

DataFrame functions only. A document is reduced to those of its five-word shingles that
any item has: no other shingle can count for containment, and a long document becomes as
small as what it shares. The reduced sets are put into size classes. The containment
bound and a class's largest size give the least Jaccard similarity that a hit can have;
bands of MinHash values are chosen for it. Where even single values could miss a hit, the
class is joined shingle by shingle, which misses nothing. Every candidate is verified
by counting the shingles, as words, that it shares with the item. An item of fewer than
five words is one shingle, its whole word sequence, and is looked for in the windows of
that length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import small_if_proven, stored, text_or_empty

WORDS = 5
LEAST = 0.75
#: MinHash values of a set, and the rows of a band that may be chosen.
HASHES = 64
ROWS = (4, 2, 1)
#: Accepted chance that banding misses a hit of just the least similarity.
MISS = 1e-6
#: The last size class: sets of 2^30 shingles and more.
CLASSES = 31
BREAKS = "[\\x20\\x09-\\x0D]+"


def split_words(df: DataFrame, key: str) -> DataFrame:
    """(key, _w, _n): the lower-case words of every text between two empty ones, their number."""
    # One space before and after each text gives every split an empty first and last word.
    text = F.concat(F.lit(" "), F.lower(text_or_empty()), F.lit(" "))
    words = df.select(F.col(key), F.split(text, BREAKS).alias("_w"))
    return words.withColumn("_n", F.size("_w") - 2)


def shingle_rows(words: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(key, shingle): every run of so many words of every text, repeats included.

    Copies of the words, each a word further on, are zipped, so that shingles are built by
    generated code and not by a lambda for each word. Texts that are too short have none.
    """
    longest, shortest = max(lengths), min(lengths)
    names = [f"w{i}" for i in range(longest)]
    # Where a copy is shorter than the first, the zip fills it with nulls.
    shifted = [F.slice("_w", i + 2, F.greatest(F.col("_n") - max(i, shortest - 1), F.lit(0))) for i in range(longest)]
    zipped = words.where(F.col("_n") >= shortest).select(key, F.inline(F.arrays_zip(*shifted)).alias(*names))
    runs = {n: F.concat_ws(" ", *names[:n]) for n in lengths}
    if len(lengths) == 1:
        return zipped.select(key, runs[longest].alias("shingle"))
    whole = [F.when(F.col(names[n - 1]).isNotNull(), run) for n, run in runs.items()]
    return zipped.select(key, F.explode(F.array(*whole)).alias("shingle")).where("shingle is not null")


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, n_words, shingle, n_item): distinct shingles of each item, and how many they are.

    ``n_words`` are those of the shingle: five, or all of a shorter item. An item without
    words has no shingles.
    """
    words = split_words(items, "item_id")
    short = words.where(F.col("_n").between(1, WORDS - 1)).select(
        "item_id", F.col("_n").alias("n_words"), F.array_join(F.slice("_w", 2, F.col("_n")), " ").alias("shingle")
    )
    rows = shingle_rows(words, "item_id", [WORDS]).select("item_id", F.lit(WORDS).alias("n_words"), "shingle")
    distinct = rows.unionByName(short).distinct()
    sizes = distinct.groupBy("item_id").agg(F.count("*").alias("n_item"))
    return distinct.join(sizes, "item_id")


def reduced_documents(documents: DataFrame, shingles: DataFrame) -> DataFrame:
    """(doc_id, shared): the distinct shingles of each document that any item has."""
    known = small_if_proven(shingles.select("shingle").distinct())
    # At most five: windows are built of the lengths that items have, and of no other.
    lengths = sorted(r[0] for r in shingles.select("n_words").distinct().collect()) or [WORDS]
    return (
        shingle_rows(split_words(documents, "doc_id"), "doc_id", lengths)
        .join(known, "shingle")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("shingle")).alias("shared"))
    )


def rows_for(n_item: int, largest: int, least: float = LEAST) -> int:
    """Rows of a band that find an item in sets of up to ``largest`` shingles; 0: none do."""
    hits = math.ceil(least * n_item)
    similarity = min(1.0, hits / (largest + n_item - hits))
    for rows in ROWS:
        if (1 - similarity**rows) ** (HASHES // rows) <= MISS:
            return rows
    return 0


def size_class(size: Column) -> Column:
    return F.least(F.floor(F.log2(size.cast("double"))), F.lit(CLASSES - 1)).cast("int")


def bands(df: DataFrame, key: str, shared: str, rows: list[int], extra: list[str]) -> DataFrame:
    """(key, extra, rows, band, value) of the MinHash signature for each number of rows."""
    signature = F.transform(
        F.array(*[F.lit(i) for i in range(HASHES)]),
        lambda i: F.array_min(F.transform(shared, lambda s: F.xxhash64(s, i))),
    )
    signed = df.select(key, *extra, signature.alias("_s"))
    parts = []
    for r in rows:
        band = F.transform(
            F.sequence(F.lit(0), F.lit(HASHES // r - 1)), lambda b: F.slice("_s", b * r + 1, r)
        )
        parts.append(
            signed.select(key, *extra, F.lit(r).alias("rows"), F.posexplode(band).alias("band", "value"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("value", F.xxhash64("value"))


def search(documents: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): items of which a document holds the least share.

    A null text is empty, and an item without words is never part of a hit. An item of one
    to four words hits every document that holds these words in a row; one word may well be
    in very many, so leave such items out of ``items`` where they are no evidence. Items
    and documents may repeat: rows of one id are one set. Rows whose id is null are left
    out. Empty tables give no hits.
    """
    items = items.where("item_id is not null")
    documents = documents.where("doc_id is not null")
    shingles = stored(item_shingles(items), "items")
    reduced = stored(
        reduced_documents(documents, shingles).withColumn("_class", size_class(F.size("shared"))),
        "reduced",
    )
    sets = shingles.groupBy("item_id", "n_item").agg(
        F.sort_array(F.collect_set("shingle")).alias("item")
    )
    # Which rows a band has depends on two numbers: item size and class. Sizes are few.
    sizes = [r[0] for r in shingles.select("n_item").distinct().collect()]
    classes = [r[0] for r in reduced.select("_class").distinct().collect()]
    chosen = [(n, c, rows_for(n, (2 << c) - 1, least)) for n in sizes for c in classes]
    spark = documents.sparkSession
    plan = spark.createDataFrame(chosen, "n_item long, _class int, rows int").coalesce(1)
    used = sorted({r for _, _, r in chosen if r}) or [1]
    wanted = sets.join(F.broadcast(plan), "n_item")
    item_bands = bands(sets, "item_id", "item", used, ["n_item"]).join(
        F.broadcast(plan), ["n_item", "rows"]
    )
    document_bands = bands(reduced, "doc_id", "shared", used, ["_class"])
    banded = document_bands.join(
        small_if_proven(stored(item_bands.drop("n_item"), "bands")),
        ["_class", "rows", "band", "value"],
    ).select("doc_id", "item_id")
    exact_items = wanted.where("rows = 0").select("item_id", "_class", F.explode("item").alias("_x"))
    exact = (
        reduced.select("doc_id", "_class", F.explode("shared").alias("_x"))
        .join(small_if_proven(stored(exact_items, "exact")), ["_class", "_x"])
        .select("doc_id", "item_id")
    )
    candidates = banded.union(exact).distinct()
    shared = F.size(F.array_intersect("shared", "item"))
    return (
        candidates.join(small_if_proven(stored(sets, "sets")), "item_id")
        .join(reduced.select("doc_id", "shared"), "doc_id")
        .select("doc_id", "item_id", "n_item", shared.cast("long").alias("n_shared"))
        .where(F.col("n_shared") >= least * F.col("n_item"))
    )


def decontaminate(documents: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents that hold no benchmark item; a null doc_id stays. Columns stay as they are."""
    hit = search(documents, items, least).select(F.col("doc_id").alias("_hit")).distinct()
    # Written first: with a known size, few ids are broadcast and no text moves.
    hit = stored(hit, "hit")
    return documents.join(hit, F.col("doc_id") == F.col("_hit"), "left_anti")
