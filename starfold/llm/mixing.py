"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

The documents of a source lie in a shuffled order end to end, cut into blocks of its own:
as few as hold at most ``block`` words each, all of one size but for a word. A source has
as many slots as its target takes blocks, and the last one takes the part of a block that
is left, so every source gets its target to the word. Slot i maps to the point
i * g mod slots, with g near slots / golden ratio and prime to slots; the point to the
source in whose run of points it lies. Any run of slots so has nearly the right shares,
and all of them exactly. The slots of a source are ranked; rank r takes block r mod
blocks. When the ranks are more than the blocks, the blocks come again.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import n_words, running_before, small_if_proven, stored, text_or_empty

#: No document is taken more often.
MOST = 3
#: The step between points is to the number of slots as STEP is to POINTS, about 1 / phi.
POINTS = 1 << 31
STEP = 1327217885
#: The range of points is cut into so many strips to join points with shares by equality.
STRIPS = 1024
#: Slots that are ranked together.
CHUNK = 1 << 14


def shuffle_key(seed: int = 0) -> Column:
    """A number below 2^62 for each document, evenly spread and the same in every run.

    It comes from doc_id, or from the text where there is none.
    """
    none = F.concat(F.lit("text:"), text_or_empty())
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), none))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") * 4


def target_sizes(sizes: DataFrame) -> DataFrame:
    """One row for each source: source_size, weight, target.

    Sources weigh 1, 2, 3, 1, ... in the order of their names by code point, null last.
    A target stops at MOST times its source's size; the excess goes to the others by
    weight. With sources in the order of cap over weight, the capped ones come first,
    so one running sum finds the common level of all others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
        .withColumn("_cap", F.col("source_size").cast("double") * MOST)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
    )
    order = [F.col("_ratio"), F.col("source").asc_nulls_last()]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything).cast("double") - F.coalesce(
        F.sum("_cap").over(earlier), F.lit(0.0)
    )
    weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0.0)
    )
    level = sources.withColumn("_level", left / weight)
    free = F.when(F.col("_ratio") >= F.col("_level"), F.col("_level"))
    level = level.withColumn("_free", F.first(free, ignorenulls=True).over(everything))
    capped = F.col("_free").isNull() | (F.col("_ratio") < F.col("_free"))
    return level.select(
        "source",
        "source_size",
        "weight",
        F.when(capped, F.col("_cap")).otherwise(F.col("weight") * F.col("_free")).alias("target"),
    )


def _source_key() -> Column:
    """Sources as a key that is never null: null and every name apart."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def _ranked(dealt: DataFrame) -> DataFrame:
    """(slot, source key, rank) of dealt slots."""
    counts = dealt.groupBy("_source", "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_source").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "_source", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("_source", "_chunk").orderBy("slot")
    return dealt.join(bases, ["_source", "_chunk"]).select(
        "slot", "_source", (F.col("_base") + F.row_number().over(inside) - 1).alias("rank")
    )


def _content_key() -> Column:
    """A number of everything in a row that the mix looks at; with doc_id, it names like rows."""
    parts = [F.col(c) for c in ("doc_id", "source", "text")]
    return F.xxhash64(*[x for p in parts for x in (p.isNull(), p.cast("string"))])


def placed_documents(documents: DataFrame, seed: int = 0) -> DataFrame:
    """Every row's size, its source's size and target, and the words before it.

    The words before a row are those of its source's earlier documents in the shuffled
    order. A null text has no words; a null source is a source like any other. Repeated
    rows keep their own places, next to each other. Written once, so that ``_row`` stays.
    """
    sized = stored(
        documents.select(
            "doc_id",
            "source",
            _content_key().alias("_content"),
            n_words(text_or_empty()).alias("size"),
            shuffle_key(seed).alias("_key"),
            _source_key().alias("_source"),
        ),
        "mix-sizes",
    )
    targets = stored(
        target_sizes(sized).withColumn("_source", _source_key()).drop("source"), "mix-targets"
    )
    before = running_before(sized, "_source", ["_key", "doc_id", "size"], "size")
    rows = before.join(small_if_proven(targets), "_source").withColumn("_row", F.monotonically_increasing_id())
    return stored(rows, "mix-places")


def with_turns(placed: DataFrame) -> DataFrame:
    """Add _full and _rest: a source is taken _full times, and its first _rest words once more.

    The blocks of a source come in turn, so this holds for any size of blocks.
    """
    words = F.round("target").cast("long")
    size = F.greatest("source_size", F.lit(1))
    return placed.withColumn("_words", words).withColumn("_size", size).withColumns(
        {"_full": F.expr("_words div _size"), "_rest": F.expr("_words % _size")}
    ).drop("_words", "_size")


def _own_blocks(block: int) -> Column:
    """Blocks of a source; block j ends before word (j + 1) * source_size div blocks."""
    return F.expr(f"greatest((source_size + {block - 1}) div {block}, 1)")


def _block_of(word: str) -> Column:
    """The block that holds a word of a source of words; products may pass 64 bits."""
    return F.expr(f"((cast({word} as decimal(20,0)) + 1) * _blocks - 1) div source_size")


def _first_word(block: str) -> Column:
    return F.expr(f"cast({block} as decimal(20,0)) * source_size div _blocks")


def even_schedule(placed: DataFrame, block: int) -> DataFrame:
    """(_source, _block, turn, slot): each source's own blocks, as often as its target takes them."""
    spark = placed.sparkSession
    by_name = Window.orderBy("_source").rowsBetween(Window.unboundedPreceding, -1)
    sources = placed.groupBy("_source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    part = F.when(F.col("_rest") > 0, _block_of("_rest - 1") + 1).otherwise(0)
    sources = (
        with_turns(sources.where("source_size > 0"))
        .withColumn("_blocks", _own_blocks(block))
        .withColumn("_slots", F.col("_full") * F.col("_blocks") + part)
        .where("_slots > 0")
        .withColumn("_from", F.coalesce(F.sum("_slots").over(by_name), F.lit(0)))
    )
    sources = stored(sources.select("_source", "_blocks", "_slots", "_from"), "mix-slots")
    slots = sources.agg(F.sum("_slots")).first()[0] or 0
    step = max(1, round(slots * STEP / POINTS))
    while gcd(step, max(slots, 1)) > 1:
        step += 1
    strip = max(1, -(-slots // STRIPS))
    strips = F.sequence(F.expr(f"_from div {strip}"), F.expr(f"(_from + _slots - 1) div {strip}"))
    shares = sources.withColumn("_strip", F.explode(strips))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.expr(f"cast(cast(id as decimal(20,0)) * {step} % {max(slots, 1)} as long)").alias("_point")
    )
    dealt = (
        points.withColumn("_strip", F.expr(f"_point div {strip}"))
        .join(shares, "_strip")
        .where("_point >= _from and _point < _from + _slots")
        .select("slot", "_source", F.expr(f"slot div {CHUNK}").alias("_chunk"))
    )
    ranked = _ranked(dealt).join(small_if_proven(sources.select("_source", "_blocks")), "_source")
    return ranked.select(
        "_source", F.expr("rank % _blocks").alias("_block"), F.expr("rank div _blocks").alias("turn"), "slot"
    )


def _pieces_in_order(placed: DataFrame, block: int) -> DataFrame:
    """Pieces of documents joined with the slots that take their blocks."""
    cut = (
        placed.where("size > 0")
        .withColumn("_blocks", _own_blocks(block))
        .withColumn("_block", F.explode(F.sequence(_block_of("size_before"), _block_of("size_before + size - 1"))))
    )
    start = F.greatest("size_before", _first_word("_block"))
    end = F.least(F.col("size_before") + F.col("size"), _first_word("_block + 1"))
    # The last turn ends where the target is reached.
    last = F.when(F.col("turn") == F.col("_full"), F.least(end, "_rest")).otherwise(end)
    return (
        cut.join(even_schedule(placed, block), ["_source", "_block"])
        .withColumn("from_word", start - F.col("size_before"))
        .withColumn("words", last - start)
        .where("words > 0")
        .select("slot", "turn", "_row", "doc_id", "source", "from_word", "words")
    )


def mixed_order(documents: DataFrame, block: int = 1024, seed: int = 0) -> DataFrame:
    """The mix itself: (slot, turn, doc_id, source, from_word, words), slot by slot."""
    return _pieces_in_order(with_turns(placed_documents(documents, seed)), block).drop("_row")


def _with_taken(documents: DataFrame, block: int, seed: int) -> DataFrame:
    """Placed rows with the words that the slots take of each."""
    placed = with_turns(placed_documents(documents, seed))
    sums = _pieces_in_order(placed, block).groupBy("_row").agg(F.sum("words").alias("_taken"))
    return placed.join(sums, "_row", "left").withColumn("taken", F.coalesce("_taken", F.lit(0)))


def taken_words(documents: DataFrame, block: int = 1024, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of documents.

    ``taken`` counts the words that the slots of the schedule take of it, repeats
    included; a row without words has none. A source's rows together have its target,
    rounded to a word, whatever ``block`` is. An empty table gives an empty result.
    """
    return _with_taken(documents, block, seed).select("doc_id", "source", "size", "source_size", "target", "taken")


def mix_documents(documents: DataFrame, block: int = 1024, seed: int = 0) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, rounded to whole documents.

    Only the document across the end of a source's target is rounded, so a source misses
    its target by half of that document at most. Columns are those of ``documents``. Rows
    alike in doc_id, source and text are repeated equally often; so are rows without
    doc_id. A document without words is not in the mix.
    """
    copies = (
        _with_taken(documents, block, seed)
        .where("size > 0")
        .withColumn("_turns", F.expr("(2 * taken + size) div (2 * size)"))
        .groupBy(F.coalesce("doc_id", F.lit(0)).alias("_mixed_id"), "_content")
        .agg(F.round(F.avg("_turns")).cast("int").alias("_n"))
        .where("_n > 0")
    )
    keyed = documents.withColumn("_own", _content_key())
    same = (F.coalesce("doc_id", F.lit(0)) == F.col("_mixed_id")) & (F.col("_own") == F.col("_content"))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    joined = keyed.join(copies, same)
    return joined.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*columns)
