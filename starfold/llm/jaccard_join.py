"""Exact Jaccard self-join of documents by word shingles: components of near copies.

Documents of equal shingle sets become one. For the others, a T-occurrence search: two
sets link only if they share T shingles, so leaving out the T - 1 most frequent ones of
each still leaves one in common. These short inverted lists, of the shingles that are rare
over all documents, give the candidates; how rare is read from counts of all shingles in
a fixed number of buckets, which only orders shingles and so cannot lose a link.

A pair must share T less the left-out lists of these short lists; most that have a
passage in common do not. Lists never become all their pairs. Each list first links its
documents to its least one; what these links, once verified, do not bring into one
component meets in a second round as one document of each component. Documents that are
outside the largest component of a list even then are searched one by one: DivideSkip
merges their short lists and probes the long ones for what enough of them have.
Candidates of a document are verified in cells of bounded size by DivideSkip over the
whole sets, merged on a heap.
"""

from __future__ import annotations

import heapq
import math
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import released, stored, work_dir
from starfold.llm.components import connected
from starfold.llm.words import WordReader, Words, mixed, slices
from starfold.session import ship_by_value

ship_by_value(__name__)

WORDS = 5
TOGETHER = 4 << 20
#: Buckets that shingles are counted in, and parts that the counts move in.
BUCKET_BITS, PARTS = 22, 256
#: Documents of a list that meet in one group, about; candidates of a cell.
LIST, CELL = 20_000, 64
#: Documents of a part of a list, and ids that a search holds before it adds them up.
LIST_PART, AT_ONCE = 128, 1 << 22
#: The weight of probing against merging in the choice of long lists.
MU = 0.0085


def enough(n: int) -> int:
    """Shingles that a set of n must share with any set it links to."""
    return (3 * n + 3) // 4


def linked(shared: int, a: int, b: int) -> bool:
    return 100 * shared >= 75 * (a + b - shared)


def sizes_fit(a: str, b: str) -> Column:
    """Whether sets of these sizes can link at all."""
    low, high = F.least(a, b), F.greatest(a, b)
    return 100 * low >= 75 * high


def shingle_sets(words: Words) -> Iterator[np.ndarray]:
    """Distinct shingle numbers of each row, ascending; a shorter text is one shingle."""
    place, number = words.windows(WORDS)
    ends = np.searchsorted(place, words.first)
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        if b > a:
            yield np.unique(number[a:b])
        else:
            n = words.first[row + 1] - words.first[row]
            yield words.windows_at(words.first[row : row + 1], int(n)) + np.uint64(n) if n else number[:0]


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids that are in at least ``least`` of the ascending lists, with how many have them."""
    lists = sorted((x for x in lists if x), key=len, reverse=True)
    if len(lists) < least:
        return {}
    n_long = min(least - 1, int(least / (MU * math.log2(len(lists[0])) + 1))) if len(lists[0]) > 1 else 0
    long, short = lists[:n_long], lists[n_long:]
    need, found = least - n_long, {}
    heap = [(x[0], i) for i, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)

    def push(i: int, place: int) -> None:
        at[i] = place
        if place < len(short[i]):
            heapq.heappush(heap, (short[i][place], i))

    while len(heap) >= need:
        value, popped = heap[0][0], []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            probes = ((x, bisect_left(x, value)) for x in long)
            count = len(popped) + sum(p < len(x) and x[p] == value for x, p in probes)
            if count >= least:
                found[value] = count
            for i in popped:
                push(i, at[i] + 1)
        else:  # too few lists have it: skip to what enough lists can have
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            for i in popped:
                push(i, bisect_left(short[i], heap[0][0], at[i]))
    return found


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, h1, h2) of each row, then (part, counts) of this task's shingles."""
    reader, counts = WordReader(lower=True), np.zeros(1 << BUCKET_BITS, np.uint32)
    names = ["doc_id", "n", "h1", "h2", "part", "counts"]
    for batch in batches:
        for part in slices(batch, 1, TOGETHER):
            n, h1, h2 = [], [], []
            for s in shingle_sets(reader.read(part.column(1))):
                np.add.at(counts, s >> np.uint64(64 - BUCKET_BITS), 1)
                n.append(len(s))
                h1.append(int(mixed(s).sum().astype(np.int64)))
                h2.append(int(mixed(s ^ np.uint64(0x5DEECE66D)).sum().astype(np.int64)))
            none = pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())
            columns = [part.column(0), *(pa.array(x, pa.int64()) for x in (n, h1, h2)), *none]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    packed = [zlib.compress(c.tobytes(), 1) for c in np.split(counts, PARTS)]
    none = [pa.nulls(PARTS, pa.int64())] * 4
    yield pa.RecordBatch.from_arrays(
        [*none, pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(packed, pa.binary())], names=names
    )


def _frequency(counts: DataFrame) -> np.ndarray:
    """A class for each bucket: 1 + log2 of its count above the mean, 0 for usual buckets.

    Parts are summed as they stream in; 2^BUCKET_BITS bytes come to the driver, whatever
    the number of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.uint64)
                sums[part] = sums[part] + own if part in sums else own
        for part, total in sums.items():
            yield pa.RecordBatch.from_pydict({"part": [part], "counts": [zlib.compress(total.tobytes(), 1)]})

    rows = counts.repartition("part").mapInArrow(released(run), "part long, counts binary").collect()
    total = np.zeros((PARTS, (1 << BUCKET_BITS) // PARTS), np.uint64)
    for row in rows:
        total[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
    total = total.ravel().astype(np.float64)
    mean = max(total.mean(), 1.0)
    # Usual buckets differ by chance, about as the root of their mean; more is one shingle's.
    excess = total - mean
    frequent = excess > 6 * math.sqrt(mean) + 4
    return np.where(frequent, np.log2(np.maximum(excess, 1)) + 1, 0).astype(np.uint8)


def _short_lists(frequency):
    """Task function: (token, doc, n, band, salt, split) for the rarest shingles of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, level = WordReader(lower=True), frequency.value
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                seen: dict[bytes, int] = {}
                docs = part.column(0).to_pylist()
                sets = list(shingle_sets(reader.read(part.column(1))))
                for doc, s in zip(docs, sets):  # of equal sets, the least document speaks
                    key = s.tobytes()
                    seen[key] = min(doc, seen.get(key, doc))
                tokens, rows, n_rows, salts, split = [], [], [], [], []
                for doc, s in zip(docs, sets):
                    if not len(s) or seen.get(s.tobytes()) != doc:
                        continue
                    del seen[s.tobytes()]
                    own, kept = level[s >> np.uint64(64 - BUCKET_BITS)], len(s) - enough(len(s)) + 1
                    order = np.argsort(own, kind="stable")[:kept] if own.any() else slice(kept)
                    own = own[order].astype(np.float64)
                    spread = np.maximum(np.exp2(own) / LIST, 1).astype(np.uint64)
                    tokens.append(s[order])
                    split.append(spread > 1)
                    salts.append(mixed(np.uint64([doc & (2**63 - 1)])) % spread)
                    rows.append(doc)
                    n_rows.append(len(s))
                if not rows:
                    continue
                each = [len(t) for t in tokens]
                size = np.array(n_rows)
                band = np.floor(np.log(size) / math.log(4 / 3)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).astype(np.int64)),
                        pa.array(np.repeat(np.array(rows, np.int64), each)),
                        pa.array(np.repeat(size.astype(np.int32), each)),
                        pa.array(np.repeat(band, each)),
                        pa.array(np.concatenate(salts).astype(np.int32)),
                        pa.array(np.concatenate(split)),
                    ],
                    names=["token", "doc", "n", "band", "salt", "split"],
                )

    return run


def _bucketed(df: DataFrame, label: str, *keys: str) -> str:
    """Store a table that lies by keys, so that steps by them need no shuffle; its name."""
    spark = df.sparkSession
    name, buckets = f"{label}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", work_dir(spark, label)).saveAsTable(name)
    return name


class Verifier:
    """Texts of the documents that are in any list of several, ready to be joined by id.

    They are bucketed by id, so that a round of candidates moves only the texts it needs.
    """

    def __init__(self, texts: DataFrame):
        self.spark = texts.sparkSession
        self.table = _bucketed(texts, "texts", "doc")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct pairs (a, b) whose sets link; a may have any number of b."""
        degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL).alias("_cells"))
        dealt = stored(
            pairs.join(degree, "a").select(
                "a", "b", F.pmod(F.xxhash64("b"), F.col("_cells")).alias("cell")
            ),
            "pairs",
        )
        needs = dealt.select("a", "cell", F.lit(1).alias("side"), F.col("b").alias("doc")).union(
            dealt.select("a", "cell", F.lit(0).alias("side"), F.col("a").alias("doc")).distinct()
        )
        cells = (
            needs.join(self.spark.table(self.table), "doc")
            .repartition("a", "cell")
            .sortWithinPartitions("a", "cell", "side")
            .select("a", "cell", "side", "doc", "text")
        )
        return stored(cells.mapInArrow(released(_verified), "a long, b long"), "links")


    def close(self) -> None:
        """Forget the table's name; links that were found are files of their own."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = WordReader(lower=True)
    cell, query, docs, sets = None, None, [], []

    def found() -> list[tuple[int, int]]:
        if query is None or not docs:
            return []
        least = min(-(-3 * (len(query) + len(s)) // 7) for s in sets)
        place = [np.searchsorted(query, s) for s in sets]
        hit = [p[(p < len(query)) & (query[np.minimum(p, len(query) - 1)] == s)] for p, s in zip(place, sets)]
        token = np.concatenate(hit)
        who = np.repeat(np.arange(len(sets)), [len(h) for h in hit])
        order = np.argsort(token, kind="stable")
        bounds = np.flatnonzero(np.diff(token[order])) + 1
        lists = [x.tolist() for x in np.split(who[order], bounds)] if len(token) else []
        counts = divide_skip(lists, max(least, 1))
        return [(cell[0], docs[i]) for i, c in counts.items() if linked(c, len(query), len(sets[i]))]

    for batch in batches:
        for part in slices(batch, 4, TOGETHER):
            out = []
            keys = zip(*(c.to_pylist() for c in part.columns[:4]))
            for (a, number, side, doc), s in zip(keys, shingle_sets(reader.read(part.column(4)))):
                if (a, number) != cell:
                    out += found()
                    cell, query, docs, sets = (a, number), None, [], []
                if side == 0:
                    query = s
                else:
                    docs.append(doc)
                    sets.append(s)
            yield _pairs(out)
    yield _pairs(found())


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidates(met: DataFrame) -> DataFrame:
    """(a, b) of the pairs (a, an, b, bn), one row for each common short list, that can link.

    Of the set whose short lists end first, enough - 1 shingles are in none; so as many at
    most can be common without being counted here, and the count must reach T less these.
    """
    shared = met.groupBy("a", "b").agg(F.count("*").alias("_c"), F.max("an").alias("an"), F.max("bn").alias("bn"))
    long = F.expr("(3 * greatest(an, bn) + 3) div 4 - 1")
    needed = F.expr("(3 * (an + bn) + 6) div 7")
    return shared.where(F.col("_c") >= needed - long).select("a", "b")


def _with_least(lists: DataFrame, *keys: str) -> DataFrame:
    """Adds ``_f``: the least document of each group. Groups lie in one (token, salt), so they are bounded."""
    return lists.withColumn("_f", F.min(F.struct("doc", "n")).over(Window.partitionBy(*keys)))


def _stars(with_least: DataFrame) -> DataFrame:
    """(a, an, b, bn): each group's documents with its least one, where sizes allow a link."""
    pairs = with_least.where(F.col("doc") > F.col("_f.doc"))
    return pairs.where(sizes_fit("n", "_f.n")).select(
        F.col("_f.doc").alias("a"), F.col("_f.n").alias("an"), F.col("doc").alias("b"), F.col("n").alias("bn")
    )


def _far_stars(lists: DataFrame) -> DataFrame:
    """The same for whole lists of any length."""
    first = lists.groupBy("token").agg(F.min(F.struct("doc", "n")).alias("_f"), F.max("doc").alias("_m"))
    return _stars(lists.join(first.where("_f.doc < _m").drop("_m"), "token"))


def merged_counts(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids that are in at least ``least`` ascending lists, and in how many: DivideSkip on arrays.

    Short lists are merged; what enough of them have is searched for in the long ones.
    """
    lists = sorted(lists, key=len, reverse=True)
    longest = len(lists[0]) if lists else 0
    n_long = min(least - 1, int(least / (MU * math.log2(longest) + 1))) if longest > 1 else 0
    short = lists[n_long:]
    ids, counts = np.unique(np.concatenate(short) if short else np.empty(0, np.int64), return_counts=True)
    kept = counts >= least - n_long
    ids, counts = ids[kept], counts[kept]
    for x in lists[:n_long]:
        at = np.searchsorted(x, ids)
        counts = counts + (x[np.minimum(at, len(x) - 1)] == ids)
    kept = counts >= least
    return ids[kept], counts[kept]


def _least_common(an, bn):
    """Short lists that two sets of these sizes must have in common to link (see _candidates)."""
    return (3 * (an + bn) + 6) // 7 - ((3 * np.maximum(an, bn) + 3) // 4 - 1)


class _Query:
    """Short lists of one document, with what they hold."""

    def __init__(self, x: int, n: int):
        self.x, self.n = x, n
        self.lists: dict[int, list[np.ndarray]] = {}
        self.size = 0
        self.known = np.empty((0, 3), np.int64)  # id, n, count of lists that were folded away

    def add(self, token: int, docs: np.ndarray) -> None:
        """``docs``: (id, n) of those in a part of a list that may link."""
        self.lists.setdefault(token, []).append(docs)
        self.size += len(docs)
        if self.size > AT_ONCE:
            self.known, self.lists, self.size = self._counted(1), {}, 0

    def _counted(self, least: int) -> np.ndarray:
        """(id, n, count) over all lists so far."""
        if not self.lists:
            return self.known
        parts = [np.concatenate(p) for p in self.lists.values()]
        ids, counts = merged_counts([np.sort(p[:, 0]) for p in parts], 1 if len(self.known) else least)
        every = np.concatenate(parts)
        order = np.argsort(every[:, 0], kind="stable")
        n = every[order, 1][np.searchsorted(every[order, 0], ids)]
        found = np.concatenate([self.known, np.stack([ids, n, counts], 1)])
        ids, first, place = np.unique(found[:, 0], return_index=True, return_inverse=True)
        return np.stack([ids, found[first, 1], np.bincount(place, found[:, 2], len(ids)).astype(np.int64)], 1)

    def candidates(self) -> list[tuple[int, int]]:
        sizes = np.concatenate([d[:, 1] for p in self.lists.values() for d in p]) if self.lists else np.empty(0, np.int64)
        least = max(int(_least_common(self.n, sizes).min(initial=1 << 40)), 1) if len(sizes) else 1
        found = self._counted(least)
        found = found[found[:, 2] >= _least_common(self.n, found[:, 1])]
        return [(min(self.x, y), max(self.x, y)) for y in found[:, 0].tolist()]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, xn, token, docs) in the order of x to candidate pairs."""
    query: _Query | None = None
    for batch in batches:
        out = []
        docs = batch.column(3)
        flat = docs.flatten()
        table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in flat.flatten()], 1)
        ends = np.cumsum(docs.value_lengths().to_numpy())
        for i, (x, n, token) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
            if query is None or query.x != x:
                out += query.candidates() if query else []
                query = _Query(x, n)
            query.add(token, table[ends[i - 1] if i else 0 : ends[i]])
        yield _pairs(out)
    yield _pairs(query.candidates() if query else [])


def _still_apart(placed: DataFrame) -> DataFrame:
    """(a, b) of all pairs in different components whose common short lists allow a link.

    Documents outside the largest component of a list are searched, each with all its
    lists that hold several components. Of two documents of different components that
    meet in a list, one is outside its largest; so it is searched and meets the other in
    all their common lists. Lists go to the searches in parts of LIST_PART documents, not
    as pairs.
    """
    of_component, of_list = (Window.partitionBy("token", "salt", *more) for more in (["component"], []))
    whole = placed.where("not split").withColumn("_n", F.count("*").over(of_component))
    whole = whole.withColumn("_largest", F.max(F.struct("_n", "component")).over(of_list)["component"])
    whole = whole.withColumn("_k", F.min("component").over(of_list) < F.max("component").over(of_list))
    whole = whole.withColumn("_size", F.count("*").over(of_list)).where("_k")
    # Lists that lie in several parts are described from all of them.
    split = placed.where("split")
    sizes = split.groupBy("token", "component").agg(F.count("*").alias("_n"))
    described = sizes.groupBy("token").agg(
        F.max_by("component", F.struct("_n", "component")).alias("_largest"), F.count("*").alias("_k"), F.sum("_n").alias("_size")
    )
    split = split.join(described.where("_k > 1").drop("_k"), "token")
    kept = ["token", "doc", "n", "component", "_largest", "_size"]
    mixed_lists = stored(whole.select(kept).union(split.select(kept)), "mixed-lists")

    queries = mixed_lists.where("component <> _largest").select(F.col("doc").alias("x")).distinct()
    marked = mixed_lists.join(queries, F.col("doc") == F.col("x"), "left")
    marked = stored(marked.select("token", "doc", "n", "component", "_size", F.col("x").isNotNull().alias("searched")), "marked-lists")
    entries = marked.where("searched").select("token", F.col("doc").alias("x"), F.col("n").alias("xn"), F.col("component").alias("xc"))
    part = F.pmod(F.xxhash64("doc"), F.ceil(F.col("_size") / LIST_PART)).alias("_part")
    parts = marked.groupBy("token", part).agg(F.collect_list(F.struct("doc", "n", "component", "searched")).alias("docs"))
    # Only what may link is moved; of two that are both searched, the greater looks for the less.
    fitting = F.expr(
        "filter(docs, d -> d.component <> xc and (not d.searched or d.doc < x)"
        " and 100 * least(d.n, xn) >= 75 * greatest(d.n, xn))"
    )
    met = entries.join(parts, "token").select("x", "xn", "token", F.transform(fitting, lambda d: F.struct(d["doc"], d["n"])).alias("docs"))
    dealt = met.where(F.size("docs") > 0).repartition("x").sortWithinPartitions("x")
    return dealt.mapInArrow(released(_searched), "a long, b long").distinct()


def near_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: see the module.

    A null text, or one without words, has no shingles and links to nothing, not even its
    like; so has a row without doc_id, whose component is null. Rows that repeat a doc_id
    with another text are one document with one of these texts. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n long, h1 long, h2 long, part int, counts binary"
    scanned = stored(rows.mapInArrow(released(_set_rows), schema), "sets")
    sets = scanned.where("part is null").drop("part", "counts")
    level = _frequency(scanned.where("part is not null").select("part", "counts"))

    named = sets.where("doc_id is not null and n > 0")
    of_set = ["n", "h1", "h2"]
    classes = named.groupBy(*of_set).agg(F.min("doc_id").alias("rep"))
    reps = classes.select(F.col("rep").alias("doc"))
    # Copies are fewer than representatives; where they are few, the lists need not move to lose them.
    copies = stored(named.select(F.col("doc_id").alias("doc")).distinct().join(reps, "doc", "left_anti"), "copies")

    # A fixed four megabytes.
    frequency = spark.sparkContext.broadcast(level)
    tokens = rows.where("doc_id is not null").mapInArrow(
        released(_short_lists(frequency)), "token long, doc long, n int, band int, salt int, split boolean"
    )
    by_list = Window.partitionBy("token", "salt")
    several = (F.min("doc").over(by_list) < F.max("doc").over(by_list)) | F.col("split")
    shared = tokens.withColumn("_s", several).where("_s").drop("_s")
    table = _bucketed(shared.join(copies, "doc", "left_anti"), "lists", "token", "salt")
    lists = spark.table(table)

    active = lists.select(F.col("doc").alias("doc_id")).distinct()
    texts = rows.join(active, "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text")
    verifier = Verifier(texts.dropDuplicates(["doc"]))

    # First round: the least document of each size band of each list or part, then of the part, then of the list.
    of_band = _with_least(lists, "token", "salt", "band")
    of_part = _with_least(of_band.where("doc = _f.doc"), "token", "salt")
    of_list = lists.where("split").groupBy("token", "salt").agg(F.min(F.struct("doc", "n")).alias("_f")).select("token", "_f.*")
    tried = stored(_candidates(_stars(of_band).union(_stars(of_part)).union(_far_stars(of_list))), "tried")
    links = verifier.links(tried)
    of_doc = connected(links)

    # Second round: the least document of each component that a list holds.
    placed = _placed(lists, of_doc)
    by_component = lambda rows, *keys: rows.groupBy(*keys, "component").agg(F.min(F.struct("doc", "n")).alias("_h")).select(*keys, "_h.*")
    heads = _with_least(by_component(placed, "token", "salt"), "token", "salt")
    met = _stars(heads).union(_far_stars(by_component(placed.where("split"), "token")))
    again = stored(_candidates(met).join(tried, ["a", "b"], "left_anti"), "again")
    links = links.union(verifier.links(again))
    of_doc = connected(links)

    # Last round: a T-occurrence search for each document that is still apart in a list.
    rest = _still_apart(_placed(lists, of_doc))
    rest = rest.join(tried, ["a", "b"], "left_anti").join(again, ["a", "b"], "left_anti")
    links = links.union(verifier.links(stored(rest, "rest")))
    verifier.close()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    of_doc = connected(links)

    of_class = classes.join(of_doc, F.col("rep") == F.col("id"), "left").select(
        *of_set, F.coalesce("component", "rep").alias("_component")
    )
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return sets.join(of_class, of_set, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(alone, F.col("_component"))).alias("component_id"),
    )


def _placed(lists: DataFrame, of_doc: DataFrame) -> DataFrame:
    """Lists with each document's component so far; one without links is its own."""
    joined = lists.join(of_doc.withColumnRenamed("id", "doc"), "doc", "left")
    return joined.withColumn("component", F.coalesce("component", "doc"))


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents without those that link to one of smaller doc_id, directly or not.

    The rows of the least doc_id stay of each component; so does every row that repeats it,
    and every row without doc_id. Columns stay as they are.
    """
    found = near_copies(documents)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    # Written first: with a known size, few ids are broadcast and no text moves.
    gone = stored(gone, "gone")
    return documents.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
