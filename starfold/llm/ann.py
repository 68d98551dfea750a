"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

The tree is fitted on a bounded sample and broadcast; every vector goes down it to a leaf.
A query walks the tree best bin first: a priority queue holds branches by the inner
product with their centroid. How many leaves a query visits is widened until the recall
of calibration queries, measured against brute force over all vectors, reaches a target.

Equal vectors are one: a vector carries the smallest ids that have it, as many as a
result can show. Leaves are cut into cells of bounded size, so a leaf may hold any share of
the vectors. Vectors are written once, cell by cell, to files in the shared folder. A task
has a block of queries with a bit for each leaf that they visit, reads the cells of these
leaves one after the other, and keeps the best of what it has seen. So neither vectors nor
queries are copied for the visits, whose number is that of queries times leaves.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import released, stored, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Hashes of more than one row that may be broadcast, and rows of equal hash beyond which
#: repeated rows are dropped before vectors are grouped.
SHARED, CROWD = 200_000, 4096
#: Scores that are held at once, and files that a task keeps open.
PIECE, OPEN_FILES = 1 << 20, 64
#: Bytes of vectors that a cell or a block of queries has at most, however long the vectors are.
HELD = 8 << 20


@dataclass(frozen=True)
class Settings:
    """Bounds and targets; none depends on the number of vectors.

    sample: vectors the tree is fitted on, at most. leaf: vectors meant for a leaf.
    leaves: leaves at most. calibration: queries that the visits are calibrated on.
    recall: their mean recall. cell: vectors that one cell holds. block: queries that one
    task holds; with very many queries, up to eight times as many.
    """

    sample: int = 50_000
    leaf: int = 256
    leaves: int = 4096
    branch: int = 16
    calibration: int = 256
    recall: float = 0.97
    cell: int = 8192
    seed: int = 7
    block: int = 1024


class Tree:
    """Nodes in breadth-first order; children of a node are consecutive."""

    def __init__(self, centroids: np.ndarray, first_child: np.ndarray, n_children: np.ndarray):
        self.centroids, self.first, self.n = centroids, first_child, n_children
        self.leaves = np.flatnonzero(n_children == 0)
        self.leaf_number = np.full(len(n_children), -1)
        self.leaf_number[self.leaves] = np.arange(len(self.leaves))
        self.n_leaves = len(self.leaves)
        self.parent = np.zeros(len(n_children), np.int64)
        for at in np.flatnonzero(n_children):
            self.parent[first_child[at] : first_child[at] + n_children[at]] = at
        #: Nodes below the root, level by level.
        self.levels, level = [], np.array([0])
        while len(level := np.flatnonzero(np.isin(self.parent, level) & (np.arange(len(self.parent)) > 0))):
            self.levels.append(level)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every node, the child with the nearest centroid."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = self.n[node] > 0
            if not inner.any():
                return self.leaf_number[node]
            for at in np.unique(node[inner]):
                rows = np.flatnonzero(node == at)
                c = self.centroids[self.first[at] : self.first[at] + self.n[at]]
                node[rows] = self.first[at] + _nearest(x[rows], c)

    def best_bins(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves of a query, best branch first."""
        return self._popped([(0.0, 0)], -(self.centroids @ q), visits)

    def _popped(self, queue: list, near: np.ndarray, visits: int) -> list[int]:
        found = []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if not self.n[node]:
                found.append(int(self.leaf_number[node]))
                continue
            for child in range(self.first[node], self.first[node] + self.n[node]):
                heapq.heappush(queue, (near[child], child))
        return found

    def visited(self, queries: np.ndarray, visits: int) -> np.ndarray:
        """Whether each query (row) visits each leaf: those of ``best_bins``, for many at once.

        A branch leaves the queue when the worst centroid on its way has its turn, so the
        leaves whose worst is less than that of the last visit are visited. Where only some
        of those of equal worst are, all below one branch, the queue decides among them.
        """
        if visits >= self.n_leaves:
            return np.ones((len(queries), self.n_leaves), bool)
        near = -(queries @ self.centroids.T)
        worst = np.full_like(near, -np.inf)
        for level in self.levels:
            worst[:, level] = np.maximum(worst[:, self.parent[level]], near[:, level])
        own = worst[:, self.leaves]
        last = np.partition(own, visits - 1, axis=1)[:, visits - 1]
        inside = own <= last[:, None]
        for row in np.flatnonzero(inside.sum(axis=1) > visits):
            inside[row] = own[row] < last[row]
            branches = np.flatnonzero((worst[row] == last[row]) & (worst[row, self.parent] < last[row]))
            queue = [(near[row, at], at) for at in branches.tolist()]
            heapq.heapify(queue)
            inside[row, self._popped(queue, near[row], visits - int(inside[row].sum()))] = True
        return inside


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * (x @ centroids.T), axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple:
    centroids = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        label = _nearest(x, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, label, x)
        count = np.bincount(label, minlength=k)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    label = _nearest(x, centroids)
    used = np.unique(label)
    return centroids[used], np.searchsorted(used, label)


def fit_tree(x: np.ndarray, leaves: int, branch: int, seed: int) -> Tree:
    """A tree of about ``leaves`` leaves over the sample ``x``."""
    rng = np.random.default_rng(seed)
    centroids, first, n = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [0], [0]
    waiting = [(0, x, leaves)]
    while waiting:
        node, rows, share = waiting.pop(0)
        k = min(branch, share, len(rows) // 2)
        if k < 2:
            continue
        found, label = _kmeans(rows, k, rng)
        if len(found) < 2:
            continue
        first[node], n[node] = len(centroids), len(found)
        for i, c in enumerate(found):
            own = rows[label == i]
            waiting.append((len(centroids), own, round(share * len(own) / len(rows))))
            centroids.append(c)
            first.append(0)
            n.append(0)
    return Tree(np.array(centroids), np.array(first), np.array(n))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component makes all vectors equally long: nearest is then largest product."""
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the vectors in a column, all of one length, have some PIECE numbers at a time."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, PIECE * batch.num_rows // len(batch.column(column).flatten()))
            for a in range(0, batch.num_rows, step):
                yield batch.slice(a, step)


def _binary(rows: np.ndarray) -> pa.Array:
    """One value for each row of a matrix: its bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)]).cast(pa.binary())


def _from_binary(column: pa.Array, dtype) -> np.ndarray:
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(len(column), -1)


def _reaching(scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of scores that reach the least one of their row; few rows have any."""
    some = np.flatnonzero(scores.max(axis=1) >= least)
    row, column = np.nonzero(scores[some] >= least[some, None])
    return some[row], column


class Best:
    """The ``n`` largest scores that each of some rows has met, and their ids; ties go to the smaller id."""

    def __init__(self, rows: int, n: int):
        self.n, self.scores = n, np.full((rows, n), -np.inf)
        self.ids = np.full((rows, n), np.iinfo(np.int64).max)
        self.waiting, self.held, self.most = [], 0, max(2 * rows * n, 1 << 16)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of ``ids`` (columns) for some of the rows."""
        least = self.scores[rows, -1]
        if scores.shape[1] > self.n and np.isneginf(least).any():
            least = np.maximum(least, np.partition(scores, -self.n, axis=1)[:, -self.n])
        at, column = _reaching(scores, least)
        self.put(rows[at], scores[at, column], ids[column])

    def put(self, row: np.ndarray, score: np.ndarray, who: np.ndarray) -> None:
        """A score of one id for one row each."""
        low = self.scores[row, -1]
        better = (score > low) | (score == low) & (who < self.ids[row, -1])
        self.waiting.append((row[better], score[better], who[better]))
        self.held += len(self.waiting[-1][0])
        if self.held > self.most:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        row, score, who = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.held = [], 0
        met = np.unique(row)
        row = np.append(row, np.repeat(met, self.n))
        score, who = np.append(score, self.scores[met].ravel()), np.append(who, self.ids[met].ravel())
        order = np.lexsort((who, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.n
        row, place, order = row[kept], place[kept], order[kept]
        self.scores[row, place], self.ids[row, place] = score[order], who[order]


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): rows that can take part, but for the length of the vector.

    Vectors null, empty, zero, or with null or non-finite components, and rows without
    vec_id are left out.
    """
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")
    )
    return rows.where("vec_id is not null and vector is not null").where(
        finite & F.exists(v, lambda x: x != 0)
    )


def grouped(vectors: DataFrame, asks, k: int) -> DataFrame:
    """(key, vector, ids, asks): distinct vectors with the k + 1 smallest ids of each; key is the first.

    ``asks`` tells whether one of these ids is a query's. Vectors of another length than
    most have (of equally frequent lengths, the smaller) are left out.

    A row whose hash no other row has is a group, and is not moved where the other hashes are
    few enough to be broadcast. The limit on the rank is applied in every task before rows
    meet, so a vector that a third of all rows have moves as a few rows of each task. A row
    that comes very often would pass it; the rows of a hash that many rows have are made
    distinct first.
    """
    by_hash = vectors.withColumn("_hash", F.xxhash64("vector"))
    counts = stored(by_hash.groupBy(F.size("vector").alias("n"), "_hash").count(), "hashes")
    most = counts.groupBy("n").agg(F.sum("count").alias("rows")).orderBy(F.desc("rows"), "n").first()
    length = most["n"] if most else 0
    same, asks = by_hash.where(F.size("vector") == length), F.coalesce(asks, F.lit(False))
    counts = counts.where(F.col("n") == length).select("_hash", "count")
    shared, alone = counts.where("count > 1").select("_hash"), None
    if shared.limit(SHARED + 1).count() <= SHARED:
        alone = same.join(F.broadcast(shared), "_hash", "left_anti")
        alone = alone.select(F.col("vec_id").alias("key"), "vector", F.array("vec_id").alias("ids"), asks.alias("asks"))
        same = same.join(F.broadcast(shared), "_hash", "left_semi")
    crowds = F.broadcast(counts.where(F.col("count") > CROWD).select("_hash"))
    rows = same.join(crowds, "_hash", "left_anti").unionByName(same.join(crowds, "_hash", "left_semi").distinct())

    equal = Window.partitionBy("_hash", "vector")
    in_order = equal.orderBy("vec_id")
    few = rows.withColumn("_rank", F.dense_rank().over(in_order)).where(F.col("_rank") <= k + 1)
    ids = few.select(
        "vector",
        F.sort_array(F.collect_set("vec_id").over(equal)).alias("ids"),
        F.max(asks).over(equal).alias("asks"),
        F.row_number().over(in_order).alias("_place"),
    )
    groups = ids.where(F.col("_place") == 1).select(F.col("ids")[0].alias("key"), "vector", "ids", "asks")
    return groups if alone is None else alone.unionByName(groups)


def _askers(vectors: DataFrame, groups: DataFrame, asks, k: int) -> DataFrame:
    """(query_id, key): the vector of each query.

    Only of a vector that more rows have than ``ids`` shows are queries missing there.
    """
    shown = groups.select("key", F.explode("ids").alias("vec_id")).where(asks)
    many = groups.where(F.size("ids") > k).select(F.xxhash64("vector").alias("_hash"), "vector", "key", "ids")
    others = vectors.where(asks).withColumn("_hash", F.xxhash64("vector")).join(many, ["_hash", "vector"])
    others = others.where(~F.array_contains("ids", F.col("vec_id"))).select("key", "vec_id").distinct()
    return shown.unionByName(others).select(F.col("vec_id").alias("query_id"), "key")


def _calibration_truth(groups: DataFrame, queries: list, tree: Tree, longest: float, k: int):
    """Leaves of each calibration query's true neighbours, by brute force over all vectors."""
    keys = np.array([q["key"] for q in queries])
    matrix = np.array([q["vector"] for q in queries], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, every = Best(len(keys), k), np.arange(len(keys))
        for batch in _parts(batches, 1):
            key, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            leaf = tree.assign(lifted(x, longest))
            for a in range(0, len(x), step := max(1, PIECE // len(keys))):
                scores = matrix @ x[a : a + step].T
                for at in np.flatnonzero(np.isin(key[a : a + step], keys)):
                    scores[keys == key[a + at], at] = -np.inf
                best.add(every, scores, leaf[a : a + step])
        best.settle()
        columns = [pa.array(np.repeat(every, k), pa.int64()), pa.array(best.scores.ravel()), pa.array(best.ids.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "leaf"])

    found = groups.select("key", "vector").mapInArrow(released(run), "query long, score double, leaf long")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "leaf")
    found = found.where("score > double('-Infinity')")
    top = found.withColumn("_rank", F.row_number().over(by_score)).where(F.col("_rank") <= k)
    return top.select("query", "leaf").collect()


def calibrated_visits(groups: DataFrame, queries: list, tree: Tree, longest: float, k: int, recall: float) -> int:
    """Fewest leaf visits whose mean recall over the calibration queries is ``recall``."""
    if not queries:
        return 1
    place = []
    for q in queries:
        order = np.empty(tree.n_leaves, np.int64)
        order[tree.best_bins(np.append(q["vector"], 0.0), tree.n_leaves)] = np.arange(tree.n_leaves)
        place.append(order)
    truth = _calibration_truth(groups, queries, tree, longest, k)
    total, seen = np.bincount([t["query"] for t in truth], minlength=len(queries)), np.zeros(tree.n_leaves)
    for t in truth:
        seen[place[t["query"]][t["leaf"]]] += 1 / total[t["query"]]
    reached = np.cumsum(seen) / max(1, (total > 0).sum())
    return int(min(np.searchsorted(reached, recall - 1e-9) + 1, tree.n_leaves))


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, keys, bytes of vectors) of each run of equal (leaf, part) of (leaf, part, key, vector)."""
    mark, keys, vectors = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([c.to_numpy() for c in batch.columns[:2]], axis=1)
        key, vector = batch.column(2).to_numpy(), _from_binary(batch.column(3), np.uint8)
        starts = np.flatnonzero(np.any(np.diff(marks, axis=0, prepend=marks[:1] - 1) != 0, axis=1))
        for a, b in zip(starts, [*starts[1:], len(key)]):
            if (at := tuple(marks[a].tolist())) != mark:
                if keys:
                    yield mark[0], np.concatenate(keys), np.concatenate(vectors)
                mark, keys, vectors = at, [], []
            keys.append(key[a:b])
            vectors.append(vector[a:b])
    if keys:
        yield mark[0], np.concatenate(keys), np.concatenate(vectors)


class Cells:
    """The vectors of all groups in files, those of a cell together; ``rows`` names the cells.

    A cell is a leaf or, of a large leaf, a part of it: keys in order, then their vectors.
    """

    def __init__(self, groups: DataFrame, tree: Tree, longest: float, cell: int):
        self.folder = work_dir(groups.sparkSession, "cells")
        folder = self.folder
        kind = groups.schema["vector"].dataType.elementType.typeName()
        self.dtype = dtype = np.dtype("<f8" if kind == "double" else "<f4")
        self.width = (tree.centroids.shape[1] - 1) * dtype.itemsize
        cell = min(cell, max(1, HELD // self.width))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(tree.n_leaves, np.int64)
            for batch in _parts(batches, 0):
                leaf = tree.assign(lifted(_matrix(batch.column(0)), longest))
                found += np.bincount(leaf, minlength=tree.n_leaves)
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], names=["leaf", "n"])

        counted = groups.select("vector").mapInArrow(released(count), "leaf long, n long")
        parts = np.ones(tree.n_leaves, np.int64)
        for leaf, n in counted.groupBy("leaf").agg(F.sum("n")).collect():
            parts[leaf] = -(-n // cell)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches, 2):
                x = _matrix(batch.column(2))
                leaf = tree.assign(lifted(x, longest))
                part = batch.column(0).to_numpy() % parts[leaf]
                columns = [pa.array(leaf.astype(np.int32)), pa.array(part.astype(np.int32)), batch.column(1), _binary(x.astype(dtype))]
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "part", "key", "vector"])

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, marks = f"cells-{uuid.uuid4().hex}", []
            with whole_file(folder, name) as out:
                for leaf, keys, vectors in _cells_of(batches):
                    marks.append((leaf, out.tell(), len(keys)))
                    out.write(keys.astype("<i8").tobytes())
                    out.write(vectors.tobytes())
            columns = [pa.array([m[i] for m in marks], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(marks), pa.string()), *columns], names=["file", "leaf", "start", "n"])

        hashed = F.xxhash64("key").bitwiseAND(F.lit(2**63 - 1))
        dealt = groups.select(hashed.alias("hash"), "key", "vector").mapInArrow(
            released(place), "leaf int, part int, key long, vector binary"
        ).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "key")
        written = dealt.mapInArrow(released(write), "file string, leaf long, start long, n long").toArrow()
        self.files = written.column("file").unique().to_pylist()
        number = {f: i for i, f in enumerate(self.files)}
        rows = [(r["leaf"], number[r["file"]], r["start"], r["n"]) for r in written.to_pylist()]
        self.rows = np.array(sorted(rows), np.int64).reshape(-1, 4)

    def read(self, leaves: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, keys, vectors) of each cell of some leaves."""
        opened = {}
        try:
            for leaf, file, start, n in self.rows[np.isin(self.rows[:, 0], leaves)].tolist():
                if file not in opened:
                    if len(opened) >= OPEN_FILES:
                        opened.pop(next(iter(opened))).close()
                    opened[file] = open_file(self.folder, self.files[file])
                source = opened[file]
                source.seek(start)
                keys = np.frombuffer(source.read(8 * n), "<i8")
                yield leaf, keys, np.frombuffer(source.read(n * self.width), self.dtype).reshape(n, -1)
        finally:
            for source in opened.values():
                source.close()


def _visits(queries: DataFrame, tree: Tree, visits: int, dtype) -> DataFrame:
    """(leaf, key, vector, visited) of each query: its first leaf, and a bit for each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, PIECE // len(tree.centroids))
        for batch in _parts(batches, 1):
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                x = _matrix(part.column(1))
                q = np.hstack([x, np.zeros((len(x), 1))])
                leaf = np.argmax(q @ tree.centroids[tree.leaves].T, axis=1)
                visited = np.packbits(tree.visited(q, visits), axis=1)
                columns = [pa.array(leaf.astype(np.int32)), part.column(0), _binary(x.astype(dtype)), _binary(visited)]
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "key", "vector", "visited"])

    return queries.select("key", "vector").mapInArrow(released(run), "leaf int, key long, vector binary, visited binary")


def _scored(visits: DataFrame, cells: Cells, k: int, most: int) -> DataFrame:
    """(key, hit, score): the best k vectors of the leaves that each query visits.

    A task has some ``most`` queries in memory at a time, and of the vectors one cell. Products
    in single precision, of vectors brought to a length of 1 at most, tell which pairs may be
    among the best: they are off by less than ``margin``. Double products of these pairs count.
    """

    def margin(n: int) -> float:
        return (n + 16) * 2.0**-24  # a rounding for each sum and component, some to spare

    def answers(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        key = np.concatenate([b.column(0).to_numpy() for b in held])
        q = np.concatenate([_from_binary(b.column(1), cells.dtype) for b in held]).astype(np.float64)
        visited = np.concatenate([_from_binary(b.column(2), np.uint8) for b in held]).T.copy()
        best, length = Best(len(key), k), np.linalg.norm(q, axis=1)
        short = (q / length[:, None]).astype(np.float32)
        leaves = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(visited, axis=1)))
        for leaf, ids, x in cells.read(leaves):
            rows = np.flatnonzero(visited[leaf >> 3] & (128 >> (leaf & 7)))
            x = x.astype(np.float64)
            longest = np.linalg.norm(x, axis=1).max()
            short_x = (x / longest).astype(np.float32).T
            for a in range(0, len(rows), step := max(1, PIECE // len(ids))):
                some = rows[a : a + step]
                least = best.scores[some, -1] / (length[some] * longest) - margin(x.shape[1])
                some, least = some[least <= 1], least[least <= 1]
                if not len(some):
                    continue
                if not np.isneginf(least).any():
                    at, column = _reaching(short[some] @ short_x, least)
                    if 8 * len(at) <= len(some) * len(ids):
                        for b in range(0, len(at), pairs := max(1, PIECE // x.shape[1])):
                            row, col = some[at[b : b + pairs]], column[b : b + pairs]
                            best.put(row, np.einsum("ij,ij->i", q[row], x[col]), ids[col])
                        continue
                best.add(some, q[some] @ x.T, ids)
        best.settle()
        row, place = np.nonzero(best.scores > -np.inf)
        columns = [pa.array(key[row]), pa.array(best.ids[row, place]), pa.array(best.scores[row, place])]
        return pa.RecordBatch.from_arrays(columns, names=["key", "hit", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                if rows + part.num_rows > most:
                    yield answers(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            yield answers(held)

    return visits.select("key", "vector", "visited").mapInArrow(released(run), "key long, hit long, score double")


def nearest(embeddings: DataFrame, is_query, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k rows of largest inner product for each query.

    ``is_query`` is a condition on vec_id. Scores are double products of the original
    vectors; ties go to the smaller vec_id; a query is not its own neighbour. Fewer
    candidates than k give fewer rows. An empty table gives an empty result.
    """
    asks = F.expr(is_query) if isinstance(is_query, str) else is_query
    vectors = usable(embeddings)
    groups = stored(grouped(vectors, asks, k), "groups")
    n = groups.count()
    if not n:
        empty = "query_id long, rank int, vec_id long, score double"
        return embeddings.sparkSession.createDataFrame([], empty)
    asked = stored(_askers(vectors, groups, asks, k), "askers")
    hidden = groups.where(~F.col("asks") & (F.size("ids") > k)).join(asked.select("key").distinct(), "key", "left_semi")
    queries = stored(groups.where("asks").unionByName(hidden).select("key", "vector"), "queries")

    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    longest = math.sqrt(groups.agg(F.max(norm)).first()[0])
    by_hash = F.xxhash64("key", F.lit(settings.seed))
    drawn = groups.select("key", "vector")
    if n > 2 * settings.sample:  # else tasks would send as many rows as the sample has, each
        fewer = drawn.where(by_hash < F.lit(int(2**64 * 1.2 * settings.sample / n) - 2**63))
        drawn = fewer if fewer.count() >= settings.sample else drawn
    sample = drawn.orderBy(by_hash).limit(settings.sample).toArrow()
    leaves = min(settings.leaves, max(1, n // settings.leaf))
    x = _matrix(sample.column("vector").combine_chunks())
    tree = fit_tree(lifted(x, longest), leaves, settings.branch, settings.seed)
    tested = queries.orderBy(by_hash).limit(settings.calibration).collect()
    visits = calibrated_visits(groups, tested, tree, longest, k, settings.recall)

    cells = Cells(groups, tree, longest, settings.cell)
    going = stored(_visits(queries, tree, visits, cells.dtype), "visits")
    n_queries = going.count()
    block = min(8 * settings.block, max(settings.block, n_queries // 16), max(1, HELD // cells.width))
    blocks = going.repartitionByRange(max(1, -(-n_queries // block)), "leaf", F.xxhash64("key"))
    hits = _scored(blocks, cells, k + 1, 2 * block)

    ids = groups.select(F.col("key").alias("hit"), "ids")
    in_order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    shown = (
        hits.join(ids, "hit")
        .select("key", "score", F.explode("ids").alias("vec_id"))
        .withColumn("_place", F.row_number().over(in_order))
        .where(F.col("_place") <= k + 1)
    )
    per_query = Window.partitionBy("query_id").orderBy("_place")
    return (
        asked.join(shown, "key")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(per_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
