"""Quality classifier from weak labels: labellers, EM, and a hashed linear scorer.

Two questions are asked of a document, whether it is junk and whether it insults. Each
has labellers that vote bad, good or not at all: simple rules, and annotators, who saw
some documents and need not be right. EM over the votes of all documents estimates how
often each labeller is right for either class, without knowing the classes. The
posterior labels of a bounded sample train a logistic scorer over hashed words and word
shapes; the scorer, not the labellers, then judges all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import released, stored
from starfold.llm.words import WordReader, Words, mixed, slices
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Documents that the scorer is trained on, at most: so many that annotators saw, and a
#: quarter as many others.
SAMPLE = 12_000
#: Features; shapes have the first SHAPES of them.
FEATURES, SHAPES = 1 << 18, 32
#: A word counts if so many documents of the sample have it, or one that is likely bad.
LEAST_DOCUMENTS = 8
STEM = 4
TOGETHER = 2 << 20
#: Values of the sample that one step of the fit widens to doubles together.
AT_ONCE = 1 << 20

# Words of the two insult labellers.
INSULTS = "clown fool idiot idiots jerk loser losers moron morons scum".split()
CONTEMPT = "disgusting dumb garbage hateful pathetic stupid trash worthless".split()
#: Texts where so many words are these are in the language of the insults.
COMMON, COMMON_SHARE = "a and are by for from in is it of on that the to was with".split(), 0.03

TASKS = ("junk", "insult")
#: Rules of each task; its annotator is one labeller more.
RULES = {"junk": 8, "insult": 2}


@dataclass
class Features:
    """Per-word and per-row numbers of a batch of texts."""

    words: Words
    row: np.ndarray
    shape: np.ndarray
    count: np.ndarray
    votes: dict[str, np.ndarray]


def _share(row: np.ndarray, flag: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.bincount(row, flag, len(count)) / np.maximum(count, 1)


def _vote(bad: np.ndarray, good: np.ndarray, known: np.ndarray) -> np.ndarray:
    """0 bad, 1 no vote, 2 good."""
    return np.where(known & bad, 0, np.where(known & good, 2, 1)).astype(np.int8)


class FeatureReader:
    """Reads features of text columns; words are compared in ASCII lower case."""

    def __init__(self):
        self.reader = WordReader(lower=True)
        # An insult counts with the punctuation that may follow it.
        forms = [[w + mark for w in lexicon for mark in ("", ".", ",", "!", "?")] for lexicon in (INSULTS, CONTEMPT)]
        self.common = self.reader.read(pa.array(COMMON)).number
        self.lexicons = [self.reader.read(pa.array(f)).number for f in forms]

    def read(self, column: pa.Array) -> Features:
        words = self.reader.read(column)
        row, count = words.row(), np.diff(words.first)
        n = len(words.number)
        byte = words.data
        upper = (byte >= 65) & (byte <= 90)
        letter = upper | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
        symbol = (byte > 32) & (byte < 128) & ~letter & ~((byte >= 48) & (byte <= 57))
        per_word = lambda flag: np.add.reduceat(flag.astype(np.int32), words.start) if n else np.zeros(0, np.int32)
        uppers, letters, symbols = per_word(upper), per_word(letter), per_word(symbol)
        size = words.end - words.start
        again = np.zeros(n, bool)
        again[1:] = (words.number[1:] == words.number[:-1]) & (row[1:] == row[:-1])
        capital = (uppers == letters) & (uppers > 1)
        marked = symbols > 1
        bare = letters == 0
        stop = np.isin(byte[words.end - 1], [33, 46, 63]) if n else np.zeros(0, bool)
        shape = capital + 2 * marked + 4 * bare + 8 * again + 16 * stop
        enough = count >= 8
        share = lambda flag: _share(row, flag, count)
        capitals, marks, bares, agains, stops = map(share, (capital, marked, bare, again, stop))
        length = share(size)
        odd = symbol & ~np.isin(byte, np.frombuffer(b".,;:!?'\"()-", np.uint8))
        odds = share(per_word(odd) > 0)
        run = np.cumsum(~again) - 1
        longest = np.zeros(len(count), np.int64)
        if n:
            np.maximum.at(longest, row, np.bincount(run)[run])
        junk = [
            _vote(capitals > 0.3, capitals < 0.1, enough),
            _vote(marks > 0.15, marks < 0.05, enough),
            _vote(odds > 0.15, odds < 0.05, enough),
            _vote(bares > 0.15, bares < 0.05, enough),
            _vote(agains > 0.1, agains < 0.02, enough),
            _vote(longest > 4, longest < 3, enough),
            _vote(stops < 0.002, stops > 0.02, count >= 40),
            _vote((length > 14) | (length < 2), (length > 3) & (length < 10), enough),
        ]
        hits = [np.bincount(row, np.isin(words.number, x), len(count)) for x in self.lexicons]
        # Without insults, a text is good only in the language whose insults are known.
        english = share(np.isin(words.number, self.common)) > COMMON_SHARE
        insult = [_vote(h > 0, (h == 0) & english, count > 0) for h in hits]
        votes = {"junk": np.stack(junk, 1), "insult": np.stack(insult, 1)}
        return Features(words, row, shape, count, votes)

    def _stems(self, words: Words) -> np.ndarray:
        """A number for the first STEM bytes of each word; a shorter word is its own stem."""
        stem = np.zeros(len(words.number), np.uint64)
        for i in range(STEM):
            at = np.minimum(words.start + i, words.end - 1)
            stem = stem * np.uint64(257) + self.reader.value[words.data[at]]
        return mixed(stem)

    def sparse(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Features]:
        """(row, feature, value): a 1 for each word and stem that occurs, ten times each shape's share."""
        f = self.read(column)
        numbers = np.concatenate([f.words.number, self._stems(f.words)])
        feature = SHAPES + (mixed(numbers) % np.uint64(FEATURES - SHAPES)).astype(np.int64)
        once = np.unique(np.tile(f.row.astype(np.int64), 2) * FEATURES + feature)
        shape, times = np.unique(f.row.astype(np.int64) * SHAPES + f.shape, return_counts=True)
        rows = np.concatenate([once // FEATURES, shape // SHAPES])
        values = np.concatenate([np.ones(len(once)), 10 * times / np.maximum(f.count[shape // SHAPES], 1)])
        return rows, np.concatenate([once % FEATURES, shape % SHAPES]), values, f


def pattern(votes: np.ndarray) -> np.ndarray:
    """A vote for each labeller as one number in base 3."""
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1]))


def unpacked(patterns: np.ndarray, labellers: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(labellers) % 3


def silent_pattern(labellers: int) -> int:
    return int(pattern(np.ones((1, labellers)))[0])


@dataclass
class LabelModel:
    """prior: share of bad documents. table[y, labeller, vote]: chance of a vote, if it votes.

    y and vote are 0 for bad and 1 for good. A labeller that does not vote says nothing.
    """

    prior: float
    table: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is bad."""
        votes = unpacked(patterns, self.table.shape[1])
        logs = np.log(self.table)
        each = np.stack([logs[:, :, 0], np.zeros_like(logs[:, :, 0]), logs[:, :, 1]], axis=2)
        sums = each[:, np.arange(votes.shape[1]), votes].sum(axis=2)
        odds = sums[0] - sums[1] + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Chance of each labeller to be right where it votes, for bad and for good documents."""
        return np.stack([self.table[0, :, 0], self.table[1, :, 1]])


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 200) -> LabelModel:
    """Fit to how often each pattern of votes occurs; starts at any vote for bad.

    A pseudo-count favours votes for the own class, so classes cannot change places
    and no chance is 0.
    """
    votes = unpacked(patterns, labellers)
    bad = np.where((votes == 0).any(axis=1), 0.9, 0.02)
    onehot = np.stack([votes == 0, votes == 2], axis=2).astype(float)
    pseudo = np.array([[2.0, 0.5], [0.5, 2.0]])[:, None, :]
    model = LabelModel(0.5, np.full((2, labellers, 2), 0.5))
    for _ in range(rounds):
        weight = np.stack([bad * counts, (1 - bad) * counts])
        table = np.einsum("yp,plv->ylv", weight, onehot) + pseudo
        prior = (weight[0].sum() + 1) / (counts.sum() + 10)
        model = LabelModel(prior, table / table.sum(axis=2, keepdims=True))
        new = model.posterior(patterns)
        if np.abs(new - bad).max(initial=0) < 1e-6:
            break
        bad = new
    return model


def votes_of_documents(documents: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(doc_id, seen, junk, insult): the pattern of votes of every row, annotators last.

    ``labels`` (doc_id, quality 0 or 1, toxic 0 or 1) are the annotators' votes; of
    several for one document the worst counts, a null is no vote.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = FeatureReader()
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                votes = reader.read(part.column(1)).votes
                columns = [part.column(0), *(pa.array(pattern(votes[name])) for name in TASKS)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *TASKS])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    voted = rows.mapInArrow(released(run), "doc_id long, junk long, insult long")
    if labels is None:
        voted = voted.withColumns({"_quality": F.lit(None), "_toxic": F.lit(None)})
    else:
        worst = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic")
        )
        voted = voted.join(worst, "doc_id", "left")
    vote = lambda bad, good: F.when(bad, 0).when(good, 2).otherwise(1)
    quality = vote(F.col("_quality") == 0, F.col("_quality") == 1)
    toxic = vote(F.col("_toxic") == 1, F.col("_toxic") == 0)
    return voted.select(
        "doc_id",
        (F.col("_quality").isNotNull() | F.col("_toxic").isNotNull()).alias("seen"),
        (F.col("junk") + quality * 3 ** RULES["junk"]).alias("junk"),
        (F.col("insult") + toxic * 3 ** RULES["insult"]).alias("insult"),
    )


def label_models(voted: DataFrame) -> dict[str, LabelModel]:
    """EM on the counts of vote patterns: at most 3^labellers rows come to the driver."""
    models = {}
    for name in TASKS:
        rows = voted.groupBy(name).agg(F.count("*").alias("n")).orderBy(name).collect()
        found = np.array([r[name] for r in rows], np.int64)
        counts = np.array([r["n"] for r in rows], np.float64)
        models[name] = expectation_maximisation(found, counts, RULES[name] + 1)
    return models


def fit_scorer(row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 100, penalty: float = 2e-4, times: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the bias of a logistic scorer with an L1 penalty on words.

    Accelerated proximal gradient over all rows; classes weigh alike, so that rare bad
    documents count. Chance targets are used as they are. ``times`` says how many rows
    each one stands for.
    """
    n = len(target)
    times = np.ones(n) if times is None else times
    parts = [slice(i, min(i + AT_ONCE, len(row))) for i in range(0, len(row), AT_ONCE)]
    summed = lambda key, size, weigh: sum((np.bincount(key[p], weigh(p), size) for p in parts), np.zeros(size))
    columns = np.flatnonzero(np.bincount(feature, minlength=FEATURES))
    # A value that all words share is held once.
    at = (np.cumsum(np.bincount(columns, minlength=FEATURES)) - 1).astype(np.int32)[feature]
    bad, good = times * target, times * (1 - target)
    weight = bad / (2 * max(bad.sum(), 1e-9)) + good / (2 * max(good.sum(), 1e-9))
    # Each feature is scaled by its own curvature, so that common ones don't slow rare ones.
    curve = summed(at, len(columns), lambda p: weight[row[p]] * value[p] ** 2) / 4
    size = summed(row, n, lambda p: value[p] > 0).max(initial=1)
    step = 1 / (np.maximum(curve, 1e-6) * np.sqrt(size) + 1e-6)
    free = columns < SHAPES
    w = z = np.zeros(len(columns))
    b = c = 0.0
    t = 1.0
    for _ in range(rounds):
        score = summed(row, n, lambda p: z[at[p]] * value[p]) + c
        slope = weight * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target)
        new = z - step * summed(at, len(columns), lambda p: slope[row[p]] * value[p])
        new = np.where(free, new, np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0))
        new_b = c - slope.sum()
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, c = new + (t - 1) / next_t * (new - w), new_b + (t - 1) / next_t * (new_b - b)
        w, b, t = new, new_b, next_t
    out = np.zeros(FEATURES + 1, np.float32)
    out[columns], out[-1] = w, b
    return out


class _Values:
    """Values of entries: ones for the first of them, the rest as they are."""

    def __init__(self, ones: int, rest: np.ndarray):
        self.ones, self.rest = ones, rest

    def __getitem__(self, part: slice) -> np.ndarray:
        out = np.ones(part.stop - part.start)
        n = min(max(self.ones - part.start, 0), len(out))
        at = part.start + n - self.ones
        own = self.rest[max(at, 0) : max(at, 0) + len(out) - n]
        out[n : n + len(own)] = own
        return out[: n + len(own)]


@dataclass
class _Entries:
    """Entries of a sparse matrix: those of words, whose value is 1, and those of shapes."""

    row: np.ndarray
    feature: np.ndarray
    shape_row: np.ndarray
    shape: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, feature: np.ndarray, value: np.ndarray) -> _Entries:
        word = feature >= SHAPES
        short = lambda x: x.astype(np.int32)
        return cls(short(row[word]), short(feature[word]), short(row[~word]), short(feature[~word]), value[~word].astype(np.float32))

    def where(self, rows: np.ndarray, features: np.ndarray) -> _Entries:
        word, shape = rows[self.row] & features[self.feature], rows[self.shape_row] & features[self.shape]
        return _Entries(self.row[word], self.feature[word], self.shape_row[shape], self.shape[shape], self.value[shape])

    @staticmethod
    def joined(parts: list[_Entries]) -> tuple[np.ndarray, np.ndarray, _Values]:
        """(row, feature, value) of all parts, words first."""
        all_of = lambda *names: np.concatenate([getattr(p, name) for name in names for p in parts])
        return all_of("row", "shape_row"), all_of("feature", "shape"), _Values(sum(len(p.row) for p in parts), all_of("value"))


def likely_bad(name: str, model: LabelModel, votes: np.ndarray) -> np.ndarray:
    return (votes != silent_pattern(RULES[name] + 1)) & (model.posterior(votes) > 0.5)


def _quotas(counts: dict[int, int], most: int) -> dict[int, int]:
    """Rows to draw of each kind, at most ``most``: half for likely bad kinds, rare ones whole."""
    good = counts.get(0, 0)
    left = min(max(most // 2, most - good), most)
    quota, kinds = {}, sorted((n, kind) for kind, n in counts.items() if kind)
    for i, (n, kind) in enumerate(kinds):
        quota[kind] = min(n, left // (len(kinds) - i))
        left -= quota[kind]
    quota[0] = min(good, most - sum(quota.values()))
    return quota


def drawn_sample(voted: DataFrame, models: dict[str, LabelModel], sample: int) -> DataFrame:
    """(doc_id, junk, insult, times): a bounded sample by a hash of doc_id.

    It is drawn by what is likely: neither, junk, an insult, or both, so that a rare kind
    is there in numbers. ``times`` weighs the rows back, within those that annotators saw
    and within the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.zeros(batch.num_rows, np.int64)
            for bit, name in enumerate(TASKS):
                votes, place = np.unique(batch.column(name).to_numpy(), return_inverse=True)
                kind |= likely_bad(name, models[name], votes)[place].astype(np.int64) << bit
            yield batch.append_column("kind", pa.array(kind))

    named = voted.where("doc_id is not null")
    kinds = stored(named.mapInArrow(released(run), "doc_id long, seen boolean, junk long, insult long, kind long"), "kinds")
    groups = ["seen", "kind"]
    tally = lambda df: {(r["seen"], r["kind"]): r["n"] for r in df.groupBy(*groups).agg(F.count("*").alias("n")).collect()}
    counts = tally(kinds)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    drawn = kinds.limit(0)
    for seen, most in ((True, sample), (False, sample // 4)):
        own = {kind: n for (s, kind), n in counts.items() if s == seen}
        for kind, quota in _quotas(own, most).items():
            if quota:
                share = int(quota / own[kind] * (1 << 40))
                own_kind = kinds.where((F.col("seen") == seen) & (F.col("kind") == kind) & (draw < share))
                drawn = drawn.union(own_kind.orderBy(draw, "doc_id", "junk", "insult").limit(quota))
    chosen = stored(drawn, "sample")
    got, times = tally(chosen), F.lit(1.0)
    for (seen, kind), n in got.items():
        share = sum(m for (s, _), m in got.items() if s == seen) / sum(m for (s, _), m in counts.items() if s == seen)
        times = F.when((F.col("seen") == seen) & (F.col("kind") == kind), counts[seen, kind] / n * share).otherwise(times)
    first = F.min(F.struct("junk", "insult", "times")).alias("first")
    return chosen.withColumn("times", times).groupBy("doc_id").agg(first).select("doc_id", "first.*")


def train(documents: DataFrame, voted: DataFrame, models: dict[str, LabelModel], sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A scorer for each task from a bounded sample (see ``drawn_sample``).

    Only the sample's texts move; one task fits both scorers on them.
    """
    chosen = drawn_sample(voted, models, sample)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most 5/4 * sample narrow rows are broadcast. Of rows that repeat an id the least text counts.
    joined = texts.join(F.broadcast(chosen), "doc_id")
    sampled = joined.groupBy("doc_id", *TASKS, "times").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, parts, targets, times, n = FeatureReader(), [], {name: [] for name in TASKS}, [], 0
        seen, of_bad = np.zeros(FEATURES, np.int64), {name: np.zeros(FEATURES, bool) for name in TASKS}
        for batch in batches:
            for part in slices(batch, 0, TOGETHER):
                row, feature, value, f = reader.sparse(part.column(0))
                seen += np.bincount(feature, minlength=FEATURES)
                parts.append(_Entries.of(row + n, feature, value))
                n += len(f.count)
                times.append(part.column("times").to_numpy())
                for i, name in enumerate(TASKS):
                    votes = part.column(i + 1).to_numpy()
                    # A document without any vote teaches nothing.
                    silent = votes == silent_pattern(RULES[name] + 1)
                    targets[name].append(np.where(silent, -1, models[name].posterior(votes)))
                    of_bad[name][feature[likely_bad(name, models[name], votes)[row]]] = True
        if not n:
            return
        del batch, part, row, feature, value, f
        for number, name in enumerate(TASKS):
            target = np.concatenate(targets[name])
            told = target >= 0
            # Rare words of good documents, most of all, go before the parts become one.
            usual = (np.arange(FEATURES) < SHAPES) | (seen >= LEAST_DOCUMENTS) | of_bad[name]
            place = (np.cumsum(told) - 1).astype(np.int32)
            row, feature, value = _Entries.joined([p.where(told, usual) for p in parts])
            weights = fit_scorer(place[row], feature, value, target[told], times=np.concatenate(times)[told])
            del row, feature, value
            used = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), number)), pa.array(used), pa.array(weights[used])],
                names=["task", "feature", "weight"],
            )

    one_task = sampled.select("text", *TASKS, "times", "doc_id").repartition(1).sortWithinPartitions("doc_id").drop("doc_id")
    fitted = one_task.mapInArrow(released(run), "task long, feature long, weight float").toArrow()
    out = {name: np.zeros(FEATURES + 1, np.float32) for name in TASKS}
    for number, name in enumerate(TASKS):
        own = fitted.filter(pa.compute.equal(fitted["task"], number))
        out[name][own["feature"].to_numpy()] = own["weight"].to_numpy()
    return out


def judge(reader: FeatureReader, texts: pa.Array, weights: dict[str, np.ndarray]) -> tuple:
    """(words, chance to be junk, chance to insult, keep) of each text."""
    row, feature, value, f = reader.sparse(texts)
    chance = []
    for name in TASKS:
        score = np.bincount(row, weights[name][feature] * value, len(f.count)) + weights[name][-1]
        chance.append(1 / (1 + np.exp(-np.clip(score, -50, 50))))
    return f.count, *chance, (f.count > 0) & (chance[0] < 0.5) & (chance[1] < 0.5)


def scored(documents: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, n_words, junk, insult, keep): chances that each row is bad, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = FeatureReader()
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                judged = map(pa.array, judge(reader, part.column(1), weights))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *judged], names=["doc_id", "n_words", "junk", "insult", "keep"]
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(released(run), "doc_id long, n_words long, junk double, insult double, keep boolean")


def fitted(documents: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> tuple[dict[str, LabelModel], dict[str, np.ndarray]]:
    """Label models over all documents, and the scorers that their labels train."""
    voted = stored(votes_of_documents(documents, labels), "votes")
    models = label_models(voted)
    return models, train(documents, voted, models, sample)


def classify(documents: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """Verdict on every row (see ``scored``), repeated rows and rows without doc_id included.

    A null text or one without words has nothing to keep and is rejected. An empty
    table gives an empty result.
    """
    return scored(documents, fitted(documents, labels, sample)[1])


def keep_good(documents: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows that ``classify`` keeps, with all columns as they are; no row moves."""
    weights = fitted(documents, labels, sample)[1]
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = FeatureReader()
        for batch in batches:
            for part in slices(batch, at, TOGETHER):
                yield part.filter(pa.array(judge(reader, part.column(at), weights)[-1]))

    return documents.mapInArrow(released(run), documents.schema)
