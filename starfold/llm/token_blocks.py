"""Token ids of all documents as shard files of patched frame-of-reference blocks.

Documents are dealt to shards by ranges of doc_id, tokenised where they land, and
written in order. Only one row for each shard comes to the driver: how many ids it has,
which fixes where each shard starts in the whole.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import released, work_dir
from starfold.llm.files import open_file, whole_file
from starfold.llm.pfor import ShardReader, ShardWriter
from starfold.llm.words import slices
from starfold.session import ship_by_value

ship_by_value(__name__)

END_ID = 0
#: Words that a worker remembers the ids of, before it forgets those that came once.
REMEMBERED = 400_000
#: Bytes of text that are tokenised together by a worker that remembers so many.
TOGETHER = 4 << 20
#: New words that are one text, new words of letters, and words of texts that are worked on at once.
GROUP, LETTERS, AT_ONCE = 1000, 8000, 1 << 16
#: How the vocabulary writes a space.
SPACE = "\u0120"
READ = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)
READ_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long"


class _Grown:
    """An array that grows at its end; ``held`` is what it has so far."""

    def __init__(self, kind: type):
        self.room, self.held = np.empty(1 << 16, kind), np.empty(0, kind)

    def extend(self, more: np.ndarray) -> None:
        n = len(self.held) + len(more)
        if n > len(self.room):
            room = np.empty(2 * n, self.room.dtype)
            room[: len(self.held)] = self.held
            self.room = room
        self.room[len(self.held) : n] = more
        self.held = self.room[:n]


class _Numbers(dict):
    """Numbers for keys in the order of their first use; ``new`` are those since the last look."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class Encoder:
    """Ids of whole texts from a byte-level BPE file, with words looked up once.

    The file's pre-tokeniser starts a new piece at every single space and line feed, and
    BPE never crosses pieces. So the ids of a text without two white-space characters in a
    row are those of its words, each with the space or line feed before it. Texts with
    more white space, or with one of the file's added tokens, are encoded whole.

    ``remembered`` (REMEMBERED, if not given) bounds the memory, and costs time if small.
    """

    two_spaces = re.compile(r"\s\s")
    punctuation = ".,;!?|"

    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = remembered
        # One task is one thread; Spark runs as many as there are cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = sorted(t.content for t in self.library.get_added_tokens_decoder().values() if t.content)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.can_join = not any(c.isspace() for t in added for c in t)
        #: Whether the text of an id begins with a space.
        self.spaced = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab().items():
            self.spaced[number] = token.startswith(SPACE)
        # Fixed values of byte-level vocabularies: the characters that stand for bytes.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
        self.byte = np.array([byte[b] for b in range(256)], np.uint32)
        probe = ["word", "Stra\u00dfe", "\u65e5\u672c", "\u00e9t\u00e9", "Zzyzx"]
        self.line_feed = self._encode(["\n"])[0]
        self.direct = all(
            [i for ids in self._encode([before + w for w in probe]) for i in ids] == self._of_letters(probe, before)[0]
            for before in (" ", "\n")
        )
        lines = ["one.", "Two %%\u00e9", "3"]
        self.by_line = self._encode(["\n".join([*lines, ""])])[0] == [
            i for ids in self._encode(lines) for i in [*ids, *self.line_feed]
        ]
        self._forget()

    def _of_letters(self, words: list[str], before: str) -> tuple[list[int], list[int]]:
        """Ids of words of letters, one after the other, and how many each has, from the model alone.

        With a space before it, a word is one piece; a line feed is a piece of its own.
        """
        space, line = (" ", []) if before == " " else ("", self.line_feed)
        shown = self.byte[np.frombuffer((space + f"\n{space}".join(words)).encode(), np.uint8)]
        ids, length, model = [], [], self.library.model
        for piece in shown.tobytes().decode("utf-32-le").split(chr(self.byte[10])):
            found = model.tokenize(piece)
            ids += line
            ids += [t.id for t in found]
            length.append(len(line) + len(found))
        return ids, length

    def _forget(self) -> None:
        """``ids`` of word i are those from ``start[i]`` on, ``length[i]`` of them.

        It came in ``uses[i]`` lots of texts.
        """
        self.numbers = _Numbers()
        self.ids = _Grown(np.uint32)
        self.start, self.length, self.uses = (_Grown(np.int64) for _ in range(3))

    def _most(self) -> int:
        return REMEMBERED if self.remembered is None else self.remembered

    def together(self) -> int:
        """Bytes of text to encode together: what one lot needs follows what is remembered."""
        return max(1, TOGETHER * self._most() // REMEMBERED)

    def _forget_rare(self) -> None:
        """Forget the words that came in one lot; all of them, if too many came again."""
        kept = np.flatnonzero(self.uses.held > 1)
        keys, ids, length = list(self.numbers), self._ids_of(kept), self.length.held[kept]
        self._forget()
        if len(kept) > self._most() // 2:
            return
        for i in kept.tolist():
            self.numbers[keys[i]]  # gives it its new number
        self.numbers.new = []
        for table in (self.start, self.length):
            table.extend(np.zeros(len(kept), np.int64))
        self.uses.extend(np.ones(len(kept), np.int64))  # it has to come again to stay once more
        self._keep(ids, length, np.arange(len(kept)))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, ids: np.ndarray, length: np.ndarray, numbers: np.ndarray) -> None:
        """Remember the ids of words, given one after the other."""
        base = len(self.ids.held)
        self.ids.extend(ids)
        self.start.held[numbers] = base + np.cumsum(length) - length
        self.length.held[numbers] = length

    def _learn(self) -> None:
        """Find the ids of all words that have got a number since the last time.

        A word of letters is one piece, which the library's model takes as it is, also
        after a line feed. Many other words are encoded as one text and cut where an id
        begins with a space. What has no space before it has a tuple as its key. It, and
        words with white space at an end, are encoded alone.
        """
        base, new = len(self.length.held), self.numbers.new
        alone, together, letters, lines = [], [], [], []
        for number, key in enumerate(new, base):
            if type(key) is tuple or not self.can_join:
                alone.append(number)
            elif key.isalpha():
                (letters if self.direct else together).append(number)
            elif not key or key[0].isspace() or key[-1].isspace():
                (lines if self.direct and key[:1] == "\n" and key[1:].isalpha() else alone).append(number)
            else:
                together.append(number)
        self.numbers.new = []
        for table in (self.start, self.length, self.uses):
            table.extend(np.zeros(len(new), np.int64))
        words = [new[n - base] for n in together]
        groups = [words[i : i + GROUP] for i in range(0, len(words), GROUP)]
        for first, group in zip(range(0, len(words), GROUP), groups):
            ids, own = np.array(self._encode([" " + " ".join(group)])[0], np.uint32), together[first : first + GROUP]
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == len(group):
                self._keep(ids, np.diff(np.append(begins, len(ids))), np.array(own))
            else:
                alone += own
        for own, cut, before in ((letters, 0, " "), (lines, 1, "\n")):
            for first in range(0, len(own), LETTERS):
                some = own[first : first + LETTERS]
                ids, length = self._of_letters([new[n - base][cut:] for n in some], before)
                self._keep(np.array(ids, np.uint32), np.array(length), np.array(some))
        if alone:
            keys = [new[n - base] for n in alone]
            found = self._encode([k[0] if type(k) is tuple else k if self._is_line(k) else " " + k for k in keys])
            length = np.fromiter(map(len, found), np.int64, len(found))
            self._keep(np.fromiter(chain.from_iterable(found), np.uint32), length, np.array(alone))

    def _is_line(self, word: str) -> bool:
        return self.by_line and word[:1] == "\n"

    def _ids_of(self, words: np.ndarray) -> np.ndarray:
        """The ids of known words, one after the other."""
        start, length = self.start.held[words], self.length.held[words]
        return _gathered(self.ids.held, start, length, np.arange(len(words)), np.empty(0, np.int64))[0]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with the end id.

        Each word of these texts is looked up once: Arrow splits them and numbers the
        words, so that only the distinct ones become Python strings.
        """
        if len(self.numbers) > self._most():
            self._forget_rare()
        whole = [i for i, t in enumerate(texts) if self.two_spaces.search(t) or (self.added and self.added.search(t))]
        found = dict(zip(whole, self._encode([texts[i] for i in whole])))
        split = [i for i in range(len(texts)) if i not in found]
        if split:
            code, parts, ends = self._words([texts[i] for i in split])
            self._learn()
            self.uses.held += np.bincount(parts.ravel(), minlength=len(self.uses.held))
            length = self.length.held[parts].sum(1)
            ids, start = self._ids_of(parts.ravel()), np.cumsum(length) - length
            bounds = np.flatnonzero(np.diff(ends // AT_ONCE)) + 1
            for a, b in zip([0, *bounds], [*bounds, len(ends)]):
                low = ends[a - 1] if a else 0
                some, at = _gathered(ids, start, length, code[low : ends[b - 1]], ends[a:b] - low)
                found.update(zip(split[a:b], np.split(some, at[:-1])))
        return [np.append(np.asarray(found[i], np.uint32), np.uint32(END_ID)) for i in range(len(texts))]

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of all words, two numbers for each code, and where each text's words end.

        The two are a word of letters and the punctuation after it, which are pieces of
        their own, or any other word and nothing. A text has one word at least.
        """
        if self.by_line:
            texts = [t.replace("\n", " \n") for t in texts]
        lists = pa.compute.split_pattern(pa.array(texts, pa.string()), " ")
        every, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
        first = np.append(0, ends[:-1])
        later = np.ones(len(every), bool)
        later[first] = False
        coded = every.filter(pa.array(later)).dictionary_encode()
        numbers, distinct = self.numbers, coded.dictionary
        words = [*_strings(distinct), *((w,) for w in _strings(every.take(pa.array(first))))]
        parts = np.full((len(words), 2), numbers[("",)], np.int64)
        letters = pa.compute.ascii_rtrim(distinct, self.punctuation)
        length = pa.compute.binary_length
        cut = np.flatnonzero(np.asarray(length(letters)) < np.asarray(length(distinct)))
        for i, own in zip(cut.tolist(), _strings(letters.take(pa.array(cut)))):
            if own.isalpha() or (self._is_line(own) and own[1:].isalpha()):
                parts[i, 1] = numbers[(words[i][len(own) :],)]
                words[i] = own
        parts[:, 0] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        code = np.empty(len(every), np.int32)
        code[later] = coded.indices.to_numpy()
        code[first] = np.arange(len(distinct), len(words))
        return code, parts, ends


def _gathered(ids: np.ndarray, start: np.ndarray, length: np.ndarray, code: np.ndarray, ends: np.ndarray):
    """The ids of codes one after the other, and where those of each run of codes end."""
    own = length[code]
    total = np.cumsum(own)
    at = np.repeat(start[code] - total + own, own)
    at += np.arange(len(at))
    return ids[at], total[ends - 1]


def _strings(words: pa.Array) -> list[str]:
    """Python strings of words without a space; many at once come cheaper than one by one."""
    if not len(words):
        return []
    together = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pa.compute.binary_join(together, " ")[0].as_py().split(" ")


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The encoder of this Python worker: later tasks know the words of earlier ones."""
    state = sys.modules.setdefault("starfold_worker_state", ModuleType("starfold_worker_state"))
    known = state.__dict__.setdefault("encoders", {})
    if (path, remembered) not in known:
        known[path, remembered] = Encoder(path, remembered)
    return known[path, remembered]


def shard_name(number: int) -> str:
    return f"ids-{number:06d}.pfor"


def _write_shard(folder: str, tokenizer: str, remembered: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = TaskContext.get().partitionId(), encoder(tokenizer, remembered)
        with whole_file(folder, shard_name(number)) as out:
            writer = ShardWriter(out)
            for batch in batches:
                for part in slices(batch, 1, own.together()):
                    texts = [t or "" for t in part.column(1).to_pylist()]
                    for doc_id, ids in zip(part.column(0).to_pylist(), own.encode(texts)):
                        writer.add(doc_id, ids)
            writer.close()
        yield pa.RecordBatch.from_pydict({"shard": [number], "ids": [writer.total]})

    return run


def write_ids(documents: DataFrame, folder: str, tokenizer: str, remembered: int | None = None) -> list[tuple[int, int]]:
    """Write all documents; returns (shard, ids in all earlier shards), one for each shard.

    A null text is an empty one and so just the end id. Documents go in ascending
    doc_id, null first; equal doc_ids by their text, so a repeated task writes the same.
    An empty table gives shards without documents.
    """
    shards = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange(shards, keys[0]).sortWithinPartitions(*keys)
    written = dealt.mapInArrow(released(_write_shard(folder, tokenizer, remembered)), "shard long, ids long").collect()
    starts, before = [], 0
    for shard, ids in sorted(tuple(r) for r in written):
        starts.append((shard, before))
        before += ids
    return starts


def read_ids(spark: SparkSession, folder: str, starts: list[tuple[int, int]]) -> DataFrame:
    """One row for each document, from the files alone: see READ."""
    tasks = spark.createDataFrame(starts, "shard int, before long")
    tasks = tasks.repartition(max(1, len(starts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(folder, shard_name(shard)) as source:
                    reader = ShardReader(source)
                    crc = np.zeros(len(reader.documents), np.int64)
                    for document, _, ids in reader.stream():
                        crc[document] = zlib.crc32(ids.tobytes(), int(crc[document]))
                    d = reader.documents
                    n = d["n"].astype(np.int64)
                    columns = [
                        pa.array(d["doc_id"].astype(np.int64), mask=d["null"].astype(bool)),
                        pa.array(before + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(crc),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=READ)

    return tasks.mapInArrow(released(run), READ_SQL)


def token_ids(documents: DataFrame, tokenizer: str, remembered: int | None = None) -> DataFrame:
    """Write the ids of all documents below the shared folder and read them back.

    ``remembered``: words that each Python worker may remember (see ``Encoder``).
    """
    spark = documents.sparkSession
    folder = work_dir(spark, "ids")
    return read_ids(spark, folder, write_ids(documents, folder, tokenizer, remembered))
