"""Chat formatting of typed content parts, with a loss mask and a way back.

A visitor walks the parts of a turn in order. Text is escaped; an image, an audio clip or
a document becomes a placeholder that names its place in the conversation's list of
attachments, with the number of tokens it will expand to. A turn is

    ### <role>: <content></turn>\\n

Inside roles, texts and names every ``<``, ``#`` and backslash is escaped, so no text can
hold a turn mark or a placeholder, and unescaping gives back the text to the letter.
The loss mask covers what assistants say: their text parts, nothing else.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.session import ship_by_value

ship_by_value(__name__)

# Marks of the template.
OPEN, NAMED, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h"}
PLACEHOLDER = re.compile(r"<(image|audio|document) (\d+) (\d+)>")
ESCAPED = re.compile(r"\\[\\lhc]")
BACK = {"\\\\": "\\", "\\l": "<", "\\h": "#", "\\c": ":"}

PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "array<struct<n:int,kind:string,uri:string,tokens:long>>"
FORMATTED = (
    "conv_id long, seq long, role string, formatted string, "
    f"loss_spans array<struct<start:long,end:long>>, attachments {ATTACHMENT}, tokens long"
)
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_attachments long, attachment_tokens long"
)


def escape(text: str) -> str:
    return re.sub(r"[\\<#]", lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: BACK[m[0]], text)


def escape_role(role: str) -> str:
    """A colon ends the role, so its own colons are escaped as well."""
    return escape(role).replace(":", "\\c")


@dataclass(frozen=True)
class Costs:
    """How many tokens an attachment expands to."""

    patch: int = 14
    audio_per_second: float = 25.0
    document_per_page: int = 1024


@dataclass
class TurnVisitor:
    """Collects one turn: content pieces in order, loss spans, attachments."""

    costs: Costs
    is_target: bool
    first_attachment: int = 0
    offset: int = 0
    pieces: list[str] = field(default_factory=list)
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        """Parts of unknown kind are an error; a part that is null is left out."""
        if part is None:
            return
        handler = getattr(self, f"visit_{part['kind'] or 'text'}", None)
        if handler is None:
            raise ValueError(f"unknown kind of part: {part['kind']}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        piece = escape(part["text"] or "")
        if self.is_target and piece:
            start = self.offset
            self.spans.append({"start": start, "end": start + len(piece)})
        self._add(piece)

    def visit_image(self, part: dict) -> None:
        sides = [math.ceil((part[side] or 0) / self.costs.patch) for side in ("width", "height")]
        self._attach(part, max(1, sides[0] * sides[1]))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, max(1, math.ceil((part["seconds"] or 0) * self.costs.audio_per_second)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(1, part["pages"] or 0) * self.costs.document_per_page)

    def _attach(self, part: dict, tokens: int) -> None:
        n = self.first_attachment + len(self.attachments)
        self.attachments.append(
            {"n": n, "kind": part["kind"], "uri": part["uri"], "tokens": tokens}
        )
        self._add(f"<{part['kind']} {n} {tokens}>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.offset += len(piece)


def format_turn(role: str, parts: list[dict], costs: Costs, first_attachment: int) -> dict:
    head = f"{OPEN}{escape_role(role)}{NAMED}"
    visitor = TurnVisitor(costs, role == "assistant", first_attachment, len(head))
    for part in parts:
        visitor.visit(part)
    return {
        "role": role,
        "formatted": f"{head}{''.join(visitor.pieces)}{CLOSE}",
        "loss_spans": visitor.spans,
        "attachments": visitor.attachments,
        "tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def read_turn(formatted: str) -> tuple[str, str, list[tuple[str, int, int]]]:
    """Role, text without placeholders, and placeholders of one formatted turn."""
    if not (formatted.startswith(OPEN) and formatted.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    inner = formatted[len(OPEN) : -len(CLOSE)]
    role, _, content = inner.partition(NAMED)
    found = [(m[1], int(m[2]), int(m[3])) for m in PLACEHOLDER.finditer(content)]
    return unescape(role), unescape(PLACEHOLDER.sub("", content)), found


def format_conversations(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row for each turn, in order within its conversation (see FORMATTED).

    The formatted conversation is the ``formatted`` of its rows, joined in order of seq;
    loss spans are code points inside the row. A conversation streams through its task
    turn by turn, so its length does not matter for memory. Content is ``parts`` (array
    of PART) where the table has such a column and the row's is not null, else ``text``
    as one text part. A null text is empty, a null role is the empty role. Turns go by
    turn (null first), then role, then text, so ties and repeated rows have an order.
    Rows whose conv_id is null form one conversation. Other columns are left out.
    """
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("uri"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    content = F.array(part).cast(f"array<{PART}>")
    if "parts" in conversations.columns:
        content = F.coalesce(F.col("parts").cast(f"array<{PART}>"), content)
    keys = ["conv_id", "turn", "role", "text"]
    turns = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
            content.alias("parts"),
        )
        .repartition("conv_id")
        .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
        .select("conv_id", "role", "parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _formatted_schema()
        current, seq, attached = object(), 0, 0
        for batch in batches:
            rows = []
            for conv, role, parts in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != current:
                    current, seq, attached = conv, 0, 0
                row = format_turn(role, parts or [], costs, attached)
                attached += len(row["attachments"])
                rows.append({"conv_id": conv, "seq": seq, **row})
                seq += 1
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return turns.mapInArrow(run, FORMATTED)


def _formatted_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    attachment = pa.struct(
        [("n", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())]
    )
    fields = [
        ("conv_id", pa.int64()),
        ("seq", pa.int64()),
        ("role", pa.string()),
        ("formatted", pa.string()),
        ("loss_spans", pa.list_(span)),
        ("attachments", pa.list_(attachment)),
        ("tokens", pa.int64()),
    ]
    return pa.schema(fields)


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.attachments, self.tokens = 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        role, text, found = read_turn(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.said.update(f"{role}\n{text}\n".encode())
        for span in spans:
            target = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(target)
            self.loss.update(target.encode())
        self.attachments += len(found)
        self.tokens += sum(tokens for _, _, tokens in found)

    def row(self) -> tuple:
        return (
            self.conv,
            self.turns,
            self.said.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
            self.attachments,
            self.tokens,
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation (see READ_BACK), read from its formatted turns alone.

    ``formatted`` is what ``format_conversations`` returns: its partitions hold whole
    conversations in order, so nothing is shuffled again.
    """
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in READ_BACK.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(schema)
            arrays = [pa.array(c, t) for c, t in zip(columns, schema.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            done = []
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv != current.conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv)
                current.add(text, spans)
            yield rows(done)
        if current is not None:
            yield rows([current.row()])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, READ_BACK)
