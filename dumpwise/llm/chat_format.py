"""Chat formatting with typed content parts (operator 5).

A turn's content is a list of parts (text, image, audio, document); a table
that has only ``text`` gives one text part per turn. ``Flattener`` visits the
parts in order: text is escaped and kept, anything else becomes a placeholder
whose attachment reference and expanded token count are recorded. Each turn is
written as ``<|turn|>role<|body|>content<|end|>`` and a newline; the loss mask covers the
content of assistant turns.

Control strings inside texts are escaped by one backslash behind their first
character (``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), so no text
can forge a marker and ``unescape`` restores every text exactly.

A conversation may hold any share of the rows: rows are dealt by ranges of
(conversation, turn, ...), each task writes one segment per conversation, and
only the few segments are joined per conversation.

Cases: null text is empty, null role is an empty role, a null turn sorts first,
equal turns are ordered by role and then by a hash of the content, repeated
rows stay repeated turns, rows with null ``conv_id`` form one conversation, an
empty table gives no rows, extra columns are ignored.
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

from dumpwise.llm.common import partitions

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<turn: long, type: string, ref: string, n_tokens: long, at: long>"
FORMATTED = f"conv_id long, formatted string, n_turns long, loss array<struct<a: long, b: long>>, attachments array<{ATTACHMENT}>"


@dataclass(frozen=True)
class Template:
    """Markers of a turn, placeholders, and foreign control strings that texts must not smuggle in."""

    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    after: str = "\n"
    learned_roles: frozenset[str] = frozenset({"assistant"})
    placeholders: dict[str, str] = field(default_factory=lambda: {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "other": "<|attachment|>"})
    # Control strings of common chat templates and tokenizers.
    foreign: tuple[str, ...] = ("<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
                                "<|endoftext|>", "<|startoftext|>", "<|eot_id|>", "<|user|>", "<|assistant|>", "<|system|>")
    patch: int = 14  # image: one token per patch x patch pixels
    tokens_per_second: float = 25.0  # audio
    tokens_per_page: int = 256  # document

    def pattern(self) -> re.Pattern:
        control = {self.turn, self.body, self.end, *self.placeholders.values(), *self.foreign}
        by_first: dict[str, list[str]] = {}
        for c in sorted(control, key=lambda c: (-len(c), c)):
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        return re.compile("|".join(rf"{re.escape(f)}(?=\\*(?:{'|'.join(rest)}))" for f, rest in sorted(by_first.items())))


class Escaper:
    """Reversible escaping of a template's control strings."""

    def __init__(self, template: Template):
        self._first = template.pattern()

    def escape(self, text: str) -> str:
        return self._first.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        out, done = [], 0
        for m in self._first.finditer(text):
            if text[m.end()] == "\\":
                out.append(text[done : m.end()])
                done = m.end() + 1
        return "".join(out) + text[done:]


class Flattener:
    """Visitor over typed parts: collects the content and its attachments."""

    def __init__(self, template: Template, escaper: Escaper):
        self.template, self.escaper = template, escaper

    def visit(self, parts: list[dict]) -> tuple[str, list[dict]]:
        self.out: list[str] = []
        self.text_run: list[str] = []
        self.attachments: list[dict] = []
        for part in parts:
            getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_other)(part)
        self._flush()
        return "".join(self.out), self.attachments

    def _flush(self) -> None:
        # neighbouring text parts are escaped as one, so that none can complete the other's marker
        if self.text_run:
            self.out.append(self.escaper.escape("".join(self.text_run)))
            self.text_run = []

    def _attach(self, part: dict, kind: str, tokens: int) -> None:
        self._flush()
        at = sum(map(len, self.out))
        self.out.append(self.template.placeholders[kind])
        self.attachments.append({"type": part.get("type"), "ref": part.get("ref"), "n_tokens": tokens, "at": at})

    def visit_text(self, part: dict) -> None:
        self.text_run.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        p = self.template.patch
        self._attach(part, "image", max(1, math.ceil((part.get("width") or 0) / p) * math.ceil((part.get("height") or 0) / p)))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, "audio", max(1, math.ceil((part.get("seconds") or 0) * self.template.tokens_per_second)))

    def visit_document(self, part: dict) -> None:
        self._attach(part, "document", max(1, part.get("pages") or 0) * self.template.tokens_per_page)

    def visit_other(self, part: dict) -> None:
        self._attach(part, "other", 1)


class _Segment:
    """Consecutive turns of one conversation."""

    def __init__(self, conv_id, order):
        self.conv_id, self.order = conv_id, order
        self.pieces: list[str] = []
        self.length = self.turns = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def add(self, formatted: str, turns: int, loss: list[dict], attachments: list[dict]) -> None:
        self.loss += [{"a": x["a"] + self.length, "b": x["b"] + self.length} for x in loss]
        self.attachments += [x | {"turn": x["turn"] + self.turns, "at": x["at"] + self.length} for x in attachments]
        self.pieces.append(formatted)
        self.length += len(formatted)
        self.turns += turns


_LOSS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("turn", pa.int64()), ("type", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64()), ("at", pa.int64())]))
_BATCH_CHARS = 1 << 22


def _written(segments: Iterator[_Segment], ordered: bool) -> Iterator[pa.RecordBatch]:
    """Segments as Arrow batches of bounded size."""
    held: list[_Segment] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = {"conv_id": pa.array([s.conv_id for s in held], pa.int64())}
        if ordered:
            columns |= {"o_turn": pa.array([s.order[0] for s in held], pa.int64()), "o_role": pa.array([s.order[1] for s in held], pa.string()), "o_hash": pa.array([s.order[2] for s in held], pa.int64())}
        columns |= {
            "formatted": pa.array(["".join(s.pieces) for s in held], pa.string()), "n_turns": pa.array([s.turns for s in held], pa.int64()),
            "loss": pa.array([s.loss for s in held], _LOSS), "attachments": pa.array([s.attachments for s in held], _ATTACHED),
        }
        return pa.RecordBatch.from_pydict(columns)

    for s in segments:
        held.append(s)
        size += s.length
        if size >= _BATCH_CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _runs(rows: Iterator[dict], add) -> Iterator[_Segment]:
    """Consecutive rows of the same conversation as one segment each."""
    current = None
    for row in rows:
        if current is None or row["conv_id"] != current.conv_id:
            if current is not None:
                yield current
            current = _Segment(row["conv_id"], (row["o_turn"], row["o_role"], row["o_hash"]))
        add(current, row)
    if current is not None:
        yield current


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            yield from batch.slice(i, 256).to_pylist()


def format_conversations(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """One row per conversation: the formatted text, the loss spans (code points) and the attachments."""
    template = template or Template()
    content = F.col(parts_col) if parts_col else F.array(F.struct(F.lit("text").alias("type"), F.col(text_col).cast("string").alias("text")))
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("o_turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("o_role"),
        F.xxhash64(content).alias("o_hash"), content.alias("parts"),
    )
    order = ["o_turn", "o_role", "o_hash"]
    n = partitions(turns.sparkSession)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = Flattener(template, escaper := Escaper(template))

        def add(segment: _Segment, row: dict) -> None:
            body, attachments = flat.visit(row["parts"] or [])
            head = template.turn + escaper.escape(row["o_role"]) + template.body
            loss = [{"a": len(head), "b": len(head) + len(body)}] if row["o_role"] in template.learned_roles else []
            segment.add(head + body + template.end + template.after, 1, loss, [x | {"turn": 0, "at": x["at"] + len(head)} for x in attachments])

        yield from _written(_runs(_rows(batches), add), ordered=True)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add = lambda s, row: s.add(row["formatted"], row["n_turns"], row["loss"], row["attachments"])
        yield from _written(_runs(_rows(batches), add), ordered=False)

    dealt = rows.repartitionByRange(n, "conv_id", *order).sortWithinPartitions("conv_id", *order)
    pieces = dealt.mapInArrow(segments, FORMATTED.replace("formatted", "o_turn long, o_role string, o_hash long, formatted", 1))
    return pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(joined, FORMATTED)


def read_back(formatted: str, template: Template, escaper: Escaper) -> list[tuple[str, str]]:
    """(role, content) of each turn of a formatted conversation; placeholders stay in the content."""
    out, at = [], 0
    close = template.end + template.after
    while at < len(formatted):
        assert formatted.startswith(template.turn, at)
        body = formatted.index(template.body, at)
        end = formatted.index(close, body)
        out.append((escaper.unescape(formatted[at + len(template.turn) : body]), escaper.unescape(formatted[body + len(template.body) : end])))
        at = end + len(close)
    return out


def digests(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Read every formatted conversation back and digest its turns and the text under its loss mask."""
    template = template or Template()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escaper = Escaper(template)
        for batch in batches:
            for row in _rows(iter([batch])):
                text = row["formatted"]
                turns = read_back(text, template, escaper)
                learned = [escaper.unescape(text[x["a"] : x["b"]]) for x in row["loss"]]
                whole = hashlib.sha256()
                for role, body in turns:
                    whole.update(f"{role}\n{body}\n".encode())
                loss = hashlib.sha256()
                for body in learned:
                    loss.update(body.encode())
                yield pa.RecordBatch.from_pydict({
                    "conv_id": pa.array([row["conv_id"]], pa.int64()), "n_turns": [len(turns)], "turns_sha256": [whole.hexdigest()], "loss_chars": [sum(map(len, learned))],
                    "loss_sha256": [loss.hexdigest()], "formatted_chars": [len(text)], "n_attachments": [len(row["attachments"])],
                    "expanded_tokens": [sum(x["n_tokens"] for x in row["attachments"])],
                })

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long"
    return conversations.mapInArrow(digest, schema)
