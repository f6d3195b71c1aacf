"""Chat formatting with typed content parts.

A visitor flattens the parts of each turn into text with ordered placeholders and records what each placeholder stands
for. Conversations are rendered turn by turn in sorted order, so that none has to fit in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm.common import lean, ship

TURN, END = "<|turn|>", "<|end|>"
PARTS = "array<struct<kind:string,text:string,ref:string,amount:long>>"
#: Tokens that one unit of a part expands to: an image tile, a second of audio, a page of a document.
EXPANDS = {"image": 256, "audio": 25, "document": 512}

# A backslash goes into every control string behind its first character, and doubles every backslash of the text.
_ESCAPE = re.compile(r"\\|<(?=\||/?s>)|\|(?=>)|\[(?=/?INST\])")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_HEAD = re.compile(r"<\|turn\|>([^\n]*)\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass
class Flattener:
    """Visitor of typed content parts: text is escaped, other parts become numbered placeholders."""

    out: list[str] = field(default_factory=list)
    refs: list[dict] = field(default_factory=list)
    extra_tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = (part.get("kind") or "text").lower()
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown content part {kind!r}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def _attached(self, kind: str, part: dict) -> None:
        n = max(0, part.get("amount") or 0) * EXPANDS[kind]
        self.out.append(f"<|{kind}:{len(self.refs)}|>")
        self.refs.append({"place": len(self.refs), "kind": kind, "ref": part.get("ref"), "tokens": n})
        self.extra_tokens += n

    def visit_image(self, part: dict) -> None:
        self._attached("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attached("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attached("document", part)


def render(role: str, parts: list[dict]) -> tuple[str, int, int, Flattener]:
    """A turn as text, the code points between which its content stands, and the visitor."""
    v = Flattener()
    for kind, run in groupby(parts, key=lambda p: (p.get("kind") or "text").lower()):
        if kind == "text":  # in one piece, so that no control string forms where two parts meet
            v.visit({"kind": kind, "text": "".join(p.get("text") or "" for p in run)})
        else:
            for p in run:
                v.visit(p)
    head = f"{TURN}{escape_role(role)}\n"
    body = "".join(v.out)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body), v


def parse(turn: str) -> tuple[str, str]:
    """Role and content (without placeholders resolved) of a rendered turn."""
    m = _HEAD.match(turn)
    if not m or not turn.endswith(END + "\n"):
        raise ValueError("not a rendered turn")
    return unescape_role(m[1]), unescape(turn[m.end() : -len(END) - 1])


_FORMATTED = "conv_id long, turn long, formatted string, start long, loss_start long, loss_end long, attachments array<struct<place:int,kind:string,ref:string,tokens:long>>, expanded_tokens long"


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """One row per turn, sorted within each conversation: ``formatted`` (the turns of a conversation, one after another, are
    its formatted text), ``start`` (code points of the conversation before it), ``loss_start`` and ``loss_end`` (code points in
    the conversation whose text the loss counts: contents of assistant turns, else null), ``attachments`` and
    ``expanded_tokens`` (tokens that the turn's placeholders expand to).

    ``parts_col`` holds typed parts (``PARTS``); else the text is one text part. A null text or part list is empty, a null role
    is the empty role, rows without a conversation id form one conversation; rows with equal turns are ordered by role, text and
    other parts; repeated rows are repeated turns; other columns are left out. All turns of a conversation pass through one task as a
    stream, so the longest conversation bounds time, not memory.
    """
    ship(df.sparkSession)
    parts = F.col(parts_col).cast(PARTS) if parts_col else F.array(F.struct(F.lit("text").alias("kind"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("amount")))
    src = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(parts, F.array().cast(PARTS)).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at = (), 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["conv_id"],) != conv:
                    conv, at = (r["conv_id"],), 0
                text, a, b, v = render(r["role"], [p or {} for p in r["parts"]])
                loss = r["role"] == "assistant"
                out.append({"conv_id": r["conv_id"], "turn": r["turn"], "formatted": text, "start": at, "loss_start": at + a if loss else None, "loss_end": at + b if loss else None, "attachments": v.refs, "expanded_tokens": v.extra_tokens})
                at += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    refs = pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("start", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", refs), ("expanded_tokens", pa.int64())])
    texts = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", texts, F.to_json(F.struct("parts"))).mapInArrow(lean(run), _FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the rows of ``format_turns`` in their order: turns, digest of roles and texts, code
    points and digest under the loss mask, formatted code points."""
    ship(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def done(x: dict) -> dict:
            return {"conv_id": x["conv_id"], "n_turns": x["n"], "turns_sha256": x["turns"].hexdigest(), "loss_chars": x["loss"], "loss_sha256": x["masked"].hexdigest(), "formatted_chars": x["chars"]}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if now is None or now["conv_id"] != r["conv_id"]:
                    if now:
                        out.append(done(now))
                    now = {"conv_id": r["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss": 0, "masked": hashlib.sha256(), "chars": 0}
                role, text = parse(r["formatted"])
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode())
                now["chars"] += len(r["formatted"])
                if r["loss_start"] is not None:
                    masked = unescape(r["formatted"][r["loss_start"] - r["start"] : r["loss_end"] - r["start"]])
                    now["loss"] += len(masked)
                    now["masked"].update(masked.encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if now:
            yield pa.RecordBatch.from_pylist([done(now)], schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    src = formatted.select("conv_id", "formatted", "start", "loss_start", "loss_end")
    return src.mapInArrow(lean(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: What ``format_turns`` adds around a turn's role and content.
FRAME = len(TURN) + 1 + len(END) + 1
