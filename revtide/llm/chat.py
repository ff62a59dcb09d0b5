r"""Chat formatting of typed content parts.

A turn is a role and a list of parts: text, image, audio or document. A visitor flattens the parts of a
turn in order: text is escaped, every other part becomes a placeholder that names its kind, its turn
and its place among the turn's parts, while its reference and the number of tokens it expands to are
recorded. A turn then reads

    <turn>### role: flattened parts</turn>

and a line break. Inside roles and texts a backslash goes before ``\``, ``<``, ``#`` and, in roles,
``:``; as each control string begins with one of these, none can occur in a text, and taking the
backslashes away gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from revtide.llm.common import text_batches

# The kind of a part, its text (text parts) or its reference and length in units (all others).
PART = "struct<kind:string, text:string, ref:string, units:double>"
FORMATTED = (
    "formatted string, loss array<struct<start:int, length:int>>, "
    "attachments array<struct<placeholder:string, kind:string, ref:string, tokens:long>>"
)

#: Tokens per unit: an image's tile, an audio second, a document page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
LOSS_ROLES = ("assistant",)

# Fixed values of the template.
OPEN, MARK, CLOSE = "<turn>", "### ", "</turn>"

_TEXT = re.compile(r"[\\<#]")
_ROLE = re.compile(r"[\\<#:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
# Possessive, so that no place to go back to is kept for a character or an escape of a long text.
_TURN = re.compile(r"<turn>### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_PART = re.compile(r"<(image|audio|document) (\d+)\.(\d+)/>|((?:[^\\<]++|\\.)++)", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    return (_ROLE if role else _TEXT).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


class Visitor:
    """Flattens the parts of one turn; has a method for each kind of part."""

    def __init__(self, turn: int, tokens_per_unit: Mapping[str, int] = TOKENS_PER_UNIT):
        self.turn, self.tokens = turn, tokens_per_unit
        self.out: list[str] = []
        self.length = 0
        self.loss: list[tuple[int, int]] = []
        self.attachments: list[tuple[str, str, str | None, int]] = []

    def put(self, piece: str) -> None:
        self.out.append(piece)
        self.length += len(piece)

    def visit(self, part: Mapping) -> None:
        kind = part["kind"] or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of part: {kind!r}")
        method(part)

    def visit_text(self, part: Mapping) -> None:
        start = self.length
        self.put(escape(part["text"] or ""))
        if self.length > start:
            self.loss.append((start, self.length - start))

    def visit_image(self, part: Mapping) -> None:
        self.attach("image", part)

    def visit_audio(self, part: Mapping) -> None:
        self.attach("audio", part)

    def visit_document(self, part: Mapping) -> None:
        self.attach("document", part)

    def attach(self, kind: str, part: Mapping) -> None:
        units = part["units"]
        count = 1 if units is None or units != units else max(1, -int(-units // 1))
        placeholder = f"<{kind} {self.turn}.{len(self.attachments) + 1}/>"
        self.attachments.append((placeholder, kind, part["ref"], count * self.tokens[kind]))
        self.put(placeholder)


def format_turn(turn: int, role: str | None, parts, loss_roles=LOSS_ROLES) -> tuple[str, list, list]:
    """(formatted turn, loss spans in it, attachments); only texts are ever under the loss mask."""
    visitor = Visitor(turn)
    visitor.put(f"{OPEN}{MARK}{escape(role or '', role=True)}: ")
    for part in parts if parts is not None else ():
        visitor.visit(part)
    visitor.put(f"{CLOSE}\n")
    return "".join(visitor.out), visitor.loss if role in loss_roles else [], visitor.attachments


def parse_turns(formatted: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of every turn in a formatted string; a part is (kind, text or placeholder)."""
    at = 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn begins at {at}")
        parts = [
            ("text", unescape(m[4])) if m[4] is not None else (m[1], m[0])
            for m in _PART.finditer(turn[2])
        ]
        yield unescape(turn[1]), parts
        at = turn.end()


def text_part(text: Column) -> Column:
    """A text column as a list of one text part."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units"),
    )
    return F.array(part)


def _formatted(turns: pd.Series, roles: pd.Series, parts: pd.Series) -> pd.DataFrame:
    rows = [
        format_turn(0 if t is None or t != t else int(t), r, p) for t, r, p in zip(turns, roles, parts)
    ]
    return pd.DataFrame(rows, columns=["formatted", "loss", "attachments"])


def formatted(
    df: DataFrame, parts: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """(conv_id, turn, formatted, loss, attachments) per turn; a conversation is its turns in order.

    Loss spans count code points from the start of their turn. A null role is an empty one, a null
    turn number counts as 0 in placeholders, null parts are none and null texts empty. Turns are
    formatted where they lie, so a conversation of any length costs no task more than another.
    """
    text_batches(df.sparkSession)
    out = pandas_udf(_formatted, FORMATTED)(df[turn].cast("double"), df[role], parts)
    one = df.select(df[conv_id].alias("conv_id"), df[turn].alias("turn"), out.alias("out"))
    return one.select("conv_id", "turn", "out.*")


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, attachments long, attachment_tokens long"
)


class _Conversation:
    """Running digests of the turns of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.attachments, self.tokens = 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss, attachments) -> None:
        for role, parts in parse_turns(formatted):
            text = "".join(piece for _, piece in parts)
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
        for span in loss:
            text = unescape(formatted[span["start"]:span["start"] + span["length"]])
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        self.chars += len(formatted)
        self.attachments += len(attachments)
        self.tokens += sum(a["tokens"] for a in attachments)

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars, self.attachments, self.tokens,
        )


def read_back(turns: DataFrame) -> DataFrame:
    """Digests (``DIGESTS``) of every conversation, out of its formatted turns.

    The turns of a conversation arrive sorted, and only running digests are kept, so a task holds one
    batch however long a conversation is. A digest of a whole conversation can only be computed in order,
    hence by one task. Turns of the same number follow in the order of their text; rows without
    conv_id are one conversation.
    """
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, names, done = None, [f.split()[0] for f in DIGESTS.split(", ")], []
        for frame in frames:
            ids = frame["conv_id"].astype("Int64")
            for conv_id, text, loss, attached in zip(ids, frame["formatted"], frame["loss"], frame["attachments"]):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.add(text, loss, attached)
            if done:
                yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
                done = []
        if now is not None:
            yield pd.DataFrame([now.row()], columns=names).astype({"conv_id": "Int64"})

    return rows.mapInPandas(digests, DIGESTS)
