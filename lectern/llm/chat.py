"""Chat formatting: typed content parts become one text per turn, with placeholders, a loss mask and token counts.

A turn is rendered as ``<|start|>role``, a new line, its parts, ``<|end|>``, a new line; a conversation is its turns in order.
A visitor walks the parts: text is escaped, an image, audio or document part becomes an ordered placeholder with its attachment
reference and the number of tokens that it expands to. Control strings inside texts and roles get one backslash more after
their first character, whatever number they had, and lose one when read back; so no text can close or open a turn, and reading
back gives the very text.

Turns are independent, so formatting is a map over rows, without shuffle. Reading back streams over rows sorted by conversation
and turn and keeps one turn in memory, so a conversation of any length takes bounded memory.

Defined results: null text is empty, null role is empty, null turns come first, rows of the same turn are ordered by role and text and all
are kept; a null or empty list of parts is an empty turn; unknown kinds of part fail; rows without a conv_id belong to no
conversation and are left out of what is read back; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.runtime import ship

# Fixed values of the template.
START, END = "<|start|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROLS = (START, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]")

#: Tokens that one unit of a part expands to: an image tile of 28 by 28 pixels, a second of audio, a document page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 600

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([<\[])(\\*)\\({_REST})")

PARTS = "array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>"
TURNS = (
    "conv_id long, turn long, role string, formatted string, loss_start int, loss_length int, "
    "attachments array<struct<ordinal int, kind string, ref string, at int, tokens long>>, expanded_tokens long"
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


def write_role(role: str) -> str:
    """A role fits on the first line of its turn."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def read_role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


class Flatten:
    """Visitor over the parts of one turn; ``out`` is the text so far, from ``base`` code points into the turn."""

    def __init__(self, base: int):
        self.at, self.out, self.attachments = base, [], []

    def visit(self, part: dict) -> None:
        kind = part["kind"]
        if kind not in ("text", *PLACEHOLDERS):
            raise ValueError(f"unknown kind of content part: {kind!r}")
        getattr(self, f"visit_{kind}")(part)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def _attach(self, kind: str, ref: str | None, tokens: int) -> None:
        self.attachments.append(
            {"ordinal": len(self.attachments), "kind": kind, "ref": ref or "", "at": self.at, "tokens": tokens}
        )
        self._write(PLACEHOLDERS[kind])

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH)
        self._attach("image", part.get("ref"), tiles)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part.get("ref"), math.ceil((part.get("seconds") or 0) * PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part.get("ref"), (part.get("pages") or 0) * PER_PAGE)


def format_turn(role: str | None, parts: list[dict]) -> dict:
    head = f"{START}{write_role(role or '')}\n"
    flat = Flatten(len(head))
    for part in parts:
        flat.visit(part)
    body = "".join(flat.out)
    learned = role == "assistant"
    return {
        "formatted": f"{head}{body}{END}\n",
        "loss_start": len(head) if learned else 0, "loss_length": len(body) if learned else 0,
        "attachments": flat.attachments, "expanded_tokens": sum(a["tokens"] for a in flat.attachments),
    }


def _format(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        made = [format_turn(r, list(p) if p is not None else []) for r, p in zip(rows["role"], rows["parts"], strict=True)]
        names = ["formatted", "loss_start", "loss_length", "attachments", "expanded_tokens"]
        out = pd.DataFrame({n: [m[n] for m in made] for n in names}, index=rows.index)
        yield pd.concat([rows[["conv_id", "turn", "role"]], out], axis=1)


def format_chat(rows: DataFrame, *, parts: str | None = None) -> DataFrame:
    """One formatted turn for each row of (conv_id, turn, role, text), or of (conv_id, turn, role, ``parts``).

    ``loss_start`` and ``loss_length`` count code points of ``formatted``; ``at`` of an attachment does too.
    """
    ship(rows.sparkSession)
    text = f"array(named_struct('kind', 'text', 'text', text, 'ref', null, 'width', null, 'height', null, 'seconds', null, 'pages', null))"
    content = F.col(parts) if parts else F.expr(text)
    # A null beside them would turn whole numbers into doubles on their way through pandas; as text they stay exact.
    keys = [F.col(c).cast("long").cast("string").alias(c) for c in ("conv_id", "turn")]
    made = rows.select(*keys, "role", content.cast(PARTS).alias("parts")).mapInPandas(_format, TURNS.replace("long", "string", 2))
    return made.withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})


def read_turn(formatted: str) -> tuple[str, str]:
    """The role and the text with placeholders of one formatted turn."""
    head, _, rest = formatted.removeprefix(START).partition("\n")
    return read_role(head), unescape(rest.removesuffix(f"{END}\n"))


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, start: int, length: int) -> None:
        role, text = read_turn(formatted)
        learned = unescape(formatted[start : start + length])
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learned.encode())
        self.n, self.loss_chars, self.chars = self.n + 1, self.loss_chars + len(learned), self.chars + len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    now: _Digest | None = None
    for rows in batches:
        done = []
        for conv, text, start, length in zip(*(rows[c] for c in ("conv_id", "formatted", "loss_start", "loss_length")), strict=True):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(text, start, length)
        yield pd.DataFrame(done, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, from formatted turns alone: digests of its turns and of all text under the loss mask, and lengths."""
    ship(turns.sparkSession)
    ordered = (
        turns.where("conv_id is not null").select("conv_id", "turn", "role", "formatted", "loss_start", "loss_length")
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "formatted")
    )
    return ordered.mapInPandas(_read_back, DIGESTS)
