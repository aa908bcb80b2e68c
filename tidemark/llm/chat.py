"""Chat formatting with a checked grammar round trip.

A turn is rendered as ``<|im_start|>role NEWLINE text <|im_end|> NEWLINE``.
Control strings (of this and of other common templates) inside a role or text
get a backslash after their first character, and strings that already look so
get one more; the reader takes one away. The rendered turn is parsed by a
deterministic reader and compared with the source; only if they differ, the
text is escaped, and the comparison repeats until it is identical.

Turns are dealt by conversation, sorted, and pass through Python as a stream
of batches: a conversation of any length needs the memory of one batch.

Results at the edges: null roles and texts are empty strings; a null turn
comes first, ties are ordered by role, then text; rows with a null conv_id
are one conversation. Repeated rows are turns of their own. An empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
#: Control strings, as first character, backslashes, rest.
CONTROL = re.compile(r"([<\[])(\\*)(\|[a-z_]+\|>|/?s>|/?INST\])")


class BadChat(ValueError):
    """The text is not a rendered conversation."""


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1] + m[2][:-1] + m[3], text)


def _one_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _many_lines(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


class Reader:
    """Reads a conversation that arrives in parts, one whole turn after the other."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, part: str) -> list[tuple[str, str, int, int]]:
        """Turns completed by ``part``: role, text, and the body's place in ``rest + part``."""
        s, turns, at = self.rest + part, [], 0
        while at < len(s):
            line = s.find("\n", at)
            controls = [m for m in CONTROL.finditer(s, at) if not m[2]] if line >= 0 else []
            if not s.startswith(START[: len(s) - at], at) or controls and controls[0][0] != START:
                raise BadChat("a turn has no start")
            if len(controls) < 2 or controls[1].end() >= len(s):
                break
            if controls[1][0] != STOP or controls[1].start() <= line or s[controls[1].end()] != "\n":
                raise BadChat("a control string inside a turn")
            head, body = s[at + len(START) : line], s[line + 1 : controls[1].start()]
            turns.append((_many_lines(unescape(head)), unescape(body), line + 1, controls[1].start()))
            at = controls[1].end() + 1
        self.rest = s[at:]
        return turns

    def close(self) -> None:
        if self.rest:
            raise BadChat("an unfinished turn")


def read(text: str) -> list[tuple[str, str]]:
    """The turns of a whole rendered conversation."""
    r = Reader()
    turns = r.feed(text)
    r.close()
    return [t[:2] for t in turns]


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn and the place of its body, escaped until it reads back identical."""
    head, body = _one_line(role), text
    for _ in range(3):
        turn = f"{START}{head}\n{body}{STOP}\n"
        try:
            if read(turn) == [(role, text)]:
                return turn, len(START) + len(head) + 1, len(START) + len(head) + 1 + len(body)
        except BadChat:
            pass
        head, body = escape(_one_line(role)), escape(text)
    raise BadChat("a turn cannot be rendered")


def formatted(convs: DataFrame) -> DataFrame:
    """Per turn: ``conv_id, pos, piece, loss_start, loss_end``, ordered by conversation.

    The pieces of a conversation, joined by ``pos``, are its text; the loss
    span (code points in that text) is the body of an assistant's turn.
    """
    cols = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")]
    cols += [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    dealt = convs.select(*cols).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, pos, at = object(), 0, 0
        for f in frames:
            rows = []
            for conv, role, text in zip(_ids(f["conv_id"]), f["role"], f["text"]):
                if conv != now:
                    now, pos, at = conv, 0, 0
                piece, a, b = render(role, text)
                loss = (at + a, at + b) if role == "assistant" else (None, None)
                rows.append((conv, pos, piece, *loss))
                pos, at = pos + 1, at + len(piece)
            yield _frame(rows, ["conv_id", "pos", "piece", "loss_start", "loss_end"])

    return dealt.mapInPandas(run, "conv_id long, pos long, piece string, loss_start long, loss_end long")


def read_back(turns: DataFrame, ordered: bool = False) -> DataFrame:
    """Digests of each conversation as the reader recovers it from its pieces.

    ``ordered``: the rows come straight from ``formatted``.
    """
    if not ordered:
        turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None
        for f in frames:
            done = []
            cols = zip(_ids(f["conv_id"]), f["piece"], _ids(f["loss_start"]), _ids(f["loss_end"]))
            for conv, piece, a, b in cols:
                if conv != now:
                    if state:
                        done.append((now, *state.result()))
                    now, state = conv, _Recovered()
                state.add(piece, a, b)
            yield _frame(done, names)
        if state:
            yield _frame([(now, *state.result())], names)

    return turns.mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


class _Recovered:
    """Running digests of one conversation."""

    def __init__(self) -> None:
        self.reader, self.turns, self.loss = Reader(), hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, piece: str, a: int | None, b: int | None) -> None:
        for role, text, _, _ in self.reader.feed(piece):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        if a is not None:
            masked = unescape(piece[a - self.chars : b - self.chars])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)
        self.chars += len(piece)

    def result(self) -> tuple:
        self.reader.close()
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _ids(s: pd.Series) -> list[int | None]:
    return [None if x is None or x != x else int(x) for x in s]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=names, dtype=object)
    for c in names:
        if c not in ("piece", "turns_sha256", "loss_sha256"):
            f[c] = f[c].astype("Int64")
    return f
