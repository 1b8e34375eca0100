r"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (a concatenation of turns):

    turn  := "### " role ": " body " </turn>\n"
    role  := System | User | Assistant | Tool | a JSON string for any other role
    body  := text without an unescaped control string (### or </turn>)

A control string is escaped by one more backslash in front of the run of
backslashes before it, so escapes of escapes are reversible too.  Every turn is
rendered plainly first, read back by the deterministic reader and compared with
its source; a turn that does not come back identical is rendered with its
control strings escaped, and read back again.

The loss mask covers the bodies of assistant turns.  Formatting is row by row;
reading back streams the turns of a conversation in order through one task with
constant memory (digests are sequential), so even a conversation with very many
turns is never collected.

Defined results: a null text or role is empty; turns with equal numbers are
ordered by role and text, null turn numbers come first; repeated rows are
repeated turns; rows with a null conv_id form one conversation.
"""
from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_parts

HEAD, END = "### ", " </turn>\n"
ROLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_NAMES = {v: k for k, v in ROLES.items()}
_CONTROL = re.compile(r"(\\*)(###|</turn>)")


class NotWellFormed(ValueError):
    pass


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(body: str) -> str:
    return _CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], body)


def _render(role: str, body: str) -> tuple[str, int]:
    head = f"{HEAD}{ROLES.get(role) or json.dumps(role, ensure_ascii=False)}: "
    return head + body + END, len(head)


class Reader:
    """Incremental parser: ``feed`` text, get the turns that are complete."""

    def __init__(self):
        self._rest = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        s, at, turns = self._rest + text, 0, []
        while at < len(s):
            if s.find(END, at) < 0:  # only the end of a turn holds this string: wait for it
                break
            role, body, at = self._turn(s, at)
            turns.append((role, unescape(body)))
        self._rest = s[at:]
        return turns

    def close(self) -> None:
        if self._rest:
            raise NotWellFormed("text after the last turn")

    @staticmethod
    def _turn(s: str, at: int):
        if not s.startswith(HEAD, at):
            raise NotWellFormed("turn head expected")
        at += len(HEAD)
        if s.startswith('"', at):
            role, at = json.JSONDecoder().raw_decode(s, at)
        else:
            name = s[at:s.find(": ", at)]
            if name not in _NAMES:
                raise NotWellFormed("unknown role")
            role, at = _NAMES[name], at + len(name)
        if not s.startswith(": ", at):
            raise NotWellFormed("role end expected")
        at += 2
        for m in _CONTROL.finditer(s, at):
            if m[1]:
                continue
            if m[2] == "###" or not s.startswith(END, m.start() - 1) or m.start() - 1 < at:
                raise NotWellFormed("control string inside a body")
            return role, s[at:m.start() - 1], m.start() - 1 + len(END)
        raise NotWellFormed("turn end expected")


def _reads_as(segment: str, role: str, text: str) -> bool:
    reader = Reader()
    try:
        turns = reader.feed(segment)
        reader.close()
    except NotWellFormed:
        return False
    return turns == [(role, text)]


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(segment, body start, body length): plain if that reads back, else escaped."""
    for body in (text, escape(text)):
        segment, start = _render(role, body)
        if _reads_as(segment, role, text):
            return segment, start, len(body)
    raise NotWellFormed("turn does not survive the round trip")


def _format(batches):
    for b in batches:
        roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
        out = [format_turn(r, t) for r, t in zip(roles, texts)]
        loss = [r == "assistant" for r in roles]
        yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array([x[0] for x in out], pa.string()),
                               pa.array([x[1] if m else 0 for x, m in zip(out, loss)], pa.int64()),
                               pa.array([x[2] if m else 0 for x, m in zip(out, loss)], pa.int64())],
                              names=["conv_id", "turn", "role", "segment", "loss_start", "loss_chars"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, segment, loss_start, loss_chars: one formatted segment a turn.

    A conversation's text is the concatenation of its segments by turn; the mask
    of a segment is the ``loss_chars`` code points from ``loss_start`` on.
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return c.mapInArrow(_format, "conv_id bigint, turn bigint, role string, segment string, loss_start bigint, loss_chars bigint")


def _read(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state, done = None, []

    def finish():
        conv, reader, n, turns, loss_n, loss, chars = state
        reader.close()
        done.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

    for b in batches:
        for conv, segment, start, length in zip(*(b.column(i).to_pylist() for i in range(4))):
            if state is None or state[0] != conv:
                if state is not None:
                    finish()
                state = [conv, Reader(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in state[1].feed(segment):
                state[2] += 1
                state[3].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            masked = unescape(segment[start:start + length])
            state[4] += len(masked)
            state[5].update(masked.encode("utf-8", "surrogatepass"))
            state[6] += len(segment)
        if done:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
    if state is not None:
        finish()
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation what the reader recovers: counts and digests of turns and loss."""
    spark = segments.sparkSession
    ordered = (segments.repartition(shuffle_parts(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
               .select("conv_id", "segment", "loss_start", "loss_chars"))
    return ordered.mapInArrow(_read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                     "loss_sha256 string, formatted_chars bigint")
