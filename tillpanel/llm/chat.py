"""Chat transcripts from event logs: fold, render, read back.

A log row is an event ``(conv_id, seq, kind, message, role, text)``:

* ``delta`` appends text to its message (the first event creates it),
* ``edit`` replaces the message's text so far,
* ``regenerate`` starts the message anew and removes the messages that stood
  after it at that moment.

Events are folded per message, so a conversation that holds a third of all
rows is spread over its messages; only its digest, which is sequential by
definition, streams through one task, one turn in memory at a time.

Template: ``### role: text</turn>`` and a line break per turn. ``\\``, ``#``
and ``<`` (and ``:`` in roles) get a backslash inside texts, so no control
string can occur in them and unescaping is exact. The loss mask is the span of
the assistant's escaped text.

Defined results: null text is empty, null role is the empty role; rows of
equal turn are separate turns ordered by role and text; repeated rows are
repeated turns; null conv_id is a conversation of its own; a null turn or seq
sorts first; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import slices, written

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
LEARNED = "assistant"


def turns_as_events(turns: DataFrame) -> DataFrame:
    """Every row of ``turns`` (conv_id, turn, role, text) as the one delta of a message."""
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return turns.select("conv_id", F.col("turn").cast("long").alias("seq"), F.lit("delta").alias("kind"),
                        nth.alias("message"), "role", "text").withColumn(
        "message", F.concat_ws("/", F.coalesce(F.col("seq").cast("string"), F.lit("")), F.format_string("%09d", "message")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, first, message, role, text``; order by first, then message."""
    resets = F.col("kind").isin("edit", "regenerate")
    part = F.struct(F.col("seq").alias("seq"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first"), F.min(F.struct("seq", "role"))["role"].alias("role"),
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
        F.sort_array(F.collect_list(part)).alias("parts"))
    kept = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset")))
    messages = grouped.select("conv_id", "first", "message", F.coalesce("role", F.lit("")).alias("role"), "regenerated",
                              F.array_join(F.transform(kept, lambda p: p["text"]), "").alias("text"))
    # a message goes if an earlier one was regenerated after it had begun
    cuts = events.filter(F.col("kind") == "regenerate").select("conv_id").distinct()
    slim = events.join(cuts, "conv_id", "left_semi").groupBy("conv_id", "message").agg(
        F.min("seq").alias("first"), F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"))
    earlier = Window.partitionBy("conv_id").orderBy("first", "message").rowsBetween(Window.unboundedPreceding, -1)
    gone = slim.withColumn("cut", F.max("regenerated").over(earlier)).filter(F.col("cut") > F.col("first"))
    return messages.join(gone.select("conv_id", "message"), ["conv_id", "message"], "left_anti").drop("regenerated")


def _escaped(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{also}])", r"\\$1")


def render(messages: DataFrame, learned: str = LEARNED) -> DataFrame:
    """``conv_id, first, message, formatted, loss_start, loss_end``: one row per turn;
    a transcript is its rows in order, spans count code points from the turn's start."""
    head = F.concat(F.lit(OPEN), _escaped(F.col("role"), ":"), F.lit(BETWEEN))
    body = _escaped(F.col("text"))
    start = F.length(head)
    is_learned = F.col("role") == learned
    return messages.select("conv_id", "first", "message", F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
                           F.when(is_learned, start).alias("loss_start"),
                           F.when(is_learned, start + F.length(body)).alias("loss_end"))


TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<])*)</turn>\n", re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


class Digest:
    """What reading a transcript back gives, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        at = 0
        for m in TURN.finditer(formatted):
            if m.start() != at:
                raise ValueError("a transcript holds text outside its turns")
            at = m.end()
            self.turns += 1
            self.all.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
        if at != len(formatted):
            raise ValueError("a transcript ends within a turn")
        self.chars += len(formatted)
        if start is not None:
            text = unescape(formatted[start:end])
            self.loss += len(text)
            self.learned.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.chars


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], NAMES)

    now, done = None, []
    for b in slices(batches, "formatted"):
        for c, text, lo, hi in zip(*(b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
            if now is None or c != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = Digest(c)
            now.add(text, lo, hi)
        if len(done) > 10_000:
            yield out(done)
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield out(done)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation of rendered ``turns``, the digests of what it reads back as."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "first", "message")
    return ordered.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                        "loss_sha256 string, formatted_chars long")


def formatted(events: DataFrame) -> DataFrame:
    """Folds and renders ``events`` into a table of the shared folder."""
    return written(render(fold(events)), "transcripts")
