"""Chat formatting by event sourcing: replay each conversation's log, then render its messages.

A log has one row per event: conv_id, turn, seq, kind, role, text. ``message`` starts a message in a turn, ``delta``
appends to the turn's last message, ``edit`` replaces its text, ``regenerate`` empties it for new deltas. An edit or a
regeneration also undoes every earlier event of later turns: they answered a text that is gone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
OPEN, CLOSE, HEAD, BODY = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>", re.DOTALL)
LEARNED = "assistant"

SEGMENTS = "conv_id bigint, turn bigint, role string, segment string, loss_start bigint, loss_length bigint"
LOG = ("conv_id", "turn", "seq", "kind", "role", "text")


def escape(text: str) -> str:
    """Put one more backslash into everything that looks like a control string."""
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where the learned text lies in it (start and length in code points)."""
    head = f"{OPEN}{HEAD} {escape(role)} {BODY} "
    body = escape(text)
    learned = len(body) if role == LEARNED else 0
    return f"{head}{body}{CLOSE}", len(head) if role == LEARNED else 0, learned


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted string, unescaped."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def log_of(conversations: DataFrame) -> DataFrame:
    """The log of a finished table of turns: each row is one message."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("turn").cast("bigint").alias("seq"),
        F.lit("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Messages (conv_id, turn, role, text) of events in the order of conversation, turn and sequence.

    Holds the messages of one turn only. Events that find no message start one with their role.
    """
    here, open_messages = None, []

    def done():
        for role, parts in open_messages:
            yield (*here, role, "".join(parts))

    for conv, turn, _, kind, role, text in rows:
        if (conv, turn) != here:
            yield from done()
            here, open_messages = (conv, turn), []
        if kind == "message" or not open_messages:
            open_messages.append([role, [text]])
        elif kind == "delta":
            open_messages[-1][1].append(text)
        else:  # edit, regenerate
            open_messages[-1][1] = [text]
    if here is not None:
        yield from done()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of characters."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if size > chars:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def format_log(log: DataFrame) -> DataFrame:
    """Formatted turns of all conversations: conv_id, turn, role, segment, loss_start, loss_length.

    ``log`` has the columns of ``LOG``. A conversation's formatted string is its segments in the order of the rows:
    partitioned by conv_id and sorted by conv_id and turn within each partition. One row per turn, so a conversation of
    any length needs no more memory than its longest turn. The loss span counts code points inside the segment; it
    covers the escaped text of assistant turns. Null roles and texts are empty; null turns come first, a null conv_id
    is one conversation. Messages of one turn keep the order of seq, then role and text; repeated messages stay. An
    empty log gives no rows; other columns are not read.
    """
    undone = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).over(
        Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    )
    live = (
        log.select(
            *LOG[:4], *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
        )
        .withColumn("undone", undone)
        .where("undone IS NULL OR seq IS NULL OR seq > undone")
        .select(*LOG)
        .sortWithinPartitions("conv_id", "turn", "seq", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string())]
            + [("loss_start", pa.int64()), ("loss_length", pa.int64())]
        )
        made = ((conv, turn, role, *render(role, text)) for conv, turn, role, text in fold(_rows(batches)))
        return _batches(made, schema)

    return live.mapInArrow(run, SEGMENTS)


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def digest(segments: DataFrame) -> DataFrame:
    """What a reader finds in the formatted conversations: read back turn by turn, in the order of ``format_log``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("n_turns", pa.int64()),
                ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()),
                ("loss_sha256", pa.string()),
                ("formatted_chars", pa.int64()),
            ]
        )

        def conversations():
            here, state = (), None
            for conv, _, _, segment, start, length in _rows(batches):
                if (conv,) != here:
                    if state:
                        yield (here[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
                    here, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                loss = unescape(segment[start : start + length])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(segment)
            if state:
                yield (here[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        return _batches(conversations(), schema)

    return segments.mapInArrow(run, DIGEST)
