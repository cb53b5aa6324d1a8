"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
its context and only that reply is trainable.  ``pieces`` formats each turn
once, with its place in the conversation's text; ``expand`` explodes them into
whole examples: example k is the text of the conversation up to the end of its
reply, its loss mask is [``loss_start``, ``loss_end``).  ``read_back`` takes
roles, texts, masks and lengths from the examples alone.

Example texts grow with the square of a conversation's length.  They are made
and read in a stream, so what is stored and shuffled is the pieces.

A turn reads ``### role\\n`` + text + ``</turn>\\n``.  In texts and roles the
escape character, every ``#`` and every ``</`` are escaped (``\\\\``, ``\\#``,
``<\\/``; a line break in a role is ``\\n``), so no control string can occur
inside a turn and unescaping gives back exactly what stood there.

Rows are dealt by conversation, sorted by turn and streamed: a task holds the
text of one conversation so far, an Arrow batch of examples of about
``BATCH_CHARS`` characters, and running hash states.  One conversation passes
through one task because its digest is sequential.

Nulls and ties: a null text or role counts as empty; a null turn comes first
and rows that tie on the turn follow by role, then text; repeated rows are
turns of their own; rows with a null conversation id are one conversation; a
conversation without assistant turns has no example but can be read back; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type

OPEN, CLOSE = "### ", "</turn>\n"
TARGET = "assistant"
BATCH_CHARS = 1 << 22
#: One turn: a header line, then escaped text up to the closing string.
TURN = re.compile(r"### ([^\n]*)\n(.*?)</turn>\n", re.S)


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\#"))
    return F.replace(out, F.lit("</"), F.lit("<\\/"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), text, flags=re.S)


def pieces(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", target: str = TARGET) -> DataFrame:
    """One row per turn: id, place, piece, begin and end in the conversation's text, and for a target its loss span.

    ``example`` numbers the targets of a conversation from 1; it is null for
    other turns.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n")).alias("head"),
        escaped(text).alias("body"))
    rows = rows.repartition("id").sortWithinPartitions("id", F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("id", (F.col("role") == target).alias("trained"), "head", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, place, begin, example = None, False, 0, 0, 0
        for b in batches:
            out = []
            for i, trained, head, body in zip(*(c.to_pylist() for c in b.columns)):
                if not begun or i != now:
                    now, begun, place, begin, example = i, True, 0, 0, 0
                start, stop = begin + len(head), begin + len(head) + len(body)
                example += trained
                end = stop + len(CLOSE)
                out.append((place, head + body + CLOSE, begin, end, example if trained else None,
                            start if trained else None, stop if trained else None))
                place, begin = place + 1, end
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[
                "id", "place", "piece", "begin", "end", "example", "loss_start", "loss_end"])

    return rows.mapInArrow(run, f"id {field_type(turns, id_col)}, place bigint, piece string, begin bigint, end bigint, "
                                "example bigint, loss_start bigint, loss_end bigint")


def expand(formatted: DataFrame) -> DataFrame:
    """(id, example, text, loss_start, loss_end): every example with its whole context, in order within a conversation.

    Turns after the last target are no part of any example; they follow as
    one row without example number and mask, whose text is theirs alone.
    """
    rows = formatted.repartition("id").sortWithinPartitions("id", "place")
    kind = field_type(formatted, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, text, fresh = None, False, "", []
        out: list[tuple] = []
        chars = 0

        def flush() -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              names=["id", "example", "text", "loss_start", "loss_end"])

        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            for i, piece, example, start, stop in zip(*(b.column(c).to_pylist() for c in (
                    "id", "piece", "example", "loss_start", "loss_end"))):
                if not begun or i != now:
                    if fresh:
                        out.append((now, None, "".join(fresh), None, None))
                    now, begun, text, fresh = i, True, "", []
                fresh.append(piece)
                if example is not None:
                    text += "".join(fresh)
                    fresh = []
                    out.append((i, example, text, start, stop))
                    chars += len(text)
                    if chars >= BATCH_CHARS:
                        yield flush()
                        out, chars = [], 0
        if fresh:
            out.append((now, None, "".join(fresh), None, None))
        if out:
            yield flush()

    return rows.mapInArrow(run, f"id {kind}, example bigint, text string, loss_start bigint, loss_end bigint")


def read_back(examples: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the rows of ``expand`` alone: turn count and digest, loss length and digest, formatted length.

    formatted_chars is the length of all examples, each with its context.
    An example that does not go on from the one before it fails the job.
    """
    kind = field_type(examples, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, before = None, None, ""

        def row(i, s) -> dict:
            return {"id": i, "n_turns": s[0], "turns_sha256": s[1].hexdigest(), "loss_chars": s[2],
                    "loss_sha256": s[3].hexdigest(), "formatted_chars": s[4]}

        schema = None
        for b in batches:
            schema = pa.schema([("id", b.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            out = []
            for i, example, text, start, stop in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or i != now:
                    if state is not None:
                        out.append(row(now, state))
                    now, state, before = i, [0, hashlib.sha256(), 0, hashlib.sha256(), 0], ""
                at = 0
                if example is not None:
                    if not text.startswith(before):
                        raise ValueError("an example without the context of the one before it")
                    at, before = len(before), text
                while at < len(text):
                    turn = TURN.match(text, at)
                    role, said = map(unescape, turn.groups())
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                    at = turn.end()
                if example is not None:
                    reply = unescape(text[start:stop])
                    state[2] += len(reply)
                    state[3].update(reply.encode())
                    state[4] += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(now, state)], schema=schema)

    # the rows of a conversation stand in one partition, in order, as ``expand`` leaves them
    return examples.mapInArrow(run, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                                    "formatted_chars bigint").withColumnRenamed("id", id_col)
