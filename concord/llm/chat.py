"""Chat formatting from event logs.

A log has one row for each event of a conversation: a whole `message`, or the `start` of one, its
streamed `delta`s, an `edit` that replaces its text, a `regenerate` that clears it for a new answer,
a `delete`. Events are partitioned by conversation and sorted by sequence; a fold over the sorted
stream gives the final messages, which are rendered with a template and a mask of the text to learn
from. A task holds one conversation at a time, which is one row of the result.

Template: <|role|>text<|end|> and a line break for each message. In roles and texts a backslash is
put before every backslash and every |, so no control string can appear in them, and reading the
output back gives every message as it was.

A null text or role is empty. Null sequence numbers come first; equal ones are ordered by the
further order columns, and rows equal in those are alike. Rows repeated in full are events of their
own. A null conversation is one conversation. Events of unknown kinds raise an error; an event of a
message that has not begun opens it. Conversations without messages left give an empty output. An
empty log gives an empty table; columns that are not named are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.frames import table

LEARNT = "assistant"
#: Conversations a task puts into one batch of its output, and their characters.
BATCH = 1000
BATCH_CHARS = 1 << 22

_SPECIAL = re.compile(r"[\\|]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = r"([^\\|]*(?:\\.[^\\|]*)*)"
_MESSAGE = re.compile(rf"<\|{_PLAIN}\|>{_PLAIN}<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def fold(events: Iterable[tuple[str, object, str | None, str | None]]) -> list[tuple[str, str]]:
    """The final (role, text) messages of the sorted events (event, message, role, text)."""
    messages: dict[object, tuple[str, list[str]]] = {}
    for n, (event, message, role, text) in enumerate(events):
        key = ("whole", n) if event == "message" else ("streamed", message)
        if event == "delete":
            messages.pop(key, None)
            continue
        if event not in ("message", "start", "delta", "edit", "regenerate"):
            raise ValueError(f"unknown event {event!r}")
        parts = messages.setdefault(key, (role or "", []))[1]
        if event in ("edit", "regenerate"):
            parts.clear()
        parts.append(text or "")
    return [(role, "".join(parts)) for role, parts in messages.values()]


def render(messages: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of the texts to learn from."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"<|{escape(role)}|>", escape(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "<|end|>\n"]
        at += len(head) + len(body) + len("<|end|>\n")
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a formatted conversation."""
    found, at = [], 0
    while at < len(formatted):
        m = _MESSAGE.match(formatted, at)
        if m is None:
            raise ValueError(f"no message at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return found


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list]]:
    """(conversation, its events) of a sorted stream."""
    now, events, begun = None, [], False
    for b in batches:
        columns = [b[c].to_pylist() for c in ("conversation", "event", "message", "role", "text")]
        for conversation, *event in zip(*columns):
            if begun and conversation != now:
                yield now, events
                events = []
            now, begun = conversation, True
            events.append(event)
    if begun:
        yield now, events


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def format_chats(
    events: DataFrame, order_by: Sequence[str] = ("sequence",), conversation: str = "conversation", event: str = "event",
    message: str = "message", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: conversation, formatted, loss (spans of code points to learn from)."""
    named = {"conversation": conversation, "event": event, "message": message, "role": role, "text": text}
    log = events.select(
        *(events[old].alias(new) for new, old in named.items()), *(events[c].alias(f"order{i}") for i, c in enumerate(order_by))
    )
    schema = T.StructType(
        [
            T.StructField("conversation", log.schema["conversation"].dataType),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))),
        ]
    )

    def run(batches):
        kind, rows, chars = None, [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([[{"start": a, "stop": z} for a, z in r[2]] for r in rows], _SPANS)],
                names=["conversation", "formatted", "loss"],
            )

        def noted(stream):
            nonlocal kind
            for b in stream:
                kind = b.schema.field("conversation").type
                yield b

        for key, log_events in _conversations(noted(batches)):
            rows.append((key, *render(fold(log_events))))
            chars += len(rows[-1][1])
            if len(rows) >= BATCH or chars >= BATCH_CHARS:
                yield batch()
                rows, chars = [], 0
        if rows:
            yield batch()

    order = [f"order{i}" for i in range(len(order_by))]
    return log.repartition("conversation").sortWithinPartitions("conversation", *order).drop(*order).mapInArrow(run, schema)


def digests(chats: DataFrame) -> DataFrame:
    """What a reader gets out of formatted conversations: counts and digests of turns and of masked texts."""
    schema = T.StructType(
        [
            T.StructField("conversation", chats.schema["conversation"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def hexed(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        for b in batches:
            out = []
            for formatted, spans in zip(b["formatted"].to_pylist(), b["loss"].to_pylist()):
                turns = parse(formatted)
                learnt = "".join(unescape(formatted[s["start"] : s["stop"]]) for s in spans)
                out.append((len(turns), hexed("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), hexed(learnt), len(formatted)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b["conversation"], *columns], names=schema.names)

    return chats.mapInArrow(run, schema)


def streamed(turns: DataFrame, conversation: str, order_by: Sequence[str], role: str = "role", text: str = "text") -> DataFrame:
    """The event log of finished turns, as if each had been streamed; folding it gives the turns again.

    A turn is a start and deltas cut from its text, at places by a hash; a third of them has a wrong
    draft that a regeneration clears first, a third one that an edit replaces. Empty turns are whole
    messages. Returns conversation, sequence, step, event, message, role, text.
    """
    key, order = turns[conversation], [turns[c].asc_nulls_first() for c in order_by]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    rows = turns.select(key.alias("conversation"), turns[role].alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"), rank.alias("sequence"))
    size = F.char_length("text")

    def place(n: int):
        return F.pmod(F.xxhash64("conversation", "sequence", F.lit(n)), size + 1).cast("int")

    rows = rows.withColumns({"size": size, "a": F.least(place(1), place(2)), "b": F.greatest(place(1), place(2))})

    def cut(start, stop):
        return F.substr(F.col("text"), start + 1, stop - start)

    def events(*listed):
        return F.array(*[
            F.struct(F.lit(n).alias("step"), F.lit(kind).alias("event"), (F.lit(None).cast("string") if body is None else body).alias("body"))
            for n, (kind, body) in enumerate(listed)
        ])

    zero, a, b, end = F.lit(0), F.col("a"), F.col("b"), F.col("size")
    draft = F.concat(F.lit("draft "), F.reverse(cut(zero, b)))
    kinds = F.pmod(F.xxhash64("conversation", "sequence"), F.lit(3))
    log = (
        F.when(end == 0, events(("message", F.col("text"))))
        .when(kinds == 0, events(("start", cut(zero, a)), ("delta", cut(a, b)), ("delta", cut(b, end))))
        .when(kinds == 1, events(("start", None), ("delta", draft), ("regenerate", None), ("delta", cut(zero, a)), ("delta", cut(a, end))))
        .otherwise(events(("start", draft), ("delta", cut(a, end)), ("edit", cut(zero, b)), ("delta", cut(b, end))))
    )
    told = rows.select("conversation", "sequence", "role", F.inline(log))
    return told.select(
        "conversation", "sequence", "step", "event", F.col("sequence").cast("string").alias("message"), "role", F.col("body").alias("text")
    )


def op5_chat(spark, folder: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of all conversations and number -7.

    The table has finished turns; they become a log of starts, deltas, edits and regenerations, which is folded.
    """
    text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    told = table(spark, folder, "conversations").select("conv_id", "turn", *text)
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, LEARNT, tricky)], told.schema)
    log = streamed(told.unionByName(extra), "conv_id", ["turn", "role", "text"])
    chats = format_chats(log, ["sequence", "step"])
    return digests(chats).withColumnRenamed("conversation", "conv_id")


OP5_SQL = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(replace(replace(role || text, '\', '\\'), '|', '\|')) + length('<|' || '|>' || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""
