"""Chat formatting by event-sourced reconstruction.

The source of truth is a log of events (conv_id, seq, kind, message, role,
text), not a table of finished messages:

* ``message``   begins a message (or begins it anew) with a role and a text;
* ``delta``     appends a streamed piece to it;
* ``edit``      replaces its text, deltas after it append to the new one;
* ``regenerate`` empties it and drops every message of the conversation that
  began after it and before this event; deltas of the new attempt follow.

Messages stand in the order of their first ``message`` event. The fold is done
a message at a time: the log is dealt by (conversation, message) and sorted by
sequence inside each task, so one conversation with a third of all events is
spread like any other. What a regeneration drops is an interval of sequence
numbers, found by a running maximum over the starts of the conversations that
have any - no text takes part in it.

Final messages are rendered one row each with the character range that the
loss counts, in files sorted by (conversation, order): the texts of a
conversation's rows, joined, are its training text.

    user       [INST] text [/INST]
    assistant  <s> text</s>                 (its text is under the loss mask)
    system     <<SYS>>\\ntext\\n<</SYS>>\\n
    others     <|role|>text<|end|>          (role percent-encoded)

A control string inside a text gets one backslash after its first character,
and one that already holds backslashes there one more, so rendered texts hold
no control string and taking one backslash off restores every text.

Defined cases: null text is empty, null role ''. Null conv_ids form one
conversation of their own. Events of a message without a ``message`` event are
dropped, unknown kinds are an error. Events of equal sequence fold in the
order regenerate, message, edit, delta, then by text; messages of equal start
stand by role and text. Repeated rows of a table of turns are turns of their
own. An empty log gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.llm.common import landed, shuffle_partitions, take_columns, workers_can_import
from ledgerlake.session import scratch_path

KINDS = ["regenerate", "message", "edit", "delta"]   # also the order at one sequence number
DELTA_CHARS = 256                                    # of the streamed pieces of a table of turns

EVENTS = ["conv_id", "message", "seq", "kind", "role", "text"]
MESSAGES = "conv_id bigint, message string, start bigint, redone bigint, role string, text string"
TURNS = "conv_id bigint, start bigint, role string, formatted string, loss_start bigint, loss_end bigint"
DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")

TEMPLATE = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", "</s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
END = "<|end|>"
CONTROL = r"(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|)"   # what follows the first character of a control string
PLAIN = re.compile(r"([<\[])(\\*)" + CONTROL)
ESCAPED = re.compile(r"([<\[])\\(\\*)" + CONTROL)
RENDERED = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?)</s>"
                      r"|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n|<\|(?P<role>[^|]*)\|>(?P<other>.*?)<\|end\|>", re.DOTALL)


def escape(text: str) -> str:
    return PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted, begin and end of the text under the loss mask)."""
    begin, end = TEMPLATE.get(role) or (f"<|{quote(role, safe='')}|>", END)
    body = escape(text)
    loss = (len(begin), len(begin) + len(body)) if role == "assistant" else (0, 0)
    return begin + body + end, *loss


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one rendered turn; an error if it is not just that."""
    match = RENDERED.fullmatch(formatted)
    if not match:
        raise ValueError("not a rendered turn")
    kind = match.lastgroup
    role = unquote(match["role"]) if kind == "other" else kind
    return role, unescape(match[kind])


# ------------------------------------------------------------------------- the log

def turn_events(turns: DataFrame, chars: int = DELTA_CHARS) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as the log that streamed
    it: user and other turns in one event, assistant texts as deltas."""
    rows = take_columns(turns, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("seq"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().cast("string").alias("message"))   # by place in the files: retries agree
    event = lambda kind, at, text: F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at"), text.alias("text"))
    deltas = F.transform(F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(chars)),
                         lambda at: event("delta", at, F.substring("text", at + 1, F.lit(chars))))
    events = F.when(F.col("role") == "assistant",
                    F.concat(F.array(event("message", F.lit(-1), F.lit(""))), deltas)
                    ).otherwise(F.array(event("message", F.lit(-1), F.col("text"))))
    return rows.select("conv_id", "message", "seq", "role", F.explode(events).alias("event")).select(
        "conv_id", "message", "seq", "event.kind", "role", "event.text", "event.at")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, start, role, text) of a log. ``at``,
    where the log has it, orders events of one sequence number and kind."""
    workers_can_import(events.sparkSession)
    at = F.col("at").cast("bigint") if "at" in events.columns else F.lit(0).cast("bigint")
    unknown = F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))).cast("int")
    order = F.coalesce(*[F.when(F.col("kind") == k, i) for i, k in enumerate(KINDS)], unknown)
    rows = take_columns(events.withColumn("at", at), *EVENTS, "at").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("message").cast("string").alias("message"),
        F.col("seq").cast("bigint").alias("seq"), order.alias("kind"), "at",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, redone, role, pieces = None, None, None, "", []

        def message():
            return (*key, start, redone, role, "".join(pieces))

        for batch in batches:
            done = []
            for conv_id, name, seq, kind, event_role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (conv_id, name):
                    if start is not None:
                        done.append(message())
                    key, start, redone, role, pieces = (conv_id, name), None, None, "", []
                if kind == 0:
                    redone, pieces = seq, []
                elif kind == 1:
                    start, role, pieces = seq if start is None else start, event_role, [text]
                elif kind == 2:
                    pieces = [text]
                else:
                    pieces.append(text)
            yield from _batch(done, MESSAGES)
        if start is not None:
            yield from _batch([message()], MESSAGES)

    folded = landed(rows.repartition(shuffle_partitions(events.sparkSession), "conv_id", "message")
                    .sortWithinPartitions("conv_id", "message", "seq", "kind", "at", "text")
                    .select("conv_id", "message", "seq", "kind", "role", "text").mapInArrow(run, MESSAGES), "chat-folded")
    return _without_superseded(folded)


def _without_superseded(folded: DataFrame) -> DataFrame:
    """Messages that no regeneration drops. Only the small columns of the
    conversations that have a regeneration are compared."""
    places = folded.select("conv_id", "message", "start", "redone")
    redone = places.where("redone IS NOT NULL")
    same = lambda a, b, *names: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    spans = redone.select("conv_id", F.lit(None).cast("string").alias("message"), "start", F.col("redone").alias("until"))
    near = (places.alias("s").join(redone.select("conv_id").distinct().alias("r"), same("s", "r", "conv_id"), "left_semi")
            .select("conv_id", "message", "start", F.lit(None).cast("bigint").alias("until")))
    earlier = Window.partitionBy("conv_id").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    dropped = (near.unionByName(spans)
               .withColumn("covered", F.max("until").over(earlier))
               .where((F.col("covered") > F.col("start")) & F.col("until").isNull()))
    return (folded.alias("f").join(dropped.alias("d"), same("f", "d", "conv_id", "message"), "left_anti")
            .select("conv_id", "message", "start", "role", "text"))


# ---------------------------------------------------------------------- the output

def _batch(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if k == "bigint" else pa.string()) for c, k in zip(zip(*rows), kinds)], names=names)


def render(messages: DataFrame) -> DataFrame:
    """One rendered turn a row."""
    workers_can_import(messages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batch([(conv_id, start, role, *render_turn(role, text)) for conv_id, start, role, text
                               in zip(*(c.to_pylist() for c in batch.columns))], TURNS)
    return messages.select("conv_id", "start", "role", "text").mapInArrow(run, TURNS)


def write_chat(events: DataFrame, path: str) -> DataFrame:
    """Fold a log, write its rendered turns to ``path`` in order, read them."""
    spark = events.sparkSession
    (render(fold(events)).repartitionByRange(shuffle_partitions(spark), "conv_id", "start")
     .sortWithinPartitions("conv_id", "start", "role", "formatted").write.mode("overwrite").parquet(path))
    return spark.read.schema(TURNS).parquet(path)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its rendered turns. A digest
    is sequential, so a conversation is one task's; rows stream through it and
    only the running hashes are held."""
    workers_can_import(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None

        def digests():
            n, all_turns, chars, loss, formatted = sums
            return at[0], n, all_turns.hexdigest(), chars, loss.hexdigest(), formatted

        for batch in batches:
            done = []
            for conv_id, formatted, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (conv_id,):
                    if at:
                        done.append(digests())
                    at, sums = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(formatted)
                sums[0] += 1
                sums[1].update(f"{role}\n{text}\n".encode())
                if end > begin:
                    masked = unescape(formatted[begin:end])
                    sums[2] += len(masked)
                    sums[3].update(masked.encode())
                sums[4] += len(formatted)
            yield from _batch(done, DIGESTS)
        if at:
            yield from _batch([digests()], DIGESTS)

    return (turns.repartition(shuffle_partitions(turns.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "start", "role", "formatted")
            .select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, DIGESTS))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Format a table of turns, and conversation -1 that says control strings,
    and read every conversation back from the files."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = take_columns(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return read_back(write_chat(turn_events(rows.unionByName(probe)), scratch_path(spark, "chat-turns")))
