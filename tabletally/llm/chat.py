"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events. Each event has a conversation, a sequence
number, a message id and a kind:

``message``     opens the message with a role and a first text
``delta``       appends a streamed piece of text
``edit``        replaces the text so far
``regenerate``  drops the text so far; the deltas after it build the new one
``delete``      removes the message for good

``fold_events`` groups the log by (conversation, message), sorts it by sequence
and folds it to the final messages. Messages fold independently, so a
conversation with a third of all events is spread over many tasks.
``render`` turns each message into one piece of the training text; a
conversation is its pieces in order, so no row holds a whole conversation.

Template. Turns are marked by control strings::

    user       [INST]text[/INST]
    assistant  <s>text</s>
    system     [SYS]text[/SYS]
    others     [ROLE]role[/ROLE][MSG]text[/MSG]

Inside texts and role names every control string gets a backslash after its
first character (``[\\INST]``), one more if it has some already. Unescaping
takes one away, so any text comes back exactly, and an unescaped control string
in the output is always a mark of the template. The loss mask covers assistant
texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Fixed values of the template.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
ROLE_MARK = ("[ROLE]", "[/ROLE]")
OTHER_MARK = ("[MSG]", "[/MSG]")
_BODY = r"/?(?:s>|(?:INST|SYS|ROLE|MSG)\])"
ESCAPE = rf"([\[<])(\\*)({_BODY})"
UNESCAPE = rf"([\[<])\\(\\*{_BODY})"
MARK = rf"([\[<]{_BODY})"

EVENT_KINDS = ("message", "delta", "edit", "regenerate", "delete")
RESETS = ("message", "edit", "regenerate")


def fold_events(events: DataFrame, conv: str = "conv_id", message: str = "message_id", seq: str = "seq") -> DataFrame:
    """Events -> one row per surviving message: conv, message, position, role, text.

    ``position`` is the sequence number of the message's first event. The text
    is what stands after the last reset (message, edit, regenerate), then all
    deltas in order. Equal sequence numbers are ordered by kind, then text.

    Defined cases: a null text counts as empty; a null role as the empty role;
    null conversations form one conversation; unknown kinds are ignored; a
    message that only has deltas has the empty role; no events, no rows.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in EVENT_KINDS]), F.col("kind"))
    event = F.struct(
        F.col(seq).alias("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("kind").alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
    )
    log = F.col("_log")
    last = F.array_max(F.transform(log, lambda e, i: F.when(e["kind"].isin(*RESETS), i).otherwise(0)))
    text = F.array_join(F.transform(F.filter(log, lambda e, i: i >= F.col("_last")), lambda e: e["text"]), "")
    opened = F.try_element_at(F.filter(log, lambda e: e["kind"] == "message"), F.lit(1))
    return (
        events.where(F.col("kind").isin(*EVENT_KINDS))
        .groupBy(conv, message)
        .agg(F.sort_array(F.collect_list(event)).alias("_log"))
        .where(~F.exists(log, lambda e: e["kind"] == "delete"))
        .withColumn("_last", last)
        .select(
            conv, message, log[0]["seq"].alias("position"),
            F.coalesce(opened["role"], F.lit("")).alias("role"), text.alias("text"),
        )
    )


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def render(messages: DataFrame) -> DataFrame:
    """Adds ``formatted`` (the message's piece of the output) and the loss mask
    ``loss_start``, ``loss_end`` (code points within the piece; equal: no loss)."""
    role, body = F.col("role"), escaped(F.col("text"))
    known = role.isin(*MARKS)
    begin = F.concat(F.lit(ROLE_MARK[0]), escaped(role), F.lit(ROLE_MARK[1] + OTHER_MARK[0]))
    end = F.lit(OTHER_MARK[1])
    for name, (a, b) in MARKS.items():
        begin, end = F.when(role == name, a).otherwise(begin), F.when(role == name, b).otherwise(end)
    start = F.when(known & (role == "assistant"), F.length(begin)).otherwise(0)
    return (
        messages.withColumn("_body", body)
        .withColumn("formatted", F.concat(begin, F.col("_body"), end))
        .withColumn("loss_start", start)
        .withColumn("loss_end", start + F.when(role == "assistant", F.length("_body")).otherwise(0))
        .drop("_body")
    )


def parse(formatted: str) -> Iterator[tuple[str, str, bool]]:
    """Formatted text -> (role, text, under the loss mask) per turn; the inverse of ``render``."""
    openings = {begin: role for role, (begin, _) in MARKS.items()}
    parts, role = re.split(MARK, formatted), None
    for mark, inner in zip(parts[1::2], parts[2::2], strict=True):
        if mark == ROLE_MARK[0]:
            role = re.sub(UNESCAPE, r"\1\2", inner)
        elif mark in openings or mark == OTHER_MARK[0]:
            yield openings.get(mark, role), re.sub(UNESCAPE, r"\1\2", inner), mark == MARKS["assistant"][0]


def read_back(pieces: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation, what its formatted pieces say when parsed and unescaped.

    Pieces are sorted by (conversation, position) and streamed: a task holds
    one batch of pieces and the running digests, never a whole conversation.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv: list = []  # the conversation being read: id, turns, digest, loss, digest, characters

        def closed(convs: list[list]) -> pa.RecordBatch:
            rows = [(c, n, turns.hexdigest(), loss, masked.hexdigest(), chars) for c, n, turns, loss, masked, chars in convs]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, t) for column, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
            )

        for batch in batches:
            done = []
            for c, formatted, start, end in zip(*(batch[k].to_pylist() for k in columns), strict=True):
                if not open_conv or c != open_conv[0]:
                    if open_conv:
                        done.append(open_conv)
                    open_conv = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _ in parse(formatted):
                    open_conv[1] += 1
                    open_conv[2].update(f"{role}\n{text}\n".encode())
                masked = re.sub(UNESCAPE, r"\1\2", formatted[start:end])
                open_conv[3] += len(masked)
                open_conv[4].update(masked.encode())
                open_conv[5] += len(formatted)
            if done:
                yield closed(done)
        if open_conv:
            yield closed([open_conv])

    columns = ("_conv", "formatted", "loss_start", "loss_end")
    return (
        pieces.select(F.col(conv).alias("_conv"), "position", "message_id", "formatted", "loss_start", "loss_end")
        .repartition("_conv")
        .sortWithinPartitions("_conv", "position", "message_id")
        .mapInArrow(
            digests,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )


def events_of_rows(conversations: DataFrame) -> DataFrame:
    """A table with one row per turn, as an event log: each row opens its own message.

    Rows that repeat a turn number stay turns of their own, ordered by role and
    text. Equal rows are told apart by a running number.
    """
    same = ["conv_id", "turn", "role", "text"]
    return (
        conversations.groupBy(*same).count()
        .select(*same, F.explode(F.sequence(F.lit(1), F.col("count"))).alias("_copy"))
        .select(
            "conv_id",
            F.col("turn").alias("seq"),
            F.struct("turn", "role", "text", "_copy").alias("message_id"),
            F.lit("message").alias("kind"), "role", "text",
        )
    )


def op1_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the planted conversation -7, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    messages = fold_events(events_of_rows(rows))
    return read_back(render(messages))


OP1_SQL = r"""
WITH said AS (SELECT '</s>[INST] ok [/INST]' AS t),
c AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', t FROM said
    UNION ALL SELECT -7, 1, 'assistant', t FROM said),
m AS (
    SELECT conv_id, turn, role AS r, text AS x, coalesce(role, '') AS role, coalesce(text, '') AS text,
           length(regexp_replace(coalesce(text, ''), '([\[<])(\\*)(/?(?:s>|(?:INST|SYS|ROLE|MSG)\]))', '\1\2\\\3', 'g')) AS chars,
           length(regexp_replace(coalesce(role, ''), '([\[<])(\\*)(/?(?:s>|(?:INST|SYS|ROLE|MSG)\]))', '\1\2\\\3', 'g')) AS role_chars
      FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r NULLS FIRST, x NULLS FIRST)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, r NULLS FIRST, x NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
                        ELSE 24 + role_chars END) AS BIGINT) AS formatted_chars
  FROM m GROUP BY conv_id
"""
