"""Chat formatting from an event log: fold deltas, edits and regenerations into messages, then render.

Events: conv_id, turn, message, seq, kind, role, text. A message's events in order of
seq: ``start`` names its role and begins it empty; ``delta`` adds text; ``regenerate``
drops what was streamed; ``edit`` puts its text in place of all before; ``delete``
leaves the message out. Events are dealt by (conversation, message), so one very long
conversation does not meet in a task until its final messages are read in order.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each message. Inside role and
text every ``<|`` (also one already escaped, ``<\\|``, ``<\\\\|``, ...) gets one more
backslash before its bar, so no control string is left and the escape can be undone.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

BEGIN, FINISH = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: Characters of one streamed delta in the log made from a table of messages.
DELTA = 512


def escaped(c):
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescaped(c):
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def _role_out(c):
    """A role keeps to one line: line feeds and per cent signs are spelled out."""
    return escaped(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(c):
    return F.replace(F.replace(unescaped(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def event_log(messages: DataFrame, *, delta: int = DELTA) -> DataFrame:
    """The events that lead to ``messages`` (conv_id, turn, role, text).

    Every text is streamed in deltas; an assistant's is first begun, dropped and
    regenerated; a system's is streamed in part and then edited into place. Null roles
    and texts are empty. Rows of one conversation with the same turn are ordered by role
    and text's digest; equal rows are as many messages.
    """
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    m = m.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    m = m.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    m = m.withColumn("message", F.concat("role", F.lit("\0"), F.md5("text"), F.lit("\0"), F.format_string("%020d", "copy")))
    n = F.ceil(F.length("text") / delta).cast("int")
    cuts = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("text"), i * delta + 1, F.lit(delta))))
    cuts = F.coalesce(cuts, F.array().cast("array<string>"))

    def event(kind, text):
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    def deltas(texts):
        return F.transform(texts, lambda t: event("delta", t))

    draft = F.array(event("delta", F.substring("text", 1, 16)))
    streamed = (
        F.when(F.col("role") == LOSS_ROLE, F.concat(draft, F.array(event("regenerate", F.lit(""))), deltas(cuts)))
        .when(F.col("role") == "system", F.concat(draft, F.array(event("edit", F.col("text")))))
        .otherwise(deltas(cuts))
    )
    events = F.concat(F.array(event("start", F.lit(""))), streamed)
    return m.select("conv_id", "turn", "message", "role", F.posexplode(events).alias("seq", "event")).select("conv_id", "turn", "message", F.col("seq").cast("long"), "event.kind", "role", "event.text")


def folded(events: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text): the messages as their events leave them.

    Events before a message's last start, edit or regenerate are dropped before texts are
    put together. Unknown kinds and null texts add nothing; events of one message with
    the same seq are taken in order of kind and text; repeated ones count each.
    """
    whole = F.col("kind").isin("start", "edit", "regenerate")
    own = Window.partitionBy("conv_id", "turn", "message")
    marked = events.withColumn("last", F.max(F.when(whole, F.col("seq"))).over(own)).withColumn("gone", F.max((F.col("kind") == "delete").cast("int")).over(own))
    live = marked.where("coalesce(gone, 0) = 0").where(F.col("last").isNull() | (F.col("seq") >= F.col("last")) | (F.col("kind") == "start"))
    text = F.when(F.col("kind").isin("edit", "delta") & (F.col("last").isNull() | (F.col("seq") >= F.col("last"))), F.coalesce("text", F.lit(""))).otherwise(F.lit(""))
    parts = F.array_sort(F.collect_list(F.struct("seq", F.col("kind"), text.alias("text"))))
    return live.groupBy("conv_id", "turn", "message").agg(
        F.max_by("role", F.when(F.col("kind") == "start", F.col("seq"))).alias("role"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
    )


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, message, formatted, loss_from, loss_length): each message under the template.

    A conversation's output is its messages' ``formatted`` in order of turn and message.
    The loss mask covers ``loss_length`` characters of it from ``loss_from`` on: an
    assistant's escaped text, nothing of others.
    """
    role, text = _role_out(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(BEGIN), role, F.lit("\n"))
    loss = F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False))
    return messages.select(
        "conv_id", "turn", "message", F.concat(head, text, F.lit(FINISH + "\n")).alias("formatted"),
        F.when(loss, F.length(head)).otherwise(0).alias("loss_from"), F.when(loss, F.length(text)).otherwise(0).alias("loss_length"),
    )


def read_back(output: DataFrame) -> DataFrame:
    """(conv_id, turn, message, role, text, loss_text, chars): what the rendered output says."""
    body = F.substr("formatted", F.lit(len(BEGIN) + 1), F.length("formatted") - len(BEGIN + FINISH) - 1)
    role = F.substring_index(body, "\n", 1)
    masked = F.substr("formatted", F.col("loss_from") + 1, F.col("loss_length"))
    return output.select(
        "conv_id", "turn", "message", _role_in(role).alias("role"),
        unescaped(F.substr(body, F.length(role) + 2)).alias("text"), unescaped(masked).alias("loss_text"), F.length("formatted").cast("long").alias("chars"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Messages stream through the hashes in order, so memory does not grow with a
    conversation; a SHA-256 is sequential, so one conversation is one task's work.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches):
        open_id, state = None, None

        def closed():
            n, text_hash, loss_n, loss_hash, chars = state
            return (open_id[0], n, text_hash.hexdigest(), loss_n, loss_hash.hexdigest(), chars)

        for batch in batches:
            rows = []
            for conv, role, text, loss, chars in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if open_id != (conv,):
                    if open_id is not None:
                        rows.append(closed())
                    open_id, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            yield _rows(rows, batch.schema.field(0).type)
        if open_id is not None:
            yield _rows([closed()], batch.schema.field(0).type)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "message")
    return arrow_map(ordered.select("conv_id", "role", "text", "loss_text", "chars"), run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _rows(rows, kind):
    types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))


def formatted_digests(events: DataFrame) -> DataFrame:
    """Fold, render, read back and digest an event log; rows without a conv_id are one conversation, null."""
    return digests(read_back(rendered(folded(events))))
