"""Chat formatting: conversations rebuilt from an event log, then rendered.

The log has rows (conv_id, seq, kind, msg, role, text):

* ``message`` and ``delta`` append their text to message ``msg`` (streamed parts);
* ``edit`` replaces the text that message ``msg`` has so far;
* ``regenerate`` discards message ``msg`` and all later ones; what follows builds them anew.

The log is partitioned by conversation and sorted by sequence.  The fold is a set of running
windows: an event is live unless a later regeneration reaches back to its message or a later
edit replaces it, and a message is its live parts in order.  Spark's windows spill, so a
conversation need not fit in memory; only one message must.

Rendering is per message.  The template marks turns with control strings; a control string
inside a text is broken by a backslash after its first character, and backslashes are
doubled, so ``unescape`` gives the text back.  The loss mask is a span of the rendered
message: an assistant's text.

Defined cases.  Null texts and roles are empty, and ill-formed parts of them
U+FFFD.  A null conv_id is a conversation of its
own; a null seq or msg comes first.  Events with equal seq are ordered by kind, msg, role
and text, and repeated rows count as often as they occur.  An empty log gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's control strings, and those of other public templates.
BEGIN, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """``text`` without any control string, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def fold(log: DataFrame) -> DataFrame:
    """conv_id, msg, role and text of the final messages of an event log."""
    tie = [F.col(c).asc_nulls_first() for c in ("kind", "msg", "role", "text")]
    conv = Window.partitionBy("conv_id")
    forward = conv.orderBy(F.col("seq").asc_nulls_first(), *tie)
    numbered = log.select("conv_id", "seq", "kind", F.coalesce("msg", F.lit(-1)).cast("bigint").alias("msg"),
                          F.make_valid_utf8(F.coalesce("role", F.lit(""))).alias("role"),
                          F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text"))
    numbered = numbered.withColumn("n", F.row_number().over(forward))
    later = conv.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    back_to = F.min(F.when(F.col("kind") == "regenerate", F.col("msg"))).over(later)
    live = numbered.withColumn("back_to", back_to).filter(
        (F.col("kind") != "regenerate") & (F.col("back_to").isNull() | (F.col("msg") < F.col("back_to"))))
    # in descending order: what comes after the newest edit has no edit above it
    edits = Window.partitionBy("conv_id", "msg").orderBy(F.col("n").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    live = live.withColumn("edited", F.max(F.col("kind") == "edit").over(edits)).filter(
        ~F.coalesce("edited", F.lit(False)))
    parts = F.sort_array(F.collect_list(F.struct("n", "text")))
    return live.groupBy("conv_id", "msg").agg(
        F.min_by("role", "n").alias("role"),
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, msg, formatted, loss_from, loss_to: every message in the template, with the
    span of its characters that the loss counts (empty but for the trained role)."""
    head = F.concat(F.lit(BEGIN), escaped(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    trained = F.col("role") == TRAINED_ROLE
    return messages.select(
        "conv_id", "msg", F.concat(head, body, F.lit(END)).alias("formatted"),
        F.length(head).alias("loss_from"),
        F.when(trained, F.length(head) + F.length(body)).otherwise(F.length(head)).alias("loss_to"))


_TURN = re.compile(re.escape(BEGIN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END), re.DOTALL)


def digests(rendered: DataFrame) -> DataFrame:
    """Reads the rendered messages back: one row of counts and digests per conversation.

    Rows come sorted; a task streams them and holds one message and two hash states.
    """
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint")

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        state, done = None, []

        def close(s):
            done.append((s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]))

        for pdf in frames:
            for conv, missing, text, a, b in zip(pdf["conv_id"], pdf["missing"], pdf["formatted"],
                                                 pdf["loss_from"], pdf["loss_to"], strict=True):
                conv = None if missing else int(conv)
                if state is None or state[0] != conv:
                    if state is not None:
                        close(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in _TURN.findall(text):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                masked = unescape(text[a:b])
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(text)
            if done:
                yield _frame(pd, done)
                done = []
        if state is not None:
            close(state)
            yield _frame(pd, done)

    # F.hash gives null conversations a place of their own as well
    sorted_rows = rendered.withColumn("missing", F.col("conv_id").isNull()).withColumn(
        "conv_id", F.coalesce("conv_id", F.lit(0))).repartition("conv_id", "missing") \
        .sortWithinPartitions("conv_id", "missing", "msg")
    return sorted_rows.mapInPandas(run, schema)


def _frame(pd, rows):
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                      "loss_sha256", "formatted_chars"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): one message each."""
    order = Window.partitionBy("conv_id").orderBy(
        *[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    n = F.row_number().over(order)
    return turns.select("conv_id", n.alias("seq"), F.lit("message").alias("kind"), n.alias("msg"),
                        "role", "text")
