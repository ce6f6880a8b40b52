"""Chat formatting by event sourcing: logs of conversations become final messages, then training text.

A log has one row per event: ``conv_id, seq, kind, message, role, text``.

* ``message``: a whole message, one row, complete in itself; ``message`` (the id) is not needed;
* ``open`` starts message ``message`` with a role, ``delta`` appends streamed text to it;
* ``edit`` replaces its text, ``regenerate`` empties it for the deltas that follow;
* ``retract`` removes it.

Streamed messages are folded by (conversation, message): everything before the last ``open``,
``edit`` or ``regenerate`` is void, and the rest is joined in order of ``seq``.  No step gathers a
conversation: its messages stay rows.  The rendered text of a conversation is the concatenation
of its ``rendered`` column in order of ``place``; ``loss_from`` and ``loss_length`` mark, in each row, the
part trained on (code points), which is the assistant's escaped text.

The template is ``### <Role>: <text> </turn>\\n``.  In texts and roles a backslash is put before
every backslash, ``#`` and ``<``, in roles also before ``:``, so that no control string can appear inside them.

Defined results: null text and null role are empty; equal seq: order by kind, role and text;
equal rows of kind ``message`` are turns of their own; null conv_id and null seq sort first and make a
conversation of their own; events of a message that was never opened have an empty role; unknown kinds are
an error; an empty log gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("message", "open", "delta", "edit", "regenerate", "retract")
HEAD, AFTER_ROLE, END = "### ", ": ", " </turn>\n"
TRAINED = "assistant"


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text, at): final messages; ``seq`` is where a message began."""
    kind = F.coalesce(F.col("kind"), F.lit("?"))
    checked = log.select("conv_id", "seq", F.when(kind.isin(*KINDS), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown event kind "), kind))).alias("kind"), "message", "role",
        F.coalesce("text", F.lit("")).alias("text"))
    whole = checked.where("kind = 'message'").select("conv_id", "seq", F.coalesce("role", F.lit("")).alias("role"), "text")
    order = F.struct("seq", F.array_position(F.lit(list(KINDS)), F.col("kind")), "text")
    streamed = checked.where("kind != 'message'").withColumn("_order", order)
    by = ["conv_id", "message"]
    reset = streamed.groupBy(*by).agg(
        F.max(F.when(F.col("kind").isin("open", "edit", "regenerate"), F.col("_order"))).alias("_reset"),
        F.max(F.when(F.col("kind") == "retract", F.col("_order"))).alias("_gone"),
        F.min("seq").alias("_began"),
        F.max_by("role", F.when(F.col("kind") == "open", F.col("_order"))).alias("_role"))
    alive = reset.where(F.col("_gone").isNull() | (F.col("_reset") > F.col("_gone")))
    alive = alive.select(F.col("conv_id").alias("_conv"), F.col("message").alias("_message"), "_reset", "_began", "_role")
    parts = (
        streamed.join(alive, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("message").eqNullSafe(F.col("_message")))
        .where(F.col("_reset").isNull() | (F.col("_order") >= F.col("_reset"))).where("kind != 'retract'")
    )
    piece = F.struct("_order", F.when(F.col("kind") == "regenerate", "").otherwise(F.col("text")).alias("t"))
    joined = parts.groupBy("conv_id", "message", "_began", "_role").agg(F.sort_array(F.collect_list(piece)).alias("_all"))
    made = joined.select("conv_id", F.col("_began").alias("seq"), F.coalesce("_role", F.lit("")).alias("role"),
                         F.array_join(F.transform("_all", lambda x: x["t"]), "").alias("text"))
    return whole.union(made)


def escaped(text: Column, signs: str = r"\\#<") -> Column:
    return F.regexp_replace(text, f"[{signs}]", r"\\$0")


def render(messages: DataFrame, trained: str = TRAINED) -> DataFrame:
    """(conv_id, place, rendered, loss_from, loss_length) for final messages (conv_id, seq, role, text).

    ``place`` is a struct that orders the messages of a conversation.
    """
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), r"\\#<:"), F.lit(AFTER_ROLE))
    body = escaped(F.col("text"))
    return messages.select(
        "conv_id", F.struct("seq", "role", "text").alias("place"), F.concat(head, body, F.lit(END)).alias("rendered"),
        F.length(head).cast("long").alias("loss_from"),
        F.when(F.col("role") == trained, F.length(body)).otherwise(0).cast("long").alias("loss_length"))


def format_chats(log: DataFrame) -> DataFrame:
    """The whole way: fold the log, then render it."""
    return render(fold(log))


_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*) </turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def _plain(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its rendered text and loss mask alone.

    Rows of a conversation stream through one task in order, since a digest is sequential; the
    task holds one batch of rows and the running digests, not the conversation.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def close():
            if state is not None:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], f.type) for k, f in enumerate(schema)], schema=schema)
            done.clear()
            return out

        for batch in batches:
            for conv, text, low, size in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_from", "loss_length")]):
                if state is None or conv != key:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                match = _TURN.fullmatch(text)
                if match is None:
                    raise ValueError(f"conversation {conv}: a turn cannot be read back")
                state[0] += 1
                state[1].update(f"{_plain(match[1])}\n{_plain(match[2])}\n".encode())
                if size:
                    loss = _plain(text[low: low + size])
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += len(text)
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return (
        formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "place", "rendered", "loss_from", "loss_length")
        .repartition("conv_id").sortWithinPartitions("conv_id", "place").drop("place")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
