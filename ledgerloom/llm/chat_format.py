"""Chat formatting from an event log.

A conversation is a log of events by sequence number: a message starts, text is streamed to it in deltas, it is edited
(its text so far is replaced) or regenerated (its text so far is void). Folding them gives the final
messages: of each message, the deltas after its last edit or regeneration, behind the edit's text.

The fold is per message, not per conversation: the last reset of each message is one aggregate, the deltas behind
it are another, both combined before the shuffle. Only the finished messages of a conversation meet, because they are
one output text.

Template: `<role>`, a newline, the text, `</turn>`, a newline. Inside texts and roles a backslash is doubled and every `<` becomes `<\\.`;
inside roles a newline becomes `<\\n`. So no mark of the template can occur there, and all of it is undone when the
output is read back. The loss mask covers assistant texts: spans (turn, start, length) in code points of that turn's
part of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import computed, text_of

OPEN, CLOSE, END = "<", ">\n", "</turn>\n"
#: characters of a streamed delta
DELTA = 200


def escape(text: Column) -> Column:
    """Every `<` is followed by a backslash, and other backslashes come in pairs."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("<\\."))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape(text: Column) -> Column:
    """Undoes both: what stands behind a `<` tells which."""
    return F.replace(F.replace(F.replace(text, F.lit("<\\n"), F.lit("\n")), F.lit("<\\."), F.lit("<")), F.lit("\\\\"), F.lit("\\"))


def events_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", delta: int = DELTA) -> DataFrame:
    """A log (conv, message, seq, event, role, text) whose fold is the given turns.

    Every turn starts with a draft, which an assistant regenerates and another role edits away, and then streams its text in
    deltas. Numbers go through the whole conversation, and its messages interleave: all start before the first delta, and a message
    is edited when later ones have text already. Turns are ordered by number, then role, then a hash of the text; NULL texts and roles are empty.
    """
    told = text_of(text)
    base = rows.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), text_of(role).alias("role"), told.alias("text")).alias("message"))
    # equal rows are messages of their own
    counted = base.groupBy("conv", "message").agg(F.count(F.lit(1)).alias("n"))
    each = counted.select("conv", "message", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    key = F.struct("message.turn", "message.role", F.xxhash64("message.text").alias("text"), "copy")
    each = each.select("conv", key.alias("key"), F.col("message.role").alias("role"), F.col("message.text").alias("told"))
    said, assistant = F.col("told"), F.col("role") == "assistant"
    event = lambda kind, t: F.struct(F.lit(kind).alias("event"), t.alias("text"))
    # an edit already holds the first character
    piece = lambda s: F.when(assistant | (s > 0), F.substring(said, s + 1, F.lit(delta))).otherwise(F.substring(said, s + 2, F.lit(delta - 1)))
    starts = F.sequence(F.lit(0), F.greatest(F.length(said) - 1, F.lit(0)), F.lit(delta))
    reset = F.when(assistant, event("regenerate", F.lit(""))).otherwise(event("edit", F.substring(said, 1, 1)))
    draft = F.array(event("start", F.lit("")), event("delta", F.substring(F.reverse(said), 1, delta)), reset)
    log = F.concat(draft, F.transform(starts, lambda s: event("delta", piece(s))))
    return each.select("conv", F.col("key").alias("message"), "role", F.posexplode(log).alias("at", "e")).select(
        "conv", "message", _number(F.col("at"), F.col("message")).alias("seq"), "role", "e.event", "e.text")


def _number(at: Column, message: Column) -> Column:
    """Number in the conversation of a message's event: first the first events of all messages, then the second ones."""
    return F.shiftleft(at.cast("bigint"), 31) + F.pmod(F.xxhash64(message), F.lit(1 << 31))


def fold(log: DataFrame) -> DataFrame:
    """(conv, message, role, text) of every started message, from (conv, message, seq, event, role, text).

    Events: start (gives the role), delta (appends), edit (replaces), regenerate (voids). Events of one message are
    taken by seq, ties by event and text; an event told again, equal in message, seq, event and text, counts once. NULL texts add
    nothing, unknown events do nothing, and a message that never starts has the role of none.
    """
    at = F.struct("seq", "event", "text")
    reset = F.col("event").isin("edit", "regenerate")
    last = log.groupBy("conv", "message").agg(
        F.max(F.when(reset, at)).alias("reset"), F.max(F.when(F.col("event") == "start", F.col("role"))).alias("role"))
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & a["message"].eqNullSafe(b["message"])
    deltas = log.filter("event = 'delta'")
    live = deltas.join(last, same(deltas, last)).filter(F.col("reset").isNull() | (deltas["seq"] > F.col("reset.seq"))).select(
        deltas["conv"], deltas["message"], deltas["seq"], deltas["text"])
    tail = live.groupBy("conv", "message").agg(F.array_join(F.transform(
        F.array_sort(F.collect_set(F.struct("seq", "text"))), lambda d: F.coalesce(d["text"], F.lit(""))), "").alias("tail"))
    head = F.when(F.col("reset.event") == "edit", F.coalesce("reset.text", F.lit(""))).otherwise("")
    return last.join(tail, same(last, tail), "left").select(
        last["conv"], last["message"], F.coalesce("role", F.lit("")).alias("role"), F.concat(head, F.coalesce("tail", F.lit(""))).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv, formatted, loss) of every conversation; its messages are in the order of `message`."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(CLOSE))
    part = messages.select("conv", "message", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    whole = part.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("message", "head", "body", "learn"))).alias("parts"))
    span = lambda p, i: F.when(p["learn"], F.struct(
        i.alias("turn"), F.length(p["head"]).alias("start"), F.length(p["body"]).alias("length")))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return computed(whole, {"formatted": text, "loss": F.array_compact(F.transform("parts", span))}).drop("parts")


def format_log(log: DataFrame) -> DataFrame:
    """(conv, formatted, loss) of the conversations of an event log, see `fold` and `render`.

    Logs may hold NULL conversations, which are one. An empty log gives no rows. Other columns are not read.
    """
    return render(fold(log))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, turns, learned, formatted): what the output says, (role, text) by turn and the texts under the loss mask."""
    cut = computed(formatted, {"pieces": F.split("formatted", END, -1)})
    turn = lambda t: F.struct(
        unescape(F.substring(t, len(OPEN) + 1, F.locate(CLOSE, t) - len(OPEN) - 1)).alias("role"),
        unescape(F.substring(t, F.locate(CLOSE, t) + len(CLOSE), F.length(t))).alias("text"))
    # behind the last mark stands nothing
    turns = F.transform(F.slice("pieces", 1, F.size("pieces") - 1), turn)
    learned = F.transform("loss", lambda s: unescape(F.substring(F.get("pieces", s["turn"]), s["start"] + 1, s["length"])))
    return computed(cut, {"turns": turns, "learned": learned}).select("conv", "turns", "learned", "formatted")
