"""A conversation's state over its turns: what is planned and used, and limits that grow while something is left.

Events (conv_id, seq, event, tool) come one after the other: ``plan`` names a planned endpoint (before all others), ``use`` one that is called,
``ask`` and ``answer`` open and close a question to the user, ``turn`` and ``message`` count, and ``look`` asks for the status. A look gives
conv_id, seq, status, max_messages, max_turns, completed, remaining, unplanned. Of n planned endpoints follow the limits: n + 2 turns and 4n + 4
messages at first, and 5n + 6 messages at most. A look while something is left adds 4 messages within two of their limit, and
a turn within one of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT = "conv_id long, seq long, event string, tool string"
LOOK = "seq: long, status: string, max_messages: int, max_turns: int, completed: int, remaining: int, unplanned: int"
STATE = "planned array<string>, used array<string>, asked boolean, turn int, messages int, more_messages int, more_turns int"


def look(seq: Column, s: Column) -> Column:
    """The status of a state, and how it changes the limits."""
    n = F.size(s["planned"])
    left = F.size(F.array_except(s["planned"], s["used"]))
    open_ = ~s["asked"] & (s["messages"] < 5 * n + 6) & (left > 0)
    messages, turns = 4 * n + 4 + s["more_messages"], n + 2 + s["more_turns"]
    grown_messages = F.when(open_ & (s["messages"] >= messages - 2), messages + 4).otherwise(messages)
    grown_turns = F.when(open_ & (s["turn"] >= turns - 1), turns + 1).otherwise(turns)
    status = F.when(s["asked"], "in_progress").when(s["messages"] >= 5 * n + 6, "done").when(left > 0, "in_progress").otherwise("completing")
    done = F.size(F.array_intersect(s["planned"], s["used"]))
    return F.struct(seq.alias("seq"), status.alias("status"), grown_messages.alias("max_messages"), grown_turns.alias("max_turns"), done.alias("completed"), left.alias("remaining"), F.size(F.array_except(s["used"], s["planned"])).alias("unplanned"))


def after(s: Column, e: Column) -> Column:
    """The state after an event; looks only change limits."""
    is_ = lambda x: e["event"] == x
    grow = lambda x, name, step: F.when(is_(x), s[name] + step).otherwise(s[name]).alias(name)
    seen = look(e["seq"], s)
    n = F.size(s["planned"])
    return F.struct(
        F.when(is_("plan"), F.array_append(s["planned"], e["tool"])).otherwise(s["planned"]).alias("planned"),
        F.when(is_("use") & ~F.array_contains(s["used"], e["tool"]), F.array_append(s["used"], e["tool"])).otherwise(s["used"]).alias("used"),
        F.when(is_("ask"), True).when(is_("answer"), False).otherwise(s["asked"]).alias("asked"),
        grow("turn", "turn", 1), grow("message", "messages", 1),
        F.when(is_("look"), seen["max_messages"] - (4 * n + 4)).otherwise(s["more_messages"]).alias("more_messages"),
        F.when(is_("look"), seen["max_turns"] - (n + 2)).otherwise(s["more_turns"]).alias("more_turns"),
    )


def _start() -> Column:
    none = F.array().cast("array<string>")
    return F.struct(none.alias("planned"), none.alias("used"), F.lit(False).alias("asked"), *[F.lit(0).alias(c) for c in ("turn", "messages", "more_messages", "more_turns")])


def _ordered(events: DataFrame) -> DataFrame:
    return events.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seq", "event", "tool"))).alias("e"))


def states(events: DataFrame) -> DataFrame:
    """conv_id, status, planned, used, asked: each conversation after all its events."""
    folded = _ordered(events).select("conv_id", F.aggregate("e", _start(), after).alias("s"))
    return folded.select("conv_id", look(F.lit(0), F.col("s"))["status"].alias("status"), "s.planned", "s.used", "s.asked")


def looks(events: DataFrame) -> DataFrame:
    """The looks of whole conversations: one fold over each one's events, without Python."""
    rows = _ordered(events)
    step = lambda a, e: F.struct(after(a["s"], e).alias("s"), F.when(e["event"] == "look", F.array_append(a["out"], look(e["seq"], a["s"]))).otherwise(a["out"]).alias("out"))
    folded = F.aggregate("e", F.struct(_start().alias("s"), F.array().cast(f"array<struct<{LOOK}>>").alias("out")), step)["out"]
    return rows.select("conv_id", F.explode(folded).alias("x")).select("conv_id", "x.*")
