"""Conversations followed turn by turn as their events arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.turns import STATE

OUT = "conv_id long, seq long, status string, max_messages int, max_turns int, completed int, remaining int, unplanned int"
FIRST = ([], [], False, 0, 0, 0, 0)


class Turns(StatefulProcessor):
    """A conversation's state is one value of the state store. One that hears nothing for ``quiet_ms`` of event time ends as ``done`` (seq null)."""

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("conversation", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        planned, used, asked, turn, messages, more_messages, more_turns = (list(x) if isinstance(x, (list, tuple)) else x for x in (self.state.get() if self.state.exists() else FIRST))
        out = []
        new = pd.concat(rows).sort_values("seq")
        for seq, event, tool in new[["seq", "event", "tool"]].itertuples(index=False):
            if event == "plan":
                planned.append(tool)
            elif event == "use" and tool not in used:
                used.append(tool)
            elif event in ("ask", "answer"):
                asked = event == "ask"
            turn, messages = turn + (event == "turn"), messages + (event == "message")
            if event == "look":
                n, left, cap = len(planned), len(set(planned) - set(used)), 5 * len(planned) + 6
                if not asked and left and messages < cap:
                    more_messages += 4 * (messages >= 4 * n + 2 + more_messages)
                    more_turns += turn >= n + 1 + more_turns
                status = "in_progress" if asked or (left and messages < cap) else "done" if messages >= cap else "completing"
                out.append((key[0], seq, status, 4 * n + 4 + more_messages, n + 2 + more_turns, len(set(planned) & set(used)), left, len(set(used) - set(planned))))
        self.state.update((planned, used, asked, turn, messages, more_messages, more_turns))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(int(new["ts"].max().timestamp() * 1000) + self.quiet_ms)
        yield pd.DataFrame(out, columns=[x.strip().split(" ")[0] for x in OUT.split(",")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        planned, used, *_ = self.state.get()
        self.state.clear()  # state is kept for open conversations alone
        last = (key[0], None, "done", None, None, len(set(planned) & set(used)), len(set(planned) - set(used)), len(set(used) - set(planned)))
        yield pd.DataFrame([last], columns=[x.strip().split(" ")[0] for x in OUT.split(",")])

    def close(self) -> None:
        pass


def follow(events: DataFrame, quiet_ms: int = 86_400_000, late: str = "1 hour") -> DataFrame:
    """``events`` (a stream of conv_id, seq, event, tool, ts; of a conversation in order across batches) to the looks of ``operators.turns``.

    The session needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``)."""
    return events.withWatermark("ts", late).groupBy("conv_id").transformWithStateInPandas(Turns(quiet_ms), OUT, "Append", "EventTime")
