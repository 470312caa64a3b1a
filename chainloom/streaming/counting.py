"""Counters over a stream of events, by window and by session, once the watermark has passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``events``: ts, key. start, key, n: tumbling windows. A stream's rows may be ``late`` by so much; later ones are dropped and told by ``dropped``."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", every).alias("w"), "key").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "key", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """``events``: ts, key. start, end, key, n: a key's events without a gap of that length; ``end`` is the last event and the gap."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "key").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "key", "n")


def append(counts: DataFrame, target: str, state: str) -> StreamingQuery:
    """Finished windows go to ``target`` as Parquet, each once; handles what is there and ends. ``state`` is a shared folder."""
    return counts.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()


def dropped(query: StreamingQuery) -> int:
    """How many rows came after the watermark had passed them, in all batches that the query remembers."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
