"""Conversations appended as they come."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import wire


def append_conversations(spark: SparkSession, incoming: str, target: str, state: str) -> StreamingQuery:
    """JSON lines of files that arrive in ``incoming``, read and written again in the wire form to ``target``; each file once, as
    ``state`` (a shared folder) keeps account. Handles what is there and ends; broken lines are left out."""
    lines = spark.readStream.text(incoming)
    return wire.to_wire(wire.read_wire(lines)).writeStream.format("text").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()
