"""Ordered processing of messages and calls: rendering, turn state, structural checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import normal_name


def joined(messages: DataFrame, line: Column, gap: str, name: str) -> DataFrame:
    """conv_id and its lines in order of msg_idx."""
    rows = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("msg_idx", line.alias("line")))).alias("l"))
    return rows.select("conv_id", F.array_join(F.transform("l", lambda x: x["line"]), gap).alias(name))


def user_visible(messages: DataFrame) -> DataFrame:
    shown = messages.where(F.col("role").isin("user", "assistant") & (F.coalesce("content", F.lit("")) != ""))
    return joined(shown, F.concat(F.initcap("role"), F.lit(": "), F.col("content")), "\n", "history")


def transcript(messages: DataFrame) -> DataFrame:
    return joined(messages, F.concat(F.lit("["), F.upper("role"), F.lit("] "), F.coalesce("content", F.lit(""))), "\n", "transcript")


def context_tail(messages: DataFrame, budget: int = 16_000, mark: str = "[earlier turns left out]\n") -> DataFrame:
    """The whole history, or its last ``budget`` characters after a mark."""
    whole = joined(messages, F.concat(F.upper("role"), F.lit(": "), F.coalesce("content", F.lit(""))), "\n\n", "context")
    long = F.length("context") > budget
    return whole.select("conv_id", F.when(long, F.concat(F.lit(mark), F.expr(f"right(context, {budget})"))).otherwise(F.col("context")).alias("context"))


def user_words(messages: DataFrame) -> DataFrame:
    """conv_id, word: what users said, without punctuation at the ends, of three characters or more."""
    words = messages.where("role = 'user' and content is not null").select("conv_id", F.explode(F.split("content", r"\s+")).alias("w"))
    return words.select("conv_id", F.regexp_replace("w", r"^[.,!?;:\"'()\[\]{}]+|[.,!?;:\"'()\[\]{}]+$", "").alias("word")).where(F.length("word") >= 3).distinct()


def turn_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.count(F.when(F.col("role") == "user", 1)).alias("user_turns"))


def last_user_message(messages: DataFrame) -> DataFrame:
    return messages.where("role = 'user'").groupBy("conv_id").agg(F.max_by("content", "msg_idx").alias("last_user"))


def clarifications(messages: DataFrame) -> DataFrame:
    """conv_id, msg_idx, clarifies: an assistant's text asks back, or is the first of its conversation."""
    order = Window.partitionBy("conv_id").orderBy("msg_idx")
    said = messages.where("role = 'assistant'")
    return said.select("conv_id", "msg_idx", (F.contains("content", F.lit("?")) | (F.row_number().over(order) == 1)).alias("clarifies"))


def role_islands(messages: DataFrame) -> DataFrame:
    """conv_id, island, role, parts, chars: neighbours of one role merged."""
    order = Window.partitionBy("conv_id").orderBy("msg_idx")
    starts = (~F.lag("role").over(order).eqNullSafe(F.col("role"))).cast("int")
    numbered = messages.withColumn("s", starts).withColumn("island", F.sum("s").over(order))
    return numbered.groupBy("conv_id", "island").agg(F.first("role").alias("role"), F.count(F.lit(1)).alias("parts"), F.sum(F.length("content")).alias("chars"))


def chain_breaks(args: DataFrame, outputs: DataFrame, said: DataFrame) -> DataFrame:
    """Calls whose id-like text argument contradicts all earlier responses that had the field, and that no user supplied.

    ``args``: conv_id, call_idx, name, value; ``outputs``: conv_id, call_idx, name (normalised), value; ``said``: conv_id, word."""
    like_id = F.lower("name").rlike("|".join(K.ID_PARTS))
    a = args.where(like_id & ~F.col("value").isin("default", "") & (F.col("call_idx") > 0)).withColumn("field", normal_name(F.col("name"), "judge"))
    first = outputs.groupBy("conv_id", F.col("name").alias("field")).agg(F.min("call_idx").alias("seen"))
    known = outputs.groupBy("conv_id", F.col("name").alias("field"), "value").agg(F.min("call_idx").alias("at"))
    suspect = a.join(first, ["conv_id", "field"]).where("seen < call_idx").join(known, ["conv_id", "field", "value"], "left").where("at is null or at >= call_idx")
    return suspect.join(said.withColumnRenamed("word", "value"), ["conv_id", "value"], "left_anti").select("conv_id", "call_idx", "name", "value")


def structural_caps(conversations: DataFrame) -> DataFrame:
    """``conversations``: tool_correctness, task_completion, planned, n_calls, n_messages, broken. Scores only go down."""
    no_calls = (F.col("planned") > 0) & (F.col("n_calls") == 0)
    tool = F.when(no_calls, F.least("tool_correctness", F.lit(1.0))).otherwise(F.col("tool_correctness"))
    tool = F.when(F.col("broken"), F.least(tool, F.lit(2.5))).otherwise(tool)
    task = F.when((F.col("n_messages") <= 2) & (F.col("planned") > 0), F.least("task_completion", F.lit(2.0))).otherwise(F.col("task_completion"))
    return conversations.withColumns({"tool_correctness": tool, "task_completion": task})
