"""Which conversations to make, and how far one has come."""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sampling import Constraints


@dataclass(frozen=True)
class Kind:
    """A type of conversation, its share, and what its chains must be like."""

    name: str
    share: float
    min_tools: int
    max_tools: int
    min_steps: int
    max_steps: int


def constraints_of(kind: Kind, exclude_tools: tuple[str, ...] = ()) -> Constraints:
    return Constraints(min_tools=kind.min_tools, min_steps=kind.min_steps, max_steps=kind.max_steps, exclude_tools=exclude_tools)


def plan_table(spark: SparkSession, kinds: list[Kind], slots: int, first: str) -> DataFrame:
    """slot, type: always the type that is furthest below its share, the earlier one if equal; the first slot's is given.

    Shares are decimals, so after as many slots as their common denominator every type has its share exactly. Each such period is a row
    that starts from these counts and is filled by itself; one that would not end with exact counts raises an error."""
    shares = [Fraction(str(k.share)) for k in kinds]
    period = math.lcm(*[s.denominator for s in shares])
    each = [int(s * period) for s in shares]
    if sum(each) != period:
        raise ValueError("shares must add up to one")
    numbers = lambda xs, kind: F.array(*[F.lit(x) for x in xs]).cast(f"array<{kind}>")
    at = {k.name: i for i, k in enumerate(kinds)}[first]

    def filled(state: Column, j: Column) -> Column:
        i = F.col("m") * period + j
        gaps = F.transform(numbers([k.share for k in kinds], "double"), lambda s, k: s - F.get(state["made"], k) / i)
        pick = F.when(i == 0, F.lit(at)).otherwise((F.array_position(gaps, F.array_max(gaps)) - 1).cast("int"))
        return F.struct(F.transform(state["made"], lambda c, k: c + F.when(k == pick, 1).otherwise(0)).alias("made"), F.array_append(state["out"], pick).alias("out"))

    made = lambda m: F.transform(numbers(each, "long"), lambda c: c * m)
    start = F.struct(made(F.col("m")).alias("made"), F.array().cast("array<int>").alias("out"))
    rows = spark.range(-(-slots // period)).withColumnRenamed("id", "m").withColumn("s", F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, filled))
    checked = F.when(F.col("s.made") == made(F.col("m") + 1), F.col("s.out")).otherwise(F.raise_error(F.lit("a period ended without exact shares")).cast("array<int>"))
    names = F.array(*[F.lit(k.name) for k in kinds])
    return rows.select("m", F.posexplode(checked).alias("j", "pick")).select((F.col("m") * period + F.col("j")).alias("slot"), F.get(names, F.col("pick")).alias("type")).where(F.col("slot") < slots)


def progress(plans: DataFrame) -> DataFrame:
    """``plans``: planned, used (arrays of endpoints), ... Adds completed, remaining, unplanned and fraction (1 without a plan)."""
    done, planned = F.array_intersect("planned", "used"), F.array_distinct("planned")
    fraction = F.when(F.size("planned") == 0, 1.0).otherwise(F.size(done) / F.size("planned"))
    return plans.withColumns({"completed": F.array_sort(done), "remaining": F.array_sort(F.array_except(planned, F.col("used"))), "unplanned": F.array_sort(F.array_except("used", "planned")), "fraction": F.round(fraction, 9)})


def status(planned: Column, used: Column, waiting: Column, messages: Column, turn: Column, max_turns: Column) -> Column:
    """``waiting``: a question to the user is open. in_progress while something is planned and not used, but for the hard cap of
    messages; then completing; done at the cap."""
    cap = 5 * F.size(planned) + 6
    left = F.size(F.array_except(planned, used)) > 0
    return F.when(waiting, "in_progress").when(messages >= cap, "done").when(left, "in_progress").otherwise("completing")


def next_parameters(chains: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``chains``: slot, chain; ``endpoints``: endpoint, required (names). slot, step, endpoint, next, needs: what the step after needs."""
    steps = chains.select("slot", F.posexplode("chain").alias("step", "endpoint"))
    steps = steps.withColumn("next", F.lead("endpoint").over(Window.partitionBy("slot").orderBy("step")))
    return steps.join(endpoints.select(F.col("endpoint").alias("next"), F.col("required").alias("needs")), "next", "left").select("slot", "step", "endpoint", "next", "needs")


def values_text(values: Column) -> Column:
    """``values``: array of (key, value) structs. The lines of a prompt: a key stands where it came first, with its last value."""
    keys = F.array_distinct(F.transform(values, lambda x: x["key"]))
    last = lambda k: F.element_at(F.filter(values, lambda x: x["key"] == k), -1)["value"]
    lines = F.array_join(F.transform(keys, lambda k: F.concat(F.lit("  - "), k, F.lit(": "), last(k))), "\n")
    return F.when(F.size(values) == 0, "").otherwise(F.concat(F.lit("Values from previous tool calls:\n"), lines))


def mapped_type(kind: Column) -> Column:
    return F.when(kind.isin("string", "integer", "number", "boolean", "array", "object"), kind).otherwise("string")
