"""Work that is done once a row and on all cores."""

import re

from pyspark.sql import functions as F

from chainloom.functions import walk as W
from chainloom.operators import definitions as DF
from chainloom.operators import graph as G
from chainloom.plans import bindings as B
from chainloom.plans import registry

SF = "/root/testdata/sf0.001"


def plan(df, step="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), step)().toString()


def test_walks_parse_a_text_once(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 24)
    texts = spark.createDataFrame([('{"a":[{"b":1}],"c":2}',)], "t string")
    for walk in (W.leaves, W.entries, W.path_values, W.key_values, W.comparable_values, W.fields_of, W.property_names):
        assert plan(texts.select(walk(F.col("t")).alias("x")), "analyzed").split("\n")[0].count("parse_json(") == 1


def test_names_are_told_apart_once_a_row(spark):
    params = "array<struct<name: string, type: string, description: string>>"
    rows = spark.createDataFrame([("t", "n", "", [("a", "string", ""), ("A b", "string", ""), ("A_b", "integer", "")], [("a", "string", "")])], f"tool_name string, name string, description string, required {params}, optional {params}")
    got = DF.definitions(rows).select("parameters")
    assert [(p.identifier, p.name) for p in got.collect()[0].parameters] == [("a", "a"), ("A_b", "A b"), ("A_b_2", "A_b"), ("a_2", "a")]
    # The names' loop does not stand in the loop over the parameters.
    assert not re.search(r"get\(aggregate\(", plan(got))


def test_small_files_are_dealt(spark):
    d = SF
    for df in (B.tool_definitions(spark, d), B.nested_calls(spark, d).select("response"), registry._islands(spark, d)):
        assert df.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_reading_lines_stays_behind_the_dealing(spark):
    for name in ("message_islands", "unanswered_calls", "trimmed_endpoints", "parameter_identifiers"):
        # What lies below the dealing has been written, so no filter with a walk in it can go there.
        assert "parquet" not in plan(registry.queries()[name](spark, SF), "executedPlan").lower()


def test_tiles_are_bounded(spark):
    vectors = spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("category"), F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double"), F.lit(1.0)).alias("v"))
    of = lambda **k: {(r.src, r.dst, r.cosine) for r in G.semantic_bridge(vectors, None, 0.9, **k).collect()}
    assert of(tile=1, most=4) == of(tile=1, widest=1) == of(tile=7) == of() != set()
    assert "sequence(0, 3" in plan(G.semantic_bridge(vectors, None, 0.9, tile=1, most=4), "analyzed")


def test_nodes_do_not_shuffle_names(spark):
    f = spark.createDataFrame([(1, "t", "c", "input", "x"), (1, "t", "c", "input", "x"), (1, "t", "c", "output", "x"), (2, "t", "c", "output", "y")], "endpoint long, tool string, category string, kind string, field string")
    got = sorted(tuple(r) for r in G.nodes(f).select("id", "node_type", "name").collect())
    assert got == [("category:c", "category", "c"), ("endpoint:1", "endpoint", "1"), ("endpoint:2", "endpoint", "2"), ("output_field:1/x", "output_field", "x"), ("output_field:2/y", "output_field", "y"), ("parameter:1/x", "parameter", "x"), ("tool:t", "tool", "t")]
    assert plan(G.nodes(B.fields(spark, SF))).count("MapInArrow") <= 4
