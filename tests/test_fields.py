"""Fields of documents, and what is told of their edges without making them."""

import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chainloom.operators import graph as G
from chainloom.operators import meeting as MT
from chainloom.plans import bindings as B
from chainloom.plans import registry
from tests.oracle import assert_same

FIELDS = "endpoint long, tool string, category string, kind string, field string"


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Documents with capitals outside ASCII, words in both forms, blanks of all kinds, no text, and an id in two sources."""
    at = tmp_path_factory.mktemp("odd")
    words = ["CIÓNMIÍR alpha beta", "Ciónmiír gamma  x\n\ny", "ciónmiír Alpha alpha\tomega", None, "", " \n ", "CIÓNMIÍR Gamma Beta É É é", "gamma delta Éa Omega", "Delta delta beta Ciónmiír"]
    rows = {"doc_id": [1, 2, 101, 102, 103, 104, 201, 301, 1], "text": words, "lang": ["en"] * 9, "source": ["s1", "s1", "s2", "s1", "s6", "s3", "s6", "s2", "s4"], "n_chars": [len(w or "") for w in words]}
    pq.write_table(pa.table(rows), at / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet'")
    return str(at), con


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_fields_equal_their_sql(spark, odd):
    assert_same(B.fields(spark, odd[0]), odd[1], f"{B.sql('fields')} SELECT * FROM fields")


def test_fields_are_read_once(spark, odd):
    assert scans(B.fields(spark, odd[0])) == 1


@pytest.mark.parametrize("name", ["feeds_root", "feeds_exact", "flow_targets", "chainable_endpoints", "independent_pairs", "ep_flow", "same_tool_edges"])
def test_odd_words_equal_sql(spark, odd, name):
    assert_same(registry.queries()[name](spark, odd[0]), odd[1], registry.oracle_sql()[name])


def test_independent_pairs_of_a_whole_source(spark, odd):
    """Documents of a source are partners also where their ids lie in different hundreds."""
    found = {(r.a, r.b) for r in registry.queries()["independent_pairs"](spark, odd[0]).collect()}
    assert (101, 301) in found  # s2/1 and s2/3


def test_independent_pairs_leave_flows_either_way(spark):
    ends = spark.createDataFrame([(i, f"g{i % 2}") for i in range(12)], "endpoint long, group string")
    flow = spark.createDataFrame([(0, 2), (6, 4), (1, 3)], "src long, dst long")
    every = {(a, b) for a in range(12) for b in range(a + 1, 12) if a % 2 == b % 2} - {(0, 2), (4, 6), (1, 3)}
    assert sorted((r.a, r.b) for r in G.independent_pairs(ends, flow, size=3).collect()) == sorted(every)


def test_sources_are_those_of_the_edges(spark):
    kinds = ["string", "integer", "boolean"]
    rows = [(i, f"t{i // 3}", f"c{i % 2}", "input" if (i * j) % 3 else "output", f"f{(i * 2 + j) % 23}", kinds[(i * i + j) % 3]) for i in range(40) for j in range(4)]
    f = spark.createDataFrame(rows, FIELDS + ", type string").distinct()
    of = lambda df: {r[0] for r in df.distinct().collect()}
    assert of(G.hard_sources(f, 0.9)) == of(G.feeds_exact(f, 0.9).where("edge_class = 'hard'").select("src")) != set()
    assert of(G.same_tool_sources(f)) == of(G.same_tool_edges(f).select("src")) != set()


def test_exact_edges_shuffle_no_pairs(spark, odd):
    """Pairs are graded where they are made; they were grouped by source and target in a shuffle before."""
    plan = G.feeds_exact(B.fields(spark, odd[0]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(src#\d+L?, dst#", plan)


@pytest.mark.parametrize("at_once", [1, 4_000_000])
def test_exact_edges_equal_all_pairs(spark, monkeypatch, at_once):
    """With types, endpoints of several tools and categories, and runs of one endpoint."""
    monkeypatch.setattr(MT, "AT_ONCE", at_once)
    r, kinds = random.Random(5), ["string", "integer", "boolean", "number", "array"]
    rows = {(r.randrange(60), f"t{r.randrange(9)}", r.choice(["c0", "c1", None]), r.choice(["input", "output"]), f"f{r.randrange(30)}", r.choice(kinds)) for _ in range(900)}
    f = spark.createDataFrame(sorted(rows, key=repr), FIELDS + ", type string")
    group = f.select("endpoint", F.lit(1).alias("group")).distinct()
    of = lambda df: sorted(tuple(x) for x in df.collect())
    assert of(G.feeds_exact(f, 0.9)) == of(G.feeds_exact(f, 0.9, within=group)) != []
