"""Archives, quarantine, definitions, the built graph and the gate's counters."""

import json
import zipfile

from chainloom.operators import definitions as DF
from chainloom.operators import graph as G
from chainloom.operators import sampling as S
from chainloom.sources import catalogue as C
from chainloom.sources import wire


def test_archives_and_folders_read_alike(spark, tmp_path):
    tool = {"tool_name": "Rooms", "api_list": [{"name": "search"}]}
    files = {"data/toolenv/tools/Stay/rooms_x.json": json.dumps(tool), "data/toolenv/tools/Stay/own.json": json.dumps(tool | {"standardized_name": "o", "category": "C", "tool_name": "Own"}), "data/toolenv/tools/Stay/broken.json": "{", "data/toolenv/tools/Stay/list.json": "[1]", "data/other/x.json": json.dumps(tool), "data/toolenv/tools/Stay/read.txt": "x"}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
            (tmp_path / "plain" / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / "plain" / name).write_text(text)
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    for rows in (wire.read_archives(spark, str(tmp_path)), wire.read_catalogue(spark, str(tmp_path / "plain/data/toolenv"))):
        tools, endpoints = C.parse(wire.numbered(rows))
        assert {(r.tool_name, r.standardized_name, r.category) for r in tools.collect()} == {("Rooms", "rooms_x", "Stay"), ("Own", "o", "C")}
        assert endpoints.count() == 2 and {r.stem for r in rows.collect()} == {"rooms_x", "own"}


def test_quarantine_and_parsed_are_all(spark):
    given = ['{"tool_name":"a","api_list":[{"name":"x"},{"name":" "},{"url":"u"}]}', '{"tool_name":" ","api_list":[{"name":"x"}]}', '{"tool_name":"b"}', '{"tool_name":"c","api_list":[{}]}', "{broken", "[]", None]
    raw = spark.createDataFrame(list(enumerate(given)), "tool_id long, definition string")
    got = sorted((r.tool_id, r.place if r.place is not None else -1, r.reason) for r in C.quarantine(raw).collect())
    assert got == [(0, 1, "an endpoint without a name"), (0, 2, "an endpoint without a name"), (1, -1, "no name"), (2, -1, "no endpoint with a name"), (3, -1, "no endpoint with a name"), (4, -1, "no JSON object"), (5, -1, "no JSON object"), (6, -1, "no JSON object")]
    assert {r.tool_id for r in C.parse(raw)[0].collect()} | {t for t, place, _ in got if place < 0} == set(range(7))


def test_definitions_lead_back(spark):
    p = lambda *names: [(n, "number", "") for n in names]
    rows = [("My Tool!", "get/x", "", p("a b", "a_b", "a_b_2", "api_key"), p("a?b", "é")), ("9", "y", "about", [], [])]
    param = "array<struct<name: string, type: string, description: string>>"
    e = spark.createDataFrame(rows, f"tool_name string, name string, description string, required {param}, optional {param}")
    got = {r.name: r for r in DF.definitions(e).collect()}
    assert [(x.identifier, x.name) for x in got["get/x"].parameters] == [("a_b", "a b"), ("a_b_2", "a_b"), ("a_b_2_2", "a_b_2"), ("a_b_3", "a?b"), ("param", "é")]
    schema = json.loads(got["get/x"].input_schema)
    assert schema["required"] == ["a_b", "a_b_2", "a_b_2_2"] and list(schema["properties"]) == ["a_b", "a_b_2", "a_b_2_2", "a_b_3", "param"] and schema["properties"]["a_b"] == {"type": "number", "description": "a b"}
    assert (got["get/x"].identifier, got["y"].identifier, got["get/x"].about) == ("My_Tool___get_x", "t_9__y", "No description available.")
    calls = spark.createDataFrame([("My_Tool___get_x",), ("u__v__w",), ("z",)], "identifier string")
    assert {r.identifier: (r.tool_name, r.name) for r in DF.named(calls, DF.definitions(e)).collect()} == {"My_Tool___get_x": ("My Tool!", "get/x"), "u__v__w": ("u", "v__w"), "z": ("z", "z")}


def test_built_graph_is_kept(spark, tmp_path):
    rows = [("a", "A", "x", "output", "hotel_id"), ("b", "B", "x", "input", "hotel_id"), ("a2", "A", "x", "input", "hotel_id"), ("b", "B", "x", "output", "b")]
    fields = spark.createDataFrame(rows, "endpoint string, tool string, category string, kind string, field string")
    C.save(G.build(fields, 2.0, spark.createDataFrame([("a", "b", 0.8)], "src string, dst string, cosine double")), str(tmp_path))
    graph = C.load(spark, str(tmp_path), ("nodes", "edges"))
    ids = {r.id for r in graph["nodes"].collect()}
    assert ids == {"category:x", "tool:A", "tool:B", "endpoint:a", "endpoint:b", "endpoint:a2", "output_field:a/hotel_id", "parameter:b/hotel_id", "parameter:a2/hotel_id", "output_field:b/b"}
    edges = graph["edges"].collect()
    assert all(e.src in ids and e.dst in ids for e in edges)
    assert {(e.src, e.dst) for e in edges if e.edge_type == "same_tool"} == {("endpoint:a", "endpoint:a2")} and {e.edge_type for e in edges} == {"belongs_to", "has_endpoint", "takes_input", "produces", "same_tool", "feeds_into", "semantic_bridge"}


def test_gate_counters_and_steps(spark, tmp_path):
    chains = spark.createDataFrame([(1, ["a", "b"], "hard", 2), (2, ["c"], "soft", 0), (3, ["d"], None, 1)], "slot long, chain array<string>, gate string, rejected int")
    assert S.write_chains(chains, str(tmp_path / "chains")) == {"chains": 3, "hard_passed": 1, "soft_approved": 1, "soft_rejected": 3}
    assert spark.read.parquet(str(tmp_path / "chains")).count() == 3
    assert {r.slot: r.steps for r in S.steps_of(chains).collect()}[1] == [["a"], ["b"]] and {r.slot: r.steps for r in S.steps_of(chains, True).collect()}[1] == [["a", "b"]]
