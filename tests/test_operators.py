"""Golden rows of metrics, text functions, dialogue checks, graph, codec and walks."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from chainloom.functions import text as T
from chainloom.operators import dialogue as D
from chainloom.operators import graph as G
from chainloom.operators import metrics as M
from chainloom.operators import planning as P
from chainloom.operators import sampling as S
from chainloom.operators import selection as Q
from chainloom.sources import catalogue as C
from chainloom.sources import wire


def calls(spark, *convs):
    rows = [(i, e.split("/")[0], e.split("/")[1], e) for i, c in enumerate(convs) for e in c]
    return spark.createDataFrame(rows, "conv_id long, tool string, api string, endpoint string")


def convs(spark, n):
    return spark.range(n).select(F.col("id").alias("conv_id"), F.lit("t").alias("type"), F.lit("A").alias("run"))


@pytest.mark.parametrize(
    ("given", "expected"),
    [([["T1/a", "T2/a", "T3/a", "T4/a"]] * 2, 1.0), ([["T1/a"]] * 20, 0.0), ([["T1/a"] * 16 + [f"T{i}/a" for i in range(2, 6)]], 0.48319), ([["T1/a"] * 5, ["T1/a"] * 3], 0.0), ([], 0.0)],
)
def test_usage_entropy(spark, given, expected):
    assert M.usage_entropy(calls(spark, *given)).first()[0] == pytest.approx(expected, abs=1e-5)


def test_counts_and_shares(spark):
    assert M.unique_tools(calls(spark, ["T1/a", "T1/b", "T2/a"], ["T1/a", "T3/a"])).first()[0] == 4
    three = calls(spark, ["T1/a", "T2/a", "T3/a"])
    assert M.coverage(three, spark.range(1).select(F.lit(10).alias("n"))).first()[0] == pytest.approx(0.3)
    assert M.coverage(three, spark.range(1).select(F.lit(0).alias("n"))).first()[0] == 0.0
    assert M.concentration(calls(spark, ["T1/a"] * 9 + ["T2/a"]), 1).first()[0] == pytest.approx(0.9)
    assert M.combo_entropy(convs(spark, 4), calls(spark, ["A/a"], ["B/a"], ["C/a"], ["D/a"])).first()[0] == pytest.approx(2.0)
    assert M.chain_ratio(convs(spark, 3), calls(spark, ["A/a"], ["A/a"], ["B/a"])).first()["chain_ratio"] == pytest.approx(2 / 3)
    # A conversation without calls has the empty signature.
    assert M.chain_ratio(convs(spark, 2), calls(spark, ["A/a"])).first()["unique_chains"] == 2


def test_scores_and_rates(spark):
    s = spark.createDataFrame([(1, 5.0, 4.0, 3.0), (2, 3.0, 4.0, 5.0), (3, None, None, None)], "conv_id long, naturalness double, tool_correctness double, task_completion double")
    assert tuple(M.mean_scores(s).first()) == (4.0, 4.0, 4.0, 4.0, 2)
    assert tuple(M.mean_scores(s.limit(0)).first()) == (0.0, 0.0, 0.0, 0.0, 0)
    c = calls(spark, ["A/a", "B/a", "C/a"], ["A/a", "A/a"], ["A/a"], ["A/a", "B/a", "C/a", "D/a"])
    assert M.ms_mt_rate(convs(spark, 4), c).first()[0] == 0.5


@pytest.mark.parametrize(
    ("rows", "expected"),
    [([("{}", '{"id":"htl_1"}'), ('{"hotel":"htl_1"}', "{}")], True), ([("{}", '{"id":"ab"}'), ('{"x":"ab"}', "{}")], False), ([('{"x":"abc"}', '{"id":"abc"}')], False), ([("{}", '{"n":7}'), ('{"m":7}', "{}")], True), ([("{}", '{"b":true}'), ('{"c":true}', "{}")], True), ([('{"x":"abc"}', "{}"), ("{}", '{"y":"abc"}')], False),
     ([("{}", '{"data":{"hotels":[{"id":"htl_1"}]}}'), ('{"h":"htl_1"}', "{}")], True), ([("{}", '{"n":7}'), ('{"m":"7"}', "{}")], False), ([("{}", '{"n":"7"}'), ('{"m":7}', "{}")], True), ([("{}", '{"a":"abc"}'), ('{"m":{"x":"abc"}}', "{}")], False)],
)
def test_chaining(spark, rows, expected):
    df = spark.createDataFrame([(1, i, a, r) for i, (a, r) in enumerate(rows)], "conv_id long, call_idx int, arguments string, response string")
    assert M.chained(df).first()["chained"] is expected


@pytest.mark.parametrize(("scores", "threshold", "expected"), [([2.0, 4.5], 3.5, (1, 4.5, 1)), ([2.0, 2.5, 2.2], 4.0, (1, 2.5, 2)), ([4.0, 5.0], 3.5, (0, 4.0, 0)), ([3.0, 3.0], 4.0, (0, 3.0, 1))])
def test_attempts(spark, scores, threshold, expected):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(scores)], "slot long, attempt int, score double")
    assert tuple(M.best_attempt(df, threshold).first())[1:] == expected


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("name", "expected"), [("hotelId", "hotel_id"), ("CheckInDate", "check_in_date"), ("hotel_ID", "hotel_id"), ("HTMLParser", "html_parser"), ("user-id", "user_id"), ("_x_", "x"), ("intercomUserId", "intercom_user_id"), ("", "")])
def test_judge_names(spark, name, expected):
    assert one(spark, T.normal_name(F.lit(name), "judge")) == expected


def test_text(spark):
    assert [one(spark, T.field_root(F.lit(x))) for x in ("hotel_id", "booking_confirmation_id", "city", "_id")] == ["hotel", "booking_confirmation", "city", "id"]
    assert [one(spark, T.tool_identifier(F.lit(x))) for x in ("Hotel Finder", "123tool")] == ["Hotel_Finder", "t_123tool"]
    assert [one(spark, T.param_identifier(F.lit(x))) for x in ("user name", "email-address", "query.filter", "user[0]", "foo/bar", " ", "a" * 80)] == ["user_name", "email-address", "query.filter", "user_0", "foo_bar", "param", "a" * 64]
    auth = lambda x: one(spark, T.auth_param(F.lit(x)))
    assert all(map(auth, ("access_token", "api_key", "apikey", "password", "client_secret", "bearer", "authorization", "x_access_token")))
    assert not any(map(auth, ("post_id", "hotel_id", "keyword", "key_features", "author", "name", "city", "fixture_id")))
    assert [one(spark, T.normal_type(F.lit(x))) for x in ("STRING", "DATE (YYYY-MM-DD)", "int", None)] == ["string", "string", "integer", "string"]
    assert one(spark, T.normal_method(F.lit("fetch"))) == "GET"
    assert one(spark, T.clean_description(F.lit('<p>A  b</p>"'))) == "A b"
    assert [one(spark, T.clamp(F.lit(x))) for x in ("0.5", "6", "3.5", "invalid")] == [1.0, 5.0, 3.5, 3.0]
    assert [one(spark, c) for c in T.endpoint_parts(F.lit("Service/path/to"))] == ["Service", "path/to"]
    assert one(spark, T.short_description(F.lit("a" * 60 + "." + "b" * 300))) == "a" * 60 + "."
    assert one(spark, T.junk_name(F.lit("Petstore blitz"))) is True


def test_chain_breaks(spark):
    args = spark.createDataFrame([(1, 1, "hotelId", "wrong"), (1, 1, "admin_id", "made_up"), (2, 1, "hotel_id", "h1"), (3, 1, "ticket_id", "T9"), (4, 0, "hotel_id", "x"), (5, 1, "hotel_id", "")], "conv_id long, call_idx int, name string, value string")
    outputs = spark.createDataFrame([(i, 0, n, v) for i, n, v in ((1, "hotel_id", "h1"), (2, "hotel_id", "h1"), (3, "ticket_id", "T1"), (4, "hotel_id", "h1"), (5, "hotel_id", "h1"))], "conv_id long, call_idx int, name string, value string")
    said = spark.createDataFrame([(3, "T9")], "conv_id long, word string")
    assert [tuple(r) for r in D.chain_breaks(args, outputs, said).collect()] == [(1, 1, "hotelId", "wrong")]


def test_graph(spark):
    rows = [("s", "A", "x", "output", "hotel_id"), ("b", "A", "x", "input", "hotel_id"), ("c", "B", "x", "input", "hotel_id"), ("c", "B", "x", "input", "hotel_code"), ("d", "C", "y", "input", "zzz")]
    f = spark.createDataFrame(rows, "endpoint string, tool string, category string, kind string, field string")
    assert [(r.src, r.dst, r.shared_fields) for r in G.same_tool_edges(f).collect()] == [("s", "b", ["hotel_id"])]
    # Of four endpoints in two categories hotel_id is generic, so no edge leaves the tool.
    assert G.feeds_exact(f).count() == 0
    # As a rare field its confidence is .2 + .1 + .3 + .4 ln(4/3) / ln 4.
    assert [tuple(r) for r in G.feeds_exact(f, 0.9).collect()] == [("s", "c", 0.683, "soft", "hotel_id")]
    assert G.feeds_exact(f.withColumn("category", F.concat("category", "endpoint")), 0.9).count() == 0


def test_quota_equals_greedy(spark):
    tools = spark.createDataFrame([(i, f"c{i % 3}", float((i * 37) % 101)) for i in range(60)], "tool_id long, category string, score double")
    got = {r.tool_id for r in Q.select_quota(tools, 15, 2).collect()}
    rows = sorted(tools.collect(), key=lambda r: (-r.score, r.tool_id))
    per, chosen = {}, set()
    for c in ("c0", "c1", "c2"):
        best = [r.tool_id for r in rows if r.category == c][:2]
        chosen |= set(best)
        per[c] = 2
    for r in rows:
        if len(chosen) < 15 and r.tool_id not in chosen and per[r.category] < 10:
            chosen.add(r.tool_id)
            per[r.category] += 1
    assert got == chosen


def test_exact_steps():
    assert S.Constraints(exact_steps=3).max_steps == 3 == S.Constraints(exact_steps=3).min_steps
    with pytest.raises(ValueError):
        S.Constraints(exact_steps=0)


def test_semantic_bridge_by_tiles(spark):
    r = random.Random(5)
    rows = [(i, "abc"[i % 3], [r.gauss(0, 1) for _ in range(4)]) for i in range(40)] + [(40, "a", None), (41, "b", [0.0] * 4), (42, "c", [1.0, None, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "id long, category string, v array<double>")

    def cosine(x, y):
        return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))

    want = {(i, j) for i, c, x in rows[:40] for j, k, y in rows[:40] if c != k and cosine(x, y) >= 0.5}
    assert want and {(x.src, x.dst) for x in G.semantic_bridge(vectors, None, 0.5, tile=7).collect()} == want
    allowed = spark.createDataFrame([("a", "b")], "ca string, cb string")
    kept = {(i, j) for i, j in want if {rows[i][1], rows[j][1]} == {"a", "b"}}
    assert kept and {(x.src, x.dst) for x in G.semantic_bridge(vectors, allowed, 0.5, tile=7).collect()} == kept
    assert G.semantic_bridge(vectors.limit(0), None, 0.5).count() == 0


def test_cosine_join_equals_all_pairs(spark):
    r = random.Random(6)
    texts = [[r.choice("abcdefghijklmnopqrstuvwxyz") * r.randrange(1, 3) for _ in range(r.randrange(1, 12))] for _ in range(80)]
    texts += [texts[i] + ["extra"] for i in range(0, 80, 3)] + [list(texts[5])] * 3
    rows = [(i, "xyz"[i % 3], w) for i, t in enumerate(texts) for w in t]
    vectors = G.text_vectors(spark.createDataFrame(rows, "id long, category string, word string"))
    of = {}
    for v in vectors.collect():
        of.setdefault(v.id, {})[v.word] = v.w
    assert all(abs(sum(w * w for w in v.values()) - 1) < 1e-9 for v in of.values())
    dot = lambda i, j: sum(w * of[j].get(d, 0.0) for d, w in of[i].items())
    every = {(i, j): dot(i, j) for i in of for j in of if i % 3 != j % 3}
    for threshold in (0.3, 0.75, 0.95):
        got = {(x.src, x.dst): x.cosine for x in G.cosine_join(vectors, threshold).collect()}
        want = {p: c for p, c in every.items() if c >= threshold}
        assert set(got) == set(want) and want and all(abs(got[p] - c) < 1e-6 for p, c in want.items())
    allowed = spark.createDataFrame([("y", "x")], "ca string, cb string")
    got = {(x.src, x.dst) for x in G.cosine_join(vectors, 0.75, allowed).collect()}
    assert got == {(i, j) for (i, j), c in every.items() if c >= 0.75 and 2 not in (i % 3, j % 3)}
    assert G.cosine_join(vectors.limit(0)).count() == 0


def test_read_any_takes_both_forms(spark):
    lines = [
        '{"conversation_id":"w","messages":[{"role":"user","content":"hi"}]}',
        '{"conversation_id":"f","tool_outputs":[],"messages":[{"role":"tool","tool_outputs":[{"tool_call":{"tool_name":"t","api_name":"a"},"response":{"n":1}}]}]}',
        '{"tool_calls":[],"messages":[]}',
        '{"tool_calls":[],"messages":[{"role":"robot"}]}',
        '{"tool_calls":[],"judge_scores":{"naturalness":1,"tool_correctness":6,"task_completion":2}}',
        '{"messages":[3]}',
        "",
        "[]",
    ]
    got = wire.read_any(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(r.conversation_id or "" for r in got) == ["", "f", "w"]
    full = next(r for r in got if r.conversation_id == "f")
    assert full.messages[0].tool_outputs[0].asDict() == {"tool": "t", "api": "a", "response": '{"n":1}'} and full.naturalness is None


def test_wire(spark):
    lines = [
        {"conversation_id": "c1", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None, "tool_calls": [{"endpoint": "S/path/to", "arguments": {"a": 1}}, {"endpoint": "T/y", "arguments": {}}]}, {"role": "tool", "content": {"r": 1}}, {"role": "tool", "content": "text"}], "judge_scores": {"naturalness": 4.0, "tool_correctness": 5.0, "task_completion": 3.0}},
        {"conversation_id": "c2", "messages": [{"role": "tool", "content": None}, {"role": "odd", "content": "x"}]},
    ]
    raw = spark.createDataFrame([(json.dumps(x),) for x in lines] + [("{broken",)], "value string")
    got = {r.conversation_id: r for r in wire.read_wire(raw).collect()}
    calls_ = got["c1"].messages[1].tool_calls
    assert [(c.tool, c.api) for c in calls_] == [("S", "path/to"), ("T", "y")]
    assert [[o.response for o in m.tool_outputs] for m in got["c1"].messages[2:]] == [['{"r":1}', '{"result":"text"}']]
    assert [(m.tool_outputs[0].tool, m.tool_outputs[0].response) for m in got["c2"].messages] == [("unknown", "{}")]
    assert wire.rejected(raw).count() == 1
    again = {json.loads(r.value)["conversation_id"]: json.loads(r.value) for r in wire.to_wire(wire.read_wire(raw)).collect()}
    assert again["c1"]["messages"][1] == lines[0]["messages"][1] and again["c1"]["judge_scores"] == lines[0]["judge_scores"]
    assert "judge_scores" not in again["c2"]


def test_catalogue(spark, tmp_path):
    given = [
        {"tool_name": " Rooms ", "category": "stay", "tool_description": "", "api_list": [
            {"name": "search_rooms", "method": "get", "description": "Find <i>rooms</i>", "required_parameters": [{"name": "city", "type": "ENUM"}], "optional_parameters": '[{"name": "max-price", "type": "NUMBER", "default": 9}]'},
            {"name": "book_room", "method": "POST", "required_parameters": ['{"name": "room_id", "type": "STRING"}', "x", 3]}, {"name": " "}]},
        {"tool_name": "", "api_list": [{"name": "a"}]}, {"tool_name": "none", "api_list": []},
    ]
    raw = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(given)] + [(9, "{broken")], "tool_id long, definition string")
    tables = C.cached_or_parsed(spark, str(tmp_path / "registry"), raw)
    assert C.is_cached(spark, str(tmp_path / "registry/tools")) and not C.is_cached(spark, str(tmp_path / "nothing"))
    assert [tuple(r) for r in tables["tools"].collect()] == [(0, "Rooms", "rooms", "Find rooms", "stay", 2)]
    search, book = tables["endpoints"].orderBy("pos").collect()
    assert [(p.name, p.type, p.description) for p in search.required + search.optional] == [("city", "string", "City"), ("max-price", "number", "Max price")]
    fields = {"city": {"type": "string"}, "max-price": {"type": "number"}, "id": {"type": "string"}}
    assert json.loads(search.schema) == {"type": "object", "properties": {"results": {"type": "array", "items": {"type": "object", "properties": fields}}, "total_count": {"type": "integer"}, "status": {"type": "string"}}}
    assert set(json.loads(book.schema)["properties"]) == {"room_id", "room_name", "status", "created_at"} and [p.name for p in book.required] == ["room_id"]
    wanted = spark.createDataFrame([("Rooms", "book_room"), ("Rooms", "other")], "tool_name string, name string")
    assert {r.name: r.method for r in C.find_endpoints(tables["endpoints"], wanted).collect()} == {"book_room": "POST", "other": None}


def test_shown_graph(spark):
    nodes = spark.createDataFrame([("t", "tool"), ("e", "endpoint"), ("p", "parameter"), ("o", "output_field"), ("q", "parameter")], "id string, node_type string")
    edges = spark.createDataFrame([("t", "e", "has_endpoint"), ("e", "p", "takes_input"), ("o", "q", "feeds_into")], "src string, dst string, edge_type string")
    for most, ids, n in ((10, {"t", "e", "p", "o", "q"}, 3), (2, {"t", "e", "o", "q"}, 2)):
        kept, both = C.shown_graph(nodes, edges, most)
        assert {r.id for r in kept.collect()} == ids and both.count() == n


def test_planned_types(spark):
    from chainloom.plans.registry import _KINDS

    made, want = dict.fromkeys((k.name for k in _KINDS), 0), []
    for i in range(100_007):
        name = "multi_step_chain" if not i else max(_KINDS, key=lambda k: (k.share - made[k.name] / i)).name
        made[name] += 1
        want.append(name)
    rows = P.plan_table(spark, _KINDS, 100_007, "multi_step_chain")
    assert [r.type for r in rows.orderBy("slot").collect()] == want
    assert P.plan_table(spark, _KINDS, 3, "quick_lookup").orderBy("slot").first().type == "quick_lookup" and P.constraints_of(_KINDS[4]).min_steps == 4
    with pytest.raises(ValueError):
        P.plan_table(spark, _KINDS[1:], 3, "parallel_lookup")


def test_appending(spark, tmp_path):
    from chainloom.streaming.appending import append_conversations

    places = [str(tmp_path / x) for x in ("in", "out", "state")]
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"{k}.jsonl").write_text(json.dumps({"conversation_id": f"c{k}", "messages": [{"role": "user", "content": "hi"}]}) + "\n{broken\n")
        append_conversations(spark, *places).awaitTermination(120)
        assert {json.loads(r.value)["conversation_id"] for r in spark.read.text(places[1]).collect()} == {f"c{i}" for i in range(1, k + 1)}


def test_packed_cosine_join_over_tiles_equals_all_pairs(spark):
    """Texts as rows, an id in two of them; vectors meet by pairs of small tiles, and no row holds a word of a pair."""
    r = random.Random(8)
    texts = [[r.choice("abcdefghijklmnopqrstuvwxyz") * r.randrange(1, 3) for _ in range(r.randrange(1, 12))] for _ in range(60)]
    texts += [texts[i] + ["extra"] for i in range(0, 60, 3)] + [list(texts[5])] * 3 + [[]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[4] + texts[7])]
    packed = G.packed_texts(spark.createDataFrame(rows, "id long, words array<string>")).withColumn("category", F.element_at(F.array(*[F.lit(c) for c in "xyz"]), (F.col("id") % 3 + 1).cast("int")))
    long = spark.createDataFrame([(i, "xyz"[i % 3], w) for i, t in rows for w in t], "id long, category string, word string")
    of = {}
    for v in G.text_vectors(long).collect():
        of.setdefault(v.id, {})[v.word] = v.w
    dot = lambda i, j: sum(w * of[j].get(d, 0.0) for d, w in of[i].items())
    for threshold in (0.3, 0.75):
        want = {(i, j): c for i in of for j in of if i % 3 != j % 3 and (c := dot(i, j)) >= threshold}
        for tile in (40, 6_000_000):
            got = [(x.src, x.dst, x.cosine) for x in G.packed_cosine_join(packed, threshold, tile=tile).collect()]
            assert len(got) == len(want) and all(abs(want[(a, b)] - c) < 1e-6 for a, b, c in got) and want
    assert G.packed_cosine_join(packed.limit(0)).count() == 0


def test_category_fallback_makes_pairs_in_tiles(spark):
    """Keys of matrices and rare ones, over several tiles; an endpoint of two categories; no join of names makes the pairs."""
    from chainloom.operators.meeting import shared_keys

    r = random.Random(9)
    rows = [(e, f"t{e % 7}", f"c{e % 2}", r.choice(["output", "input"]), f"f{r.randrange(12)}") for e in range(60) for _ in range(8)]
    rows += [(e, "t", c, k, f"f{i}") for e in (3, 4) for c in ("c0", "c1") for k in ("output", "input") for i in (e, 5, 6)] + [(70, "t", "c0", "output", None), (None, "t", "c0", "input", "f1")]
    fields = spark.createDataFrame(rows, "endpoint long, tool string, category string, kind string, field string")
    out, into = ({(e, c, f) for e, _, c, k, f in rows if k == kind and e is not None and f} for kind in ("output", "input"))
    want = {}
    for e, c, f in out:
        for d, k, g in into:
            if c == k and f == g and e != d:
                want.setdefault((e, d), set()).add(f)
    got = G.category_fallback(fields)
    assert {(x.src, x.dst): x.shared for x in got.collect()} == {p: len(f) for p, f in want.items()} and got.count() == len(want)
    assert {x.src for x in G.category_fallback(fields, spark.createDataFrame([(5,)], "endpoint long")).collect()} == {5}
    ends = [(e, e % 2, sorted({r.randrange(40) for _ in range(9)}), sorted({r.randrange(40) for _ in range(9)})) for e in range(50)]
    table = spark.createDataFrame(ends, "end long, group int, given array<long>, taken array<long>")
    every = {(a, b): n for a, g, x, _ in ends for b, h, _, y in ends if g == h and a != b and (n := len(set(x) & set(y)))}
    for tile, words in ((4096, 1024), (7, 3)):
        assert sorted((x.src, x.dst, x.shared) for x in shared_keys(table, tile, words).collect()) == sorted((*p, n) for p, n in every.items())
    assert shared_keys(table.limit(0)).count() == 0
