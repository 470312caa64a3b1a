"""The wire form against a plain reading of random conversations, and there and back."""

import json
import random

from chainloom.sources import wire


def lines(n, seed):
    r = random.Random(seed)
    content = lambda: r.choice([None, "x", "", 3, [1, "a"], {"b": "c"}, "é\"\\", True])
    call = lambda: {"endpoint": r.choice(["a/b", "a/b/c", "a", "", "/x"])} | ({"arguments": r.choice([None, {}, {"k": [1, {"z": None}]}])} if r.random() < 0.8 else {})
    message = lambda: {"role": (role := r.choice(["user", "assistant", "assistant", "tool", "tool", "tool", "odd", "system"])), "content": content()} | ({"tool_calls": r.choice([None, [call() for _ in range(r.randrange(4))]])} if role == "assistant" else {})
    return [{"conversation_id": f"c{i}", "messages": [message() for _ in range(r.randrange(14))]} | ({"judge_scores": {"naturalness": 2}} if i % 3 == 0 else {}) | ({"metadata": {"m": i}} if i % 4 == 0 else {}) for i in range(n)]


def read(line):
    """Outputs are held back by the calls before them until another message comes."""
    out, open_, held = [], [], None
    for m in line["messages"]:
        if m["role"] == "tool":
            c = m["content"]
            response = c if isinstance(c, dict) else {} if c is None else {"result": c}
            if open_:
                if held is None:
                    held = ("tool", None, None, [])
                    out.append(held)
                held[3].append((*open_.pop(0), response))
            else:
                out.append(("tool", None, None, [("unknown", "unknown", response)]))
            continue
        open_, held, calls = [], None, None
        if m["role"] == "odd":
            continue
        if m.get("tool_calls"):
            ends = [c["endpoint"].split("/", 1) if "/" in c["endpoint"] else [c["endpoint"]] * 2 for c in m["tool_calls"]]
            calls = [(a, b, c.get("arguments") or {}) for (a, b), c in zip(ends, m["tool_calls"])]
            open_ = [(a, b) for a, b, _ in calls]
        text = m["content"] if m["content"] is None or isinstance(m["content"], str) else json.dumps(m["content"], separators=(",", ":"))
        out.append((m["role"], text, calls, None))
    return out


def plain(rows):
    out = {}
    for r in rows:
        out[r.conversation_id] = [(m.role, m.content, None if m.tool_calls is None else [(c.tool, c.api, json.loads(c.arguments)) for c in m.tool_calls], None if m.tool_outputs is None else [(o.tool, o.api, json.loads(o.response)) for o in m.tool_outputs]) for m in r.messages]
    return out


def test_wire_lines_read_like_plain_json(spark):
    given = lines(300, 5)
    raw = spark.createDataFrame([(json.dumps(x),) for x in given] + [("[]",), (" ",), ("{",), ('{"messages":[3]}',)], "value string").repartition(4)
    rows = wire.read_wire(raw).collect()
    got = plain(rows)
    assert len(rows) == 300
    for x in given:
        assert got[x["conversation_id"]] == read(x), x
    one = {r.conversation_id: r for r in rows}
    assert (one["c0"].naturalness, one["c0"].task_completion, one["c1"].naturalness) == (2.0, 3.0, None) and json.loads(one["c4"].metadata) == {"m": 4}
    assert sorted(r.reason for r in wire.rejected(raw, full=False).collect()) == ["a message is no object", "no JSON object", "no JSON object"]
    # There and back: what was read is read again, but where a role that goes had kept an output from its call.
    again = plain(wire.read_wire(wire.to_wire(wire.read_wire(raw))).collect())
    assert all(again[x["conversation_id"]] == got[x["conversation_id"]] for x in given if all(m["role"] != "odd" for m in x["messages"]))


def test_invariants(spark):
    call, tool = {"role": "assistant", "tool_calls": [{"endpoint": "a/b"}]}, {"role": "tool", "content": {}}
    given = [[{"role": "user", "content": "q"}, *[call, tool] * 3, {"role": "assistant", "content": "ok"}], [call, tool] * 4, [call, tool, {"role": "user", "content": "q"}] * 4, [call], [tool], [{"role": "assistant", "content": " "}], []]
    raw = spark.createDataFrame([(json.dumps({"conversation_id": str(i), "messages": m}),) for i, m in enumerate(given)], "value string")
    got = {r.conversation_id: tuple(r)[1:] for r in wire.invariants(wire.read_wire(raw)).collect()}
    assert got == {"0": (0, 0, 0, 3, True), "1": (0, 0, 0, 4, False), "2": (0, 0, 0, 1, True), "3": (0, 0, 1, 1, False), "4": (0, 1, 0, 0, False), "5": (1, 0, 0, 0, False), "6": (0, 0, 0, 0, True)}
    assert [(r.conversation_id, r.msg_idx, r.tool) for r in wire.unanswered(wire.read_wire(raw)).collect()] == [("3", 0, "a")]
