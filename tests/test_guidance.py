"""Texts of prompts against plain functions, and their cases at the edges."""

from pyspark.sql import functions as F

from chainloom.operators import guidance as GU
from chainloom.operators import metrics as M
from chainloom.operators import turns as TU


def test_lists_read_as_literals(spark):
    lists = [[], ["a"], ["it's", 'say "x"', """both ' and " """], ["back\\slash", "line\nfeed", "tab\tcr\r"], ["é 漢", ""]]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<string>").select("i", GU.listed(F.col("x")).alias("t")).collect()
    assert {r.i: r.t for r in got} == {i: repr(x) for i, x in enumerate(lists)}


def test_completion_guidance(spark):
    rows = [(0, 3, "single"), (-1, 3, None), (2, 1, "single"), (2, 1, "quick_lookup"), (2, 1, "full_workflow"), (4, 0, None)]
    got = [r.t for r in spark.createDataFrame(rows, "r int, c int, k string").coalesce(1).select(GU.completion_guidance(F.col("r"), F.col("c"), F.col("k")).alias("t")).collect()]
    assert got[0] == got[1] == GU.STATUS_DONE
    assert got[2] == got[3] == "STATUS: IN PROGRESS (1/3 tasks done).\n" + GU.STATUS_SHORT
    assert got[4].splitlines()[:2] == ["STATUS: IN PROGRESS (1/3 tasks done).", "2 task(s) still to complete."]
    assert got[5].startswith("STATUS: IN PROGRESS (0/4 tasks done).\n4 task(s)")


def test_plan_texts_follow_the_state(spark):
    def events(conv, *steps):
        return [(conv, i, e, t) for i, (e, t) in enumerate(steps)]

    plan = [("plan", "w/b"), ("plan", "v/a")]
    rows = events(1, *plan, ("use", "v/a")) + events(2, *plan, ("use", "v/a"), ("use", "w/b")) + events(3, *plan, ("ask", None)) + events(4, *plan, *[("message", None)] * 16) + events(5, ("message", None)) + events(6, *plan, ("use", "x/y"))
    states = TU.states(spark.createDataFrame(rows, TU.EVENT))
    got = {r.conv_id: r for r in GU.plan_texts(states).collect()}
    assert got[1].hint == "Task 50% complete. Tools not yet used: ['w']. Continue the conversation."
    assert got[1].for_assistant == GU.ASSISTANT_LEFT % ("['v/a']", "['w']") and got[1].for_user == GU.USER_LEFT
    assert (got[2].hint, got[2].for_assistant, got[2].for_user) == (GU.HINT_WRAP, GU.ASSISTANT_WRAP, GU.USER_WRAP)
    assert got[3].for_user == GU.USER_ASKED and got[3].hint.startswith("Task 0% complete. Tools not yet used: ['v', 'w'].")
    assert (got[4].hint, got[4].for_assistant, got[4].for_user) == (GU.HINT_DONE, "", "")
    assert got[5].hint == GU.HINT_WRAP
    assert got[6].for_assistant.startswith("Tools completed: []. Tools still available: ['v', 'w'].")


def test_repair_hints(spark):
    rows = [(1.0, 1.0, 1.0, "a specific_issues: x specific_issues:\n the last \n"), (2.9, 3.0, None, "specific_issues:  "), (5.0, 5.0, 5.0, None), (1.0, 2.0, 2.5, "none")]
    got = [r.t for r in spark.createDataFrame(rows, "n double, t double, c double, why string").coalesce(1).select(GU.repair_hints(*[F.col(c) for c in ("n", "t", "c", "why")]).alias("t")).collect()]
    assert got == ["FIX THESE SPECIFIC ISSUES: the last", GU.REPAIR_NATURALNESS, "", " ".join((GU.REPAIR_NATURALNESS, GU.REPAIR_TOOLS, GU.REPAIR_TASK))]


def test_steering_text(spark):
    candidates = spark.createDataFrame([(1, 1, "a"), (1, 0, "b"), (1, 2, "a"), (2, 0, "b"), (3, 0, "a")], "slot long, place int, endpoint string")
    tools = spark.createDataFrame([("a", 50), ("b", 1), ("c", 2), ("d", 3)], "key string, n long")
    categories = spark.createDataFrame([("x", 90, 0), ("w", 2, 5), ("v", 1, 3), ("u", 1, 4), ("t", 1, 9)], "key string, n long, first long")
    convs = spark.range(5)
    past = spark.createDataFrame([(2, i, s, f"m{i}") for i, s in enumerate((0.1, 0.5, 0.2, 0.9, 0.3, 0.8))], "slot long, place int, score double, memory string")
    got = {r.slot: r.guidance for r in GU.steering_text(candidates, tools, categories, convs, past).collect()}
    under = GU.UNDERUSED % "['v', 'u', 'w']"
    assert got == {1: GU.OVERUSED % "['a', 'a']" + " " + under, 2: under + " " + GU.SIMILAR % "m1; m3; m4", 3: GU.OVERUSED % "['a']" + " " + under}
    assert {r.guidance for r in GU.steering_text(candidates, tools, categories, convs.limit(4)).collect()} == {""}
    none = GU.steering_text(candidates, tools.limit(0), categories.limit(0), convs)
    assert {r.guidance for r in none.collect()} == {""}


def test_chain_text(spark):
    param = "array<struct<name:string,description:string,default:string,example_value:string>>"
    tools = spark.createDataFrame([("t", "About t. " + "x" * 300), ("e", ""), ("n", None)], "tool_name string, description string")
    required = [("city", "City", "", "Rome"), ("api_key", "k", "", ""), ("day", "d" * 61, "now", ""), ("n", "", None, None)]
    endpoints = spark.createDataFrame([("t", "own", "Does it.", required), ("t", "bare", "", []), ("e", "bare", "", []), ("e", "asks", "", required[:1]), ("gone", "bare", None, [])], f"tool_name string, name string, description string, required {param}")
    chain = [("t", "own"), ("t", "bare"), ("e", "bare"), ("e", "asks"), ("gone", "bare"), ("t", "lacks"), ("n", "lacks"), ("no", "no")]
    chains = spark.createDataFrame([(7, i, *c) for i, c in enumerate(chain, 1)], "slot long, step int, tool_name string, name string")
    [row] = GU.chain_text(chains, tools, endpoints).collect()
    about = ("About t. " + "x" * 300)[:200] + "..."
    assert row.capabilities.split("\n") == [
        "1. Does it. (accepts: City=Rome, day=now, n)", f"2. {about}", "3. Performs an action related to ", "4.  (accepts: City=Rome)",
        "5. Performs an action related to this service", f"6. {about}", "7. Step 7", "8. Step 8",
    ]


def test_domains_fall_back_on_tools(spark):
    convs = spark.createDataFrame([(1,), (2,), (3,)], "conv_id long")
    categories = spark.createDataFrame([(1, "a"), (1, "b")], "conv_id long, category string")
    calls = spark.createDataFrame([(1, "t"), (2, "t"), (2, "t"), (2, "u")], "conv_id long, tool string")
    got = sorted(tuple(r) for r in M.used_domains(convs, categories, calls).collect())
    assert got == [(1, "a"), (1, "b"), (2, "t"), (2, "u")]
