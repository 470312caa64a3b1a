"""What is said to a writer of scenarios, a user and an assistant: texts from chains, states, scores and usage, as column expressions.

Lists of names read as in ``['a', 'b']``: a name with an apostrophe and no double quote stands in double quotes; backslashes, line
feeds, returns and tabs are escaped. Names that are null are left out of lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .planning import progress

# Texts of prompts.
STATUS_DONE = "STATUS: ALL TASKS COMPLETE.\nSay a natural thank you and goodbye in one sentence.\nDo NOT ask for anything else.\nDo NOT introduce new topics."
STATUS_OPEN = "STATUS: IN PROGRESS (%d/%d tasks done).\n"
STATUS_SHORT = "React naturally to the assistant's last message.\nDo NOT wrap up or say goodbye yet."
STATUS_LONG = "%d task(s) still to complete.\nKeep the conversation going naturally.\nDo NOT say goodbye until every task is done."
SHORT_TYPES = ("quick_lookup", "single")
HINT_OPEN = "Task %d%% complete. Tools not yet used: %s. Continue the conversation."
HINT_LEFT = "Almost done. These tools were not called: %s. Wrap up naturally and summarize what was accomplished."
HINT_WRAP = "All planned tools have been called. Wrap up the conversation naturally. Summarize results and key values."
HINT_DONE = "The conversation is complete."
ASSISTANT_LEFT = "Tools completed: %s. Tools still available: %s. Use these tools when the user's request calls for them. Do NOT call tools the user hasn't asked for."
ASSISTANT_OPEN = "Continue the conversation."
ASSISTANT_WRAP = "All tools have been used. Give a brief final summary with key values. Do NOT ask questions or offer more help."
USER_ASKED = "Answer the assistant's question naturally."
USER_LEFT = "The assistant completed one step. Based on the scenario, ask for the next thing you need — use specific values from the results you just received."
USER_OPEN = "React naturally to what the assistant said."
USER_WRAP = "The assistant has finished helping you. Acknowledge the results naturally and end the conversation. Do NOT ask follow-up questions."
REPAIR_MARK = "specific_issues:"
REPAIR_ISSUES = "FIX THESE SPECIFIC ISSUES: "
REPAIR_NATURALNESS = "Make the conversation more natural. No filler phrases, no empty messages."
REPAIR_TOOLS = "Use correct values in tool arguments. If a prior tool returned an ID, use that exact ID in the next call. Do not put a user-provided value where a system-generated ID belongs."
REPAIR_TASK = "Ensure all steps form a coherent workflow. Each tool call should logically depend on the previous one."
OVERUSED = "Note: The tools %s have been heavily used. Try to create a scenario that uses them in a novel way, different from typical usage patterns."
UNDERUSED = "Consider incorporating aspects related to these under-explored domains: %s"
SIMILAR = "Similar tool combinations have been used before: %s. Create a scenario that is distinct from these past conversations — use a different user intent, domain angle, or interaction style."
ACCEPTS, ACTION, SERVICE, STEP = " (accepts: %s)", "Performs an action related to %s", "this service", "Step %d"


def listed(names: Column) -> Column:
    def quoted(name: Column) -> Column:
        plain = name
        for of, to in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            plain = F.replace(plain, F.lit(of), F.lit(to))
        single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(F.contains(name, F.lit("'")) & ~F.contains(name, F.lit('"')), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)

    return F.concat(F.lit("["), F.array_join(F.transform(names, quoted), ", "), F.lit("]"))


def completion_guidance(remaining: Column, completed: Column, kind: Column) -> Column:
    """How far the tasks are, and whether to go on or to say goodbye. A type that is null is none of the short ones."""
    so_far = F.format_string(STATUS_OPEN, completed, completed + remaining)
    short = F.coalesce(kind.isin(*SHORT_TYPES), F.lit(False))
    return F.when(remaining <= 0, F.lit(STATUS_DONE)).when(short, F.concat(so_far, F.lit(STATUS_SHORT))).otherwise(F.concat(so_far, F.format_string(STATUS_LONG, remaining)))


def plan_texts(states: DataFrame) -> DataFrame:
    """``states``: conv_id, status, planned, used (arrays of endpoints, ``tool/name``), asked. conv_id, hint, for_assistant, for_user.

    Endpoints that are left are told by their tools, those that are done in full, both sorted by endpoint."""
    rows = progress(states)
    left, done = listed(F.transform("remaining", lambda x: T.endpoint_parts(x)[0])), listed(F.col("completed"))
    open_, wrap, more = F.col("status") == "in_progress", F.col("status") == "completing", F.size("remaining") > 0
    share = F.when(F.size(F.array_distinct("planned")) == 0, 100).otherwise(F.floor(F.size("completed") / F.size("planned") * 100).cast("int"))
    hint = F.when(open_, F.format_string(HINT_OPEN, share, left)).when(wrap & more, F.format_string(HINT_LEFT, left)).when(wrap, HINT_WRAP).otherwise(HINT_DONE)
    assistant = F.when(open_ & more, F.format_string(ASSISTANT_LEFT, done, left)).when(open_, ASSISTANT_OPEN).when(wrap, ASSISTANT_WRAP).otherwise("")
    user = F.when(open_ & F.col("asked"), USER_ASKED).when(open_ & more, USER_LEFT).when(open_, USER_OPEN).when(wrap, USER_WRAP).otherwise("")
    return rows.select("conv_id", hint.alias("hint"), assistant.alias("for_assistant"), user.alias("for_user"))


def repair_hints(naturalness: Column, tool_correctness: Column, task_completion: Column, reasoning: Column) -> Column:
    """The issues that a judge names at the end of its reasoning; if it names none, what each dimension below 3 asks for. Scores that are null ask for nothing."""
    named = F.regexp_replace(F.element_at(F.split(F.coalesce(reasoning, F.lit("")), REPAIR_MARK), -1), r"^\s+|\s+$", "")
    low = F.concat_ws(" ", *[F.when(c < 3.0, F.lit(text)) for c, text in ((naturalness, REPAIR_NATURALNESS), (tool_correctness, REPAIR_TOOLS), (task_completion, REPAIR_TASK))])
    return F.when(F.contains(F.coalesce(reasoning, F.lit("")), F.lit(REPAIR_MARK)) & (named != ""), F.concat(F.lit(REPAIR_ISSUES), named)).otherwise(low)


def steering_text(candidates: DataFrame, tools: DataFrame, categories: DataFrame, conversations: DataFrame, past: DataFrame | None = None) -> DataFrame:
    """``candidates``: slot, place, endpoint; ``tools`` and ``categories``: key, n (how often each was used; categories with ``first``, the
    order in which they came); ``conversations``: one row each; ``past``: slot, place, score, memory (what a search found). slot, guidance.

    Candidates used more than twice the mean are named, then the first three categories used less than half of theirs, then the first three
    memories of a score above 0.2. Fewer than five conversations are told nothing of. All that is broadcast is one row."""
    twice = tools.agg((F.avg("n") * 2).alias("bound"))
    over = tools.join(F.broadcast(twice)).where("n > bound").select(F.col("key").alias("endpoint"))
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct("place", c.alias("x"))))), lambda x: x["x"])
    marked = candidates.join(over.withColumn("used", F.lit(True)), "endpoint", "left")
    rows = marked.groupBy("slot").agg(ordered(F.when(F.col("used"), F.col("endpoint"))).alias("over"))
    half = categories.agg((F.avg("n") * 0.5).alias("bound"))
    rare = categories.join(F.broadcast(half)).where("n < bound").orderBy("first", "key").limit(3).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "key"))), lambda x: x["key"]).alias("under"))
    enough = conversations.agg((F.count(F.lit(1)) >= 5).alias("enough"))
    rows = rows.join(F.broadcast(rare)).join(F.broadcast(enough))
    if past is None:
        rows = rows.withColumn("past", F.array().cast("array<string>"))
    else:
        near = past.where("score > 0.2").withColumn("r", F.row_number().over(Window.partitionBy("slot").orderBy("place"))).where("r <= 3")
        told = near.groupBy("slot").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "memory"))), lambda x: x["memory"]).alias("past"))
        rows = rows.join(told, "slot", "left").withColumn("past", F.coalesce("past", F.array().cast("array<string>")))
    some = lambda name, text, value: F.when(F.size(name) > 0, F.format_string(text, value))
    parts = F.concat_ws(" ", some("over", OVERUSED, listed(F.col("over"))), some("under", UNDERUSED, listed(F.col("under"))), some("past", SIMILAR, F.array_join("past", "; ")))
    return rows.select("slot", F.when(F.col("enough"), parts).otherwise("").alias("guidance"))


def parameter_text(required: Column) -> Column:
    """What an endpoint asks for: descriptions of at most 60 characters, else names, with an example or default; credentials and infrastructure are not told."""
    def one(p: Column) -> Column:
        about = F.coalesce(F.nullif(p["description"], F.lit("")), p["name"])
        shown = F.when(F.length(about) > 60, p["name"]).otherwise(about)
        example = F.coalesce(F.nullif(p["example_value"], F.lit("")), F.nullif(p["default"], F.lit("")))
        return F.when(example.isNull(), shown).otherwise(F.concat(shown, F.lit("="), example))

    return F.array_join(F.transform(F.filter(required, lambda p: ~T.scenario_param(p["name"], p["description"])), one), ", ")


def chain_text(chains: DataFrame, tools: DataFrame, endpoints: DataFrame) -> DataFrame:
    """``chains``: slot, step (from 1), tool_name, name; ``tools``: tool_name, description; ``endpoints``: tool_name, name, description,
    required (structs of name, description, default, example_value). slot, capabilities: a line a step, without names of tools.

    Each name stands for one tool and one endpoint; tables that repeat a name count by its greatest description."""
    known = tools.groupBy("tool_name").agg(F.max(F.coalesce("description", F.lit(""))).alias("tool_about"))
    of = endpoints.groupBy("tool_name", "name").agg(F.max(F.struct(F.coalesce("description", F.lit("")).alias("about"), parameter_text(F.col("required")).alias("accepts"))).alias("e"))
    rows = chains.join(of, ["tool_name", "name"], "left").join(known, "tool_name", "left")
    own = F.coalesce(T.short_description(F.coalesce(F.nullif("e.about", F.lit("")), "tool_about", F.lit(""))), F.lit(""))
    related = F.format_string(ACTION, F.coalesce(F.substring("tool_about", 1, 80), F.lit(SERVICE)))
    told = F.when(F.col("e.accepts") != "", F.concat(own, F.format_string(ACCEPTS, "e.accepts"))).when(F.col("e").isNotNull() & (own == ""), related).otherwise(own)
    line = F.concat(F.col("step").cast("string"), F.lit(". "), F.when(told == "", F.format_string(STEP, "step")).otherwise(told))
    return rows.groupBy("slot").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", line.alias("line")))), lambda x: x["line"]), "\n").alias("capabilities"))
