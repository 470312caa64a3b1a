"""Conversations as JSON lines: the wire form, the full form, and tool catalogues. All of it is column expressions over VARIANT."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import endpoint_parts
from ..functions.walk import let

CALL = "struct<tool:string,api:string,arguments:string>"
MESSAGE = f"struct<role:string,content:string,tool_calls:array<{CALL}>,tool_outputs:array<struct<tool:string,api:string,response:string>>>"
CONVERSATION = f"conversation_id string, messages array<{MESSAGE}>, naturalness double, tool_correctness double, task_completion double, metadata string"


def is_wire(line: Column) -> Column:
    """Messages, and no calls or outputs at the top level."""
    keys = F.json_object_keys(line)
    has = lambda k: F.coalesce(F.array_contains(keys, k), F.lit(False))
    return has("messages") & ~has("tool_calls") & ~has("tool_outputs")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't blank."""
    return spark.read.text(path).where(F.trim("value") != "")


OUTPUT = "struct<tool:string,api:string,response:string>"
ROLES = ("user", "system", "assistant")
SCORES = ("naturalness", "tool_correctness", "task_completion")


def _get(v: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{key}", kind)


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _items(v: Column) -> Column:
    return F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))


def _object(v: Column) -> Column:
    """An object's JSON text; of what is none, an empty one's."""
    return F.when(_is(v, "OBJECT"), F.to_json(v)).otherwise("{}")


def _said(v: Column) -> Column:
    """A content as text: JSON of what isn't text."""
    return F.when(_is(v, "VOID"), None).when(_is(v, "STRING"), v.cast("string")).otherwise(F.to_json(v))


def _message(role: Column, content: Column, calls: Column, outputs: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"), calls.cast(f"array<{CALL}>").alias("tool_calls"), outputs.cast(f"array<{OUTPUT}>").alias("tool_outputs"))


def _wire_messages(messages: Column) -> Column:
    """An assistant's k calls take up to k tool messages that follow at once, as one message of outputs; a tool message that no call takes is
    one of its own with the tool ``unknown``. Outputs that aren't objects are wrapped; unknown roles go."""
    void = F.lit(None)

    def calls(m: Column) -> Column:
        one = lambda c: F.coalesce(_get(c, "endpoint", "string"), F.lit(""))
        named = lambda c: let(F.struct(one(c).alias("endpoint"), _get(c, "arguments").alias("arguments")), lambda x: F.struct(endpoint_parts(x["endpoint"])[0].alias("tool"), endpoint_parts(x["endpoint"])[1].alias("api"), _object(x["arguments"]).alias("arguments")))
        return F.when(_get(m, "role", "string") == "assistant", F.transform(_items(_get(m, "tool_calls")), named)).otherwise(F.array().cast(f"array<{CALL}>"))

    def response(m: Column) -> Column:
        said = lambda x: F.when(x["kind"].isNull() | x["kind"].startswith("VOID"), "{}").when(x["kind"].startswith("OBJECT"), F.to_json(x["v"])).otherwise(F.concat(F.lit('{"result":'), F.to_json(x["v"]), F.lit("}")))
        return let(_get(m, "content"), lambda v: let(F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")), said))

    output = lambda name, api, m: F.struct(name.alias("tool"), api.alias("api"), response(m).alias("response"))

    def spoken(m: Column, i: Column, mine: Column, tool: Column) -> Column:
        after = F.slice(messages, i + 2, F.size(mine))
        stop = F.array_position(F.slice(tool, i + 2, F.size(mine)), False)
        taken = F.when(stop > 0, F.slice(after, F.lit(1), (stop - 1).cast("int"))).otherwise(after)
        outputs = F.transform(taken, lambda t, j: output(F.get(mine, j)["tool"], F.get(mine, j)["api"], t))
        own = F.array(_message(_get(m, "role", "string"), let(_get(m, "content"), _said), F.when(F.size(mine) > 0, mine), void))
        told = F.transform(F.filter(F.array(outputs), lambda x: F.size(x) > 0), lambda x: _message(F.lit("tool"), void.cast("string"), void, x))
        return F.concat(own, told.cast(f"array<{MESSAGE}>"))

    def alone(i: Column, made: Column, tool: Column) -> Column:
        """Whether the calls before are too few for this tool message: it is further from the last other message than that has calls."""
        back = F.array_position(F.reverse(F.slice(tool, F.lit(1), i)), False).cast("int")
        return (back == 0) | (back > F.size(F.get(made, i - F.greatest(back, F.lit(1)))))

    orphan = lambda m: F.array(_message(F.lit("tool"), void.cast("string"), void, F.array(output(F.lit("unknown"), F.lit("unknown"), m))))
    nothing = F.array().cast(f"array<{MESSAGE}>")

    def all_of(made: Column, tool: Column) -> Column:
        each = lambda m, i: F.when(F.get(tool, i), F.when(alone(i, made, tool), orphan(m)).otherwise(nothing)).when(_get(m, "role", "string").isin(*ROLES), spoken(m, i, F.get(made, i), tool)).otherwise(nothing)
        return F.flatten(F.transform(messages, each))

    is_tool = F.transform(messages, lambda m: F.coalesce(_get(m, "role", "string") == "tool", F.lit(False)))
    return let(F.struct(F.transform(messages, calls).alias("made"), is_tool.alias("tool")), lambda x: all_of(x["made"], x["tool"]))


def _full_messages(messages: Column) -> Column:
    """Calls and outputs are objects of their own."""
    text = lambda v, key: F.when(_is(_get(v, key), "VOID"), None).otherwise(_get(v, key, "string"))
    call = lambda c: F.struct(text(c, "tool_name").alias("tool"), text(c, "api_name").alias("api"), _object(_get(c, "arguments")).alias("arguments"))
    out = lambda o: F.struct(text(_get(o, "tool_call"), "tool_name").alias("tool"), text(_get(o, "tool_call"), "api_name").alias("api"), _object(_get(o, "response")).alias("response"))
    some = lambda m, key, f: F.when(_is(_get(m, key), "ARRAY"), F.transform(_items(_get(m, key)), f))
    return F.transform(messages, lambda m: _message(_get(m, "role", "string"), _said(_get(m, "content")), some(m, "tool_calls", call), some(m, "tool_outputs", out)))


def sorted_lines(rows: DataFrame, full: bool = True) -> DataFrame:
    """``rows``: value. Each line that isn't blank with its conversation, or with the ``reason`` why it is none: no JSON object, a message that
    is none, and in the full form (``full``: where a line isn't in the wire form) unknown roles, calls without names, and scores that are
    missing or beyond 1 to 5. Missing scores of the wire form are 3, its missing id is ``conv_unknown``; in the full form it stays null."""
    parsed = rows.where(F.trim(F.coalesce("value", F.lit(""))) != "").select("value").withColumn("v", F.try_parse_json("value"))
    given = parsed.withColumns({"m": _items(_get(F.col("v"), "messages")), "wire": is_wire(F.col("value")) if full else F.lit(True), "s": _get(F.col("v"), "judge_scores")})
    scored = F.col("s").isNotNull() & ~_is(F.col("s"), "VOID")
    score = lambda k: _get(F.col("s"), k, "double")
    bad_score = scored & ~F.coalesce(F.least(*map(score, SCORES)).between(1, 5) & F.greatest(*map(score, SCORES)).between(1, 5) & F.forall(F.array(*[score(k).isNotNull() for k in SCORES]), lambda x: x), F.lit(False))
    read = given.withColumn("messages", F.when(F.col("wire"), _wire_messages(F.col("m"))).otherwise(_full_messages(F.col("m"))))
    lacks = lambda xs: F.coalesce(F.exists(xs, lambda c: c["tool"].isNull() | c["api"].isNull()), F.lit(False))
    unnamed = F.exists("messages", lambda m: lacks(m["tool_calls"]) | lacks(m["tool_outputs"]))
    odd = F.exists("m", lambda m: ~F.coalesce(_get(m, "role", "string").isin(*ROLES, "tool"), F.lit(False)))
    reason = (
        F.when(~_is(F.col("v"), "OBJECT"), "no JSON object").when(F.exists("m", lambda m: ~_is(m, "OBJECT")), "a message is no object")
        .when(~F.col("wire") & odd, "unknown role").when(~F.col("wire") & unnamed, "a call without names").when(~F.col("wire") & bad_score, "scores are from 1 to 5")
    )
    own = _get(F.col("v"), "conversation_id")
    id_ = F.when(own.isNull() | _is(own, "VOID"), F.when(F.col("wire"), "conv_unknown")).otherwise(own.cast("string"))
    marks = [F.when(scored, F.coalesce(score(k), F.lit(3.0))).alias(k) for k in SCORES]
    return read.select("value", reason.alias("reason"), id_.alias("conversation_id"), "messages", *marks, _object(_get(F.col("v"), "metadata")).alias("metadata"))


def read_wire(rows: DataFrame) -> DataFrame:
    """``rows``: value, in the wire form. Lines that aren't are left out (see ``rejected``)."""
    return sorted_lines(rows, full=False).where("reason is null").drop("value", "reason")


def read_any(rows: DataFrame) -> DataFrame:
    """``rows``: value, each in the wire form or the full form. Blank lines and those that are valid in neither are left out (see ``rejected``)."""
    return sorted_lines(rows).where("reason is null").drop("value", "reason")


def rejected(rows: DataFrame, full: bool = True) -> DataFrame:
    """value, reason: the lines that ``read_any`` (``full``) or ``read_wire`` leaves out."""
    return sorted_lines(rows, full).where("reason is not null").select("value", "reason")


def unanswered(conversations: DataFrame) -> DataFrame:
    """conversation_id, msg_idx, tool, api, response: an error result for each call that no output answers; the calls of a message go in order with the outputs of the tool message after it."""
    after = F.transform("messages", lambda m, i: F.struct(i.alias("msg_idx"), m["tool_calls"].alias("calls"), F.coalesce(F.when(F.get("messages", i + 1)["role"] == "tool", F.size(F.get("messages", i + 1)["tool_outputs"])), F.lit(0)).alias("n")))
    rows = conversations.select("conversation_id", F.explode(after).alias("x")).select("conversation_id", "x.msg_idx", F.explode(F.slice("x.calls", F.col("x.n") + 1, F.greatest(F.size("x.calls"), F.lit(1)))).alias("c"))
    return rows.select("conversation_id", "msg_idx", "c.tool", "c.api", F.lit('{"error":"no result"}').alias("response"))


def invariants(conversations: DataFrame, most: int = 3) -> DataFrame:
    """conversation_id, empty_messages, orphan_outputs, unanswered_calls, deepest (rounds of calls without a user's word between), sound: what a
    conversation must keep to. ``most`` rounds are allowed."""
    m = F.col("messages")
    n = lambda f: F.size(F.filter(m, f))
    calls = F.coalesce(F.aggregate(m, F.lit(0), lambda s, x: s + F.coalesce(F.size(x["tool_calls"]), F.lit(0)) * F.lit(1)), F.lit(0))
    outputs = F.aggregate(m, F.lit(0), lambda s, x: s + F.size(F.filter(F.coalesce(x["tool_outputs"], F.array().cast(f"array<{OUTPUT}>")), lambda o: o["tool"] != "unknown")))
    rounds = F.aggregate(m, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda s, x: _deeper(s, F.when(x["role"] == "user", 0).when(F.coalesce(F.size(x["tool_calls"]), F.lit(0)) > 0, s["now"] + 1).otherwise(s["now"])))["most"]
    rows = conversations.select(
        "conversation_id", n(lambda x: (x["role"] != "tool") & (F.coalesce(F.trim(x["content"]), F.lit("")) == "") & x["tool_calls"].isNull()).alias("empty_messages"),
        n(lambda x: F.exists(x["tool_outputs"], lambda o: o["tool"] == "unknown")).alias("orphan_outputs"), (calls - outputs).alias("unanswered_calls"), rounds.alias("deepest"),
    )
    return rows.withColumn("sound", F.expr(f"empty_messages = 0 and orphan_outputs = 0 and unanswered_calls <= 0 and deepest <= {most}"))


def _deeper(s: Column, now: Column) -> Column:
    return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))


def _quoted(text: Column) -> Column:
    """A text as JSON."""
    return F.when(text.isNull(), "null").otherwise(F.to_json(text.cast("variant")))


def to_wire(conversations: DataFrame) -> DataFrame:
    """value: one JSON line a conversation. Calls name ``tool/api``; each output is a tool message of its own; null
    contents are written, absent calls and scores are not."""
    call = lambda c: F.concat(F.lit('{"endpoint":'), _quoted(F.concat_ws("/", c["tool"], c["api"])), F.lit(',"arguments":'), F.coalesce(c["arguments"], F.lit("{}")), F.lit("}"))
    calls = lambda m: F.when(F.size(m["tool_calls"]) > 0, F.concat(F.lit(',"tool_calls":['), F.array_join(F.transform(m["tool_calls"], call), ","), F.lit("]"))).otherwise("")
    said = lambda m: F.array(F.concat(F.lit('{"role":'), _quoted(m["role"]), F.lit(',"content":'), _quoted(m["content"]), calls(m), F.lit("}")))
    told = lambda m: F.transform(F.coalesce(m["tool_outputs"], F.array().cast(f"array<{OUTPUT}>")), lambda o: F.concat(F.lit('{"role":"tool","content":'), o["response"], F.lit("}")))
    messages = F.array_join(F.flatten(F.transform("messages", lambda m: F.when(m["role"] == "tool", told(m)).otherwise(said(m)))), ",")
    scores = F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), F.col(k).cast("string")) for k in SCORES])
    judged = F.when(F.forall(F.array(*[F.col(k).isNotNull() & ~F.isnan(k) for k in SCORES]), lambda x: x), F.concat(F.lit(',"judge_scores":{'), scores, F.lit("}"))).otherwise("")
    meta = F.when(F.coalesce("metadata", F.lit("{}")) != "{}", F.concat(F.lit(',"metadata":'), "metadata")).otherwise("")
    return conversations.select(F.concat(F.lit('{"conversation_id":'), _quoted(F.col("conversation_id")), F.lit(',"messages":['), messages, F.lit("]"), judged, meta, F.lit("}")).alias("value"))


def merge_responses(tools: DataFrame, examples: DataFrame) -> DataFrame:
    """``tools``: category, stem, api, schema; ``examples``: category, stem, api, schema, and ``place`` if several name one. Missing schemas are filled; the last example counts."""
    last = F.max_by("schema", "place") if "place" in examples.columns else F.max("schema")
    found = examples.groupBy("category", "stem", "api").agg(last.alias("example"))
    return tools.join(found, ["category", "stem", "api"], "left").select("category", "stem", "api", F.coalesce(F.nullif("schema", F.lit("")), "example").alias("schema"))


def _kept(files: DataFrame) -> DataFrame:
    """``files``: path, value. Those that name a tool or its endpoints: category (the folder), stem, definition (with the stem for a standard name, if it has none)."""
    keys = F.json_object_keys("value")
    kept = files.where(F.array_contains(keys, "api_list") | F.array_contains(keys, "tool_name"))
    stem = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    lacks = F.get_json_object("value", "$.standardized_name").isNull() & ~F.array_contains(keys, "standardized_name")
    named = F.concat(F.regexp_replace("value", r"\}\s*$", ""), F.lit(',"standardized_name":'), F.to_json(stem.cast("variant")), F.lit("}"))
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    filed = F.concat(F.regexp_replace("d", r"\}\s*$", ""), F.lit(',"category":'), F.to_json(folder.cast("variant")), F.lit("}"))
    given = kept.select("path", folder.alias("category"), stem.alias("stem"), F.when(lacks, named).otherwise(F.col("value")).alias("d"))
    return given.select("category", "stem", F.when(~F.array_contains(F.json_object_keys("d"), "category"), filed).otherwise(F.col("d")).alias("definition"), "path")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Tool files laid out as <category>/<stem>.json: category, stem, definition (JSON text), path. Broken files and
    those that name neither a tool nor its endpoints are left out."""
    return _kept(spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(F.col("_metadata.file_path").alias("path"), "value"))


def read_archives(spark: SparkSession, path: str, inner: str = "data/toolenv/") -> DataFrame:
    """The same of the tool files below the folder ``inner`` of zip archives at ``path``. An archive is read where Spark's reader has it and opened a member at a
    time; broken archives give nothing. An archive is one row, so 2 GB at most."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                with archive:
                    for name in archive.namelist():
                        if name.startswith(inner) and name.endswith(".json"):
                            text = archive.read(name).decode(errors="replace")
                            yield pa.RecordBatch.from_arrays([pa.array([f"{where}/{name}"]), pa.array([text])], names=["path", "value"])

    archives = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return _kept(archives.select("path", "content").mapInArrow(members, "path string, value string"))


def numbered(files: DataFrame) -> DataFrame:
    """``files`` as of ``read_catalogue`` with a tool_id for ``catalogue.parse``: a hash of the path."""
    return files.withColumn("tool_id", F.xxhash64("path"))
