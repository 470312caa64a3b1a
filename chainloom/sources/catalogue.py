"""Catalogues of tools: from JSON definitions to typed endpoints, kept as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

TOOL = "tool_name string, standardized_name string, tool_description string, category string, api_list array<string>"
ENDPOINT = "name string, url string, description string, method string, required_parameters string, optional_parameters string, schema string"
PARAMETER = "name string, type string, description string, default string, example_value string"
#: Parts of an endpoint's name that tell what it does.
SEARCHES, CREATES, DELETES = ("search", "find", "list", "query", "get_all"), ("book", "create", "register", "order", "add"), ("delete", "remove", "cancel")
CHANGES = ("POST", "PUT", "PATCH", "DELETE")


def parameters(raw: Column) -> Column:
    """Parameters with a name, from a JSON list of objects, of JSON texts of objects, or a JSON text of either.

    An element of another kind has no name and goes. Nested JSON reads as text, so all forms are one."""
    items = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))
    parsed = F.transform(items, lambda x: F.from_json(x, PARAMETER))
    named = F.filter(parsed, lambda p: F.trim(F.coalesce(p["name"], F.lit(""))) != "")

    def clean(p: Column) -> Column:
        told = lambda name: T.let(T.clean_description(p["description"]), lambda d: F.when(d == "", T.human_name(name)).otherwise(d))
        name = F.trim(p["name"])
        return F.struct(name.alias("name"), T.normal_type(F.coalesce(p["type"], F.lit(""))).alias("type"), told(name).alias("description"), p["default"].alias("default"), p["example_value"].alias("example_value"))

    return F.transform(named, clean)


def given_schema(raw: Column) -> Column:
    """A JSON object with keys, as text; anything else: null."""
    return F.when(F.size(F.json_object_keys(raw)) > 0, raw)


def _properties(pairs: Column) -> Column:
    """A JSON object of names and types from (name, type) pairs; of equal names the last counts."""
    last = lambda given: F.filter(given, lambda p, i: ~F.exists(F.slice(given, i + 2, F.size(given)), lambda q: q["name"] == p["name"]))
    quoted = lambda name: F.regexp_replace(F.to_json(F.array(name)), r"^\[|\]$", "")
    return F.concat(F.lit("{"), F.array_join(F.transform(T.let(pairs, last), lambda p: F.concat(quoted(p["name"]), F.lit(':{"type":"'), p["type"], F.lit('"}'))), ","), F.lit("}"))


def inferred_schema(name: Column, method: Column, params: Column) -> Column:
    """A plausible response schema (JSON text) from an endpoint's name, method and parameters."""
    pair = lambda n, kind="string": F.struct((F.lit(n) if isinstance(n, str) else n).alias("name"), F.lit(kind).alias("type"))
    lower = F.lower(name)
    has = lambda words: F.lower(name).rlike("|".join(words))
    own = F.transform(params, lambda p: F.struct(p["name"].alias("name"), p["type"].alias("type")))
    ids = F.filter(params, lambda p: F.lower(p["name"]).endswith("_id") | (F.lower(p["name"]) == "id"))
    entity = lambda p: F.when(F.lower(p["name"]) == "id", "item").otherwise(F.replace(F.lower(p["name"]), F.lit("_id"), F.lit("")))
    entities = F.concat(own, F.transform(ids, lambda p: pair(F.concat(entity(p), F.lit("_name")))))
    without = lambda given: ~F.exists(given, lambda p: (p["name"] == "id") | p["name"].endswith("_id"))
    entities = T.let(entities, lambda given: F.when(without(given), F.array_append(given, pair("id"))).otherwise(given))
    words = F.filter(F.split(F.replace(lower, F.lit("_"), F.lit(" ")), r"\s+"), lambda w: w != "")
    made = F.when(F.size(words) > 1, F.element_at(words, -1)).otherwise("item")
    whole = lambda inner: F.concat(F.lit('{"type":"object","properties":'), inner, F.lit("}"))
    found = F.concat(F.lit('{"results":{"type":"array","items":'), whole(_properties(entities)), F.lit('},"total_count":{"type":"integer"},"status":{"type":"string"}}'))
    return (
        F.when(has(SEARCHES), whole(found))
        .when(has(CREATES), whole(_properties(F.concat(F.array(pair(F.concat(made, F.lit("_id"))), pair("status"), pair("created_at")), entities))))
        .when(has(DELETES), whole(_properties(F.array(pair("status"), pair("message")))))
        .when(method.isin(*CHANGES), whole(_properties(F.concat(F.array(pair("status")), entities))))
        .otherwise(whole(_properties(F.array_append(entities, pair("status")))))
    )


def parse(definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``definitions``: tool_id, definition (JSON text). Tools (tool_id, tool_name, standardized_name, description, category,
    n_endpoints) and endpoints (tool_id, pos, tool_name, name, url, description, method, required, optional, schema, given).

    Tools without a name or without an endpoint that has one go, as do definitions that aren't JSON."""
    raw = definitions.select("tool_id", F.from_json("definition", TOOL).alias("t")).where(F.trim(F.coalesce("t.tool_name", F.lit(""))) != "")
    each = raw.select("tool_id", F.trim("t.tool_name").alias("tool_name"), F.posexplode("t.api_list").alias("pos", "api")).select("tool_id", "tool_name", "pos", F.from_json("api", ENDPOINT).alias("e"))
    each = each.where(F.trim(F.coalesce("e.name", F.lit(""))) != "")
    method = T.normal_method(F.coalesce("e.method", F.lit("GET")))
    typed = each.select("tool_id", "tool_name", "pos", F.trim("e.name").alias("name"), F.coalesce("e.url", F.lit("")).alias("url"), T.clean_description(F.col("e.description")).alias("description"), method.alias("method"), parameters(F.col("e.required_parameters")).alias("required"), parameters(F.col("e.optional_parameters")).alias("optional"), given_schema(F.col("e.schema")).alias("own"))
    schema = F.coalesce("own", T.let(F.concat("required", "optional"), lambda given: inferred_schema(F.col("name"), F.col("method"), given)))
    endpoints = typed.select(*typed.columns[:-1], schema.alias("schema"), F.col("own").isNotNull().alias("given"))
    # A tool's own description, else the first three of its endpoints'.
    described = F.array_sort(F.collect_list(F.when(F.col("description") != "", F.struct("pos", "description"))))
    per_tool = endpoints.groupBy("tool_id").agg(F.count(F.lit(1)).alias("n_endpoints"), described.alias("d"))  # a tool's endpoints
    more = F.when(F.size("d") > 3, F.format_string(" (and %d more)", F.size("d") - 3)).otherwise("")
    told = F.concat(F.array_join(F.transform(F.slice("d", 1, 3), lambda x: x["description"]), "; "), more)
    made = F.when(F.size("d") > 0, told).otherwise(F.format_string("Tool providing %d API endpoint(s)", "n_endpoints"))
    own = T.clean_description(F.col("t.tool_description"))
    tools = raw.join(per_tool, "tool_id").select("tool_id", F.trim("t.tool_name").alias("tool_name"), F.coalesce("t.standardized_name", T.standard_name(F.trim("t.tool_name"))).alias("standardized_name"), F.when(own == "", made).otherwise(own).alias("description"), F.trim(F.coalesce("t.category", F.lit(""))).alias("category"), "n_endpoints")
    return tools, endpoints


def quarantine(definitions: DataFrame) -> DataFrame:
    """tool_id, tool_name, place, reason: what ``parse`` leaves out, of the same definitions. ``place`` is null for a whole tool, else the position in its list."""
    rows = definitions.select("tool_id", F.try_parse_json("definition").alias("v"), F.from_json("definition", TOOL).alias("t")).withColumn("list", F.coalesce("t.api_list", F.array().cast("array<string>")))
    named = F.transform("list", lambda x: F.trim(F.coalesce(F.from_json(x, ENDPOINT)["name"], F.lit(""))) != "")
    rows = rows.withColumn("named", named).withColumn("tool_name", F.trim(F.coalesce("t.tool_name", F.lit(""))))
    json_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    whole = F.when(~json_object, "no JSON object").when(F.col("tool_name") == "", "no name").when(~F.exists("named", lambda x: x), "no endpoint with a name")
    rows = rows.withColumn("whole", whole)
    places = F.when(F.col("whole").isNotNull(), F.array(F.struct(F.lit(None).cast("int").alias("place"), F.col("whole").alias("reason")))).otherwise(F.filter(F.transform("named", lambda x, i: F.when(~x, F.struct(i.cast("int").alias("place"), F.lit("an endpoint without a name").alias("reason")))), lambda x: x.isNotNull()))
    return rows.select("tool_id", "tool_name", F.explode(places).alias("x")).select("tool_id", "tool_name", "x.place", "x.reason")


def save(tables: dict[str, DataFrame], path: str) -> None:
    """A registry (tools, endpoints) or a graph (nodes, edges): a Parquet table each."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str, names: tuple[str, ...] = ("tools", "endpoints")) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def is_cached(spark: SparkSession, path: str) -> bool:
    """Whether a table is there and has rows."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def cached_or_parsed(spark: SparkSession, path: str, raw: DataFrame, force: bool = False) -> dict[str, DataFrame]:
    """The registry at ``path``; parsed from ``raw`` and kept there if it isn't yet, or if asked to."""
    if force or not is_cached(spark, f"{path}/tools"):
        tools, endpoints = parse(raw)
        save({"tools": tools, "endpoints": endpoints}, path)
    return load(spark, path)


def find_tools(tools: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``: tool_name. A row each, null where there is no such tool; of tools with one name the last counts."""
    last = tools.withColumn("r", F.row_number().over(Window.partitionBy("tool_name").orderBy(F.desc("tool_id")))).where("r = 1").drop("r")
    return wanted.join(last, "tool_name", "left")


def find_endpoints(endpoints: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``: tool_name, name. A row each, null where there is no such endpoint; the last of one name counts."""
    order = Window.partitionBy("tool_name", "name").orderBy(F.desc("tool_id"), F.desc("pos"))
    return wanted.join(endpoints.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r"), ["tool_name", "name"], "left")


def by_category(tools: DataFrame) -> DataFrame:
    """category (``uncategorized`` if empty), tool_id, tool_name."""
    return tools.select(F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("uncategorized")).alias("category"), "tool_id", "tool_name")


def shown_graph(nodes: DataFrame, edges: DataFrame, most: int = 2000) -> tuple[DataFrame, DataFrame]:
    """``nodes``: id, node_type; ``edges``: src, dst, edge_type. What a picture of the graph holds: all of a small graph; of a larger one
    categories, tools, endpoints and both ends of flows, and edges between them."""
    large = nodes.agg((F.count(F.lit(1)) > most).alias("large"))
    flows = edges.where("edge_type = 'feeds_into'")
    ends = flows.select(F.col("src").alias("id")).union(flows.select("dst")).distinct().withColumn("flows", F.lit(True))
    kept = nodes.join(ends, "id", "left").join(F.broadcast(large)).where(~F.col("large") | F.col("flows") | F.col("node_type").isin("category", "tool", "endpoint")).select("id", "node_type")  # large: one row
    both = edges.join(kept.select(F.col("id").alias("src")), "src", "left_semi").join(kept.select(F.col("id").alias("dst")), "dst", "left_semi")
    return kept, both.select("src", "dst", "edge_type")
