"""The driver's tables in the roles that the operators work on."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt to four tasks a core: a file of few bytes is one task, however much work its rows make. Spark moves filters to before
    the dealing; where they hold the work, ``cut`` keeps them behind."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, tool, api, endpoint: a line item is a call of its part's brand and type."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tool"), F.col("p_type").alias("api"))
    out = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey")
    return out.select(F.col("l_orderkey").alias("conv_id"), "tool", "api", F.concat_ws("/", "tool", "api").alias("endpoint"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, type, run: an order is a conversation; its priority the type."""
    run = F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B")
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("conv_id"), F.col("o_orderpriority").alias("type"), run.alias("run"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, category: the distinct regions of a conversation's suppliers."""
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("category"))
    supplier = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "category")
    return read(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("conv_id"), "category").distinct()


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and three scores, null where a document has no label."""
    labels = read(spark, sf_dir, "labels")
    d = read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    known = F.col("quality").isNotNull()
    return d.select(F.col("doc_id").alias("conv_id"), (1 + 4.0 * F.col("quality")).alias("naturalness"), F.when(known, F.lit(3.0)).alias("tool_correctness"), (5 - 4.0 * F.col("toxic")).alias("task_completion"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("msg_idx"), "role", F.col("text").alias("content"))


def json_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id (user and day), call_idx, arguments, response (JSON texts): an event is a call."""
    e = read(spark, sf_dir, "events").select(F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("conv_id"), "ts", "event_id", "props")
    order = Window.partitionBy("conv_id").orderBy("ts", "event_id")
    return e.select("conv_id", (F.row_number().over(order) - 1).alias("call_idx"), F.col("props").alias("arguments"), F.col("props").alias("response"))


def nested_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """json_calls with typed arguments, and responses that hold them two levels down in a list."""
    e = dealt(read(spark, sf_dir, "events"), "event_id").select(F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("conv_id"), "ts", "event_id", F.get_json_object("props", "$.k").alias("k"))
    order = Window.partitionBy("conv_id").orderBy("ts", "event_id")
    odd = F.col("event_id") % 2 == 1
    args = F.when(odd, F.concat(F.lit('{"id":"'), "k", F.lit('","n":"'), "k", F.lit('_x"}'))).otherwise(F.concat(F.lit('{"id":'), "k", F.lit(',"ok":true}')))
    response = F.concat(F.lit('{"dataSet":{"items":[{"itemId":'), F.when(odd, F.concat(F.lit('"'), "k", F.lit('_x"'))).otherwise(F.col("k")), F.lit('},{"itemId":"'), "k", F.lit('"}]},"tags":["a",""],"none":null,"open":false}'))
    return e.select("conv_id", "event_id", (F.row_number().over(order) - 1).alias("call_idx"), args.alias("arguments"), response.alias("response"))


def tool_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tool_id, definition: a part as a tool in JSON, in the forms that catalogues have them in."""
    k, q = F.col("p_partkey"), lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    params = F.when(k % 3 == 0, F.lit('"[{\\"name\\":\\"hotel_id\\",\\"type\\":\\"NUMBER\\"}]"')).when(k % 3 == 1, F.lit('[{"name":"userName","type":"DATE (YYYY)","description":"<b>who</b>"},{"name":" "},7]')).otherwise(F.lit('["{\\"name\\":\\"page\\",\\"type\\":\\"INTEGER\\"}","no json"]'))
    kinds = F.when(k % 4 == 0, "search rooms").when(k % 4 == 1, "book room").when(k % 4 == 2, "cancel_room").otherwise("room info")
    first = F.concat(F.lit('{"name":"'), kinds, F.lit('","method":"'), F.when(k % 2 == 0, "post").otherwise("fetch"), F.lit('","required_parameters":'), params, F.lit(',"optional_parameters":null,"description":'), q(F.col("p_type")), F.lit("}"))
    second = F.concat(F.lit('{"name":"given","schema":{"type":"object","properties":{"size":{"type":"integer"}}},"required_parameters":[]}'))
    lists = F.when(k % 7 == 0, F.lit('[{"name":""}]')).otherwise(F.concat(F.lit("["), first, F.lit(","), second, F.lit("]")))
    name = F.when(k % 11 == 0, F.lit('" "')).otherwise(q(F.concat(F.lit(" "), "p_name", F.lit(" "))))
    text = F.concat(F.lit('{"tool_name":'), name, F.lit(',"category":" c'), (k % 5).cast("string"), F.lit('","tool_description":'), F.when(k % 2 == 0, '""').otherwise(q(F.concat(F.lit("<p>"), "p_brand"))), F.lit(',"api_list":'), lists, F.lit("}"))
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return cut(dealt(rows, "p_partkey")).select(k.alias("tool_id"), F.when(k % 13 == 0, F.substring(text, 1, 20)).otherwise(text).alias("definition"))


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """endpoint, tool, category, kind (output or input), field: every word of a document's whole text, in lower case. Inputs are those
    that are capitalised somewhere, outputs the others; the documents of a source make tools of a hundred ids each."""
    source = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    tool = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string"))
    category = F.concat(F.lit("c"), (source % 5).cast("string"))
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("endpoint"), tool.alias("tool"), category.alias("category"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(docs: pa.RecordBatch, ends: list[int], given: list[bool], names: list[bytes]) -> pa.RecordBatch:
            words = pa.StructArray.from_arrays([pa.array(given, pa.bool_()), pa.array(names, pa.binary()).cast(pa.string())], names=["given", "field"])
            return pa.RecordBatch.from_arrays([*docs.select(["endpoint", "tool", "category"]).columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)], names=["endpoint", "tool", "category", "words"])

        for batch in batches:
            first, ends, given, names = 0, [0], [], []
            for i, text in enumerate(batch.column("text")):
                words = set((text.as_py() or b"").replace(b"\n", b" ").split(b" ")) - {b""}
                capital = {w for w in words if b"A" <= w[:1] <= b"Z"}
                inputs = {w.lower() for w in capital}  # of bytes: A-Z alone
                outputs = {w.lower() for w in words - capital} - inputs
                names += [*outputs, *inputs]
                given += [False] * len(outputs) + [True] * len(inputs)
                ends.append(len(names))
                if len(names) > 100_000:
                    yield rows(batch.slice(first, i + 1 - first), ends, given, names)
                    first, ends, given, names = i + 1, [0], [], []
            yield rows(batch.slice(first), ends, given, names)

    kind = {f.name: f.dataType.simpleString() for f in d.schema}
    found = d.mapInArrow(run, f"endpoint {kind['endpoint']}, tool string, category string, words array<struct<given: boolean, field: string>>")
    # A document's words travel in one row, so that its keys do not travel with each.
    return found.select("endpoint", "tool", "category", F.inline("words")).select("endpoint", "tool", "category", F.when(F.col("given"), "input").otherwise("output").alias("kind"), "field")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("category"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tool_id, category, score: candidates of a selection."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("tool_id"), F.col("p_type").alias("category"), F.round(F.col("p_retailprice") + F.col("p_size"), 2).alias("score"), F.col("p_name").alias("name"), "p_brand")


SQL = {
    "calls": "calls AS (SELECT l_orderkey AS conv_id, p_brand AS tool, p_type AS api, p_brand || '/' || p_type AS endpoint FROM lineitem JOIN part ON l_partkey = p_partkey)",
    "convs": "convs AS (SELECT o_orderkey AS conv_id, o_orderpriority AS type, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS run FROM orders)",
    "cats": "cats AS (SELECT DISTINCT l_orderkey AS conv_id, r_name AS category FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)",
    "scores": "scores AS (SELECT d.doc_id AS conv_id, 1 + 4.0 * quality AS naturalness, CASE WHEN quality IS NOT NULL THEN 3.0 END AS tool_correctness, 5 - 4.0 * toxic AS task_completion FROM documents d LEFT JOIN labels USING (doc_id))",
    "msgs": "msgs AS (SELECT conv_id, turn AS msg_idx, role, text AS content FROM conversations)",
    "jcalls": "jcalls AS (SELECT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS conv_id, row_number() OVER (PARTITION BY CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) - 1 AS call_idx, props AS arguments, props AS response FROM events)",
    "ncalls": "nc0 AS (SELECT *, CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS conv_id, json_extract_string(props, '$.k') AS k FROM events), ncalls AS (SELECT conv_id, event_id, row_number() OVER (PARTITION BY conv_id ORDER BY ts, event_id) - 1 AS call_idx, "
    "CASE WHEN event_id % 2 = 1 THEN '{\"id\":\"' || k || '\",\"n\":\"' || k || '_x\"}' ELSE '{\"id\":' || k || ',\"ok\":true}' END AS arguments, "
    "'{\"dataSet\":{\"items\":[{\"itemId\":' || CASE WHEN event_id % 2 = 1 THEN '\"' || k || '_x\"' ELSE k END || '},{\"itemId\":\"' || k || '\"}]},\"tags\":[\"a\",\"\"],\"none\":null,\"open\":false}' AS response FROM nc0)",
    "fields": "w0 AS (SELECT doc_id AS endpoint, source || '/' || CAST(doc_id // 100 AS VARCHAR) AS tool, 'c' || CAST(CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 5 AS VARCHAR) AS category, list_filter(list_distinct(string_split_regex(text, '[ \\n]+')), lambda x: x <> '') AS w FROM documents), "
    "w1 AS (SELECT endpoint, tool, category, list_distinct(list_transform(list_filter(w, lambda x: NOT regexp_matches(x, '^[A-Z]')), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS o, list_distinct(list_transform(list_filter(w, lambda x: regexp_matches(x, '^[A-Z]')), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS i FROM w0), "
    "fields AS (SELECT endpoint, tool, category, 'output' AS kind, unnest(list_filter(o, lambda x: NOT list_contains(i, x))) AS field FROM w1 UNION ALL SELECT endpoint, tool, category, 'input', unnest(i) FROM w1)",
    "reg": "reg AS (SELECT p_partkey AS tool_id, p_type AS category, round(p_retailprice + p_size, 2) AS score, p_name AS name, p_brand FROM part)",
}


def sql(*names: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}" + ", ".join(SQL[n] for n in names)
