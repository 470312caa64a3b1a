"""All queries over the driver's tables, with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..functions.lineage import cut
from ..functions import walk as W
from ..operators import definitions as DF
from ..operators import dialogue as D
from ..operators import graph as G
from ..operators import guidance as GU
from ..operators import metrics as M
from ..operators import planning as P
from ..operators import sampling as S
from ..operators import selection as Q
from ..operators import transitions as X
from ..operators import turns as TU
from ..sources import catalogue as C
from ..sources import wire
from ..streaming import counting as ST
from . import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _size(spark: SparkSession, d: str) -> DataFrame:
    return B.read(spark, d, "part").agg(F.count_distinct("p_brand", "p_type").alias("n"))


# Metrics

_H = "CASE WHEN count(*) <= 1 THEN 0.0 ELSE log2(sum(n)) - sum(n * log2(n)) / sum(n) END"
_SIGS = "sets AS (SELECT conv_id, list_sort(list_distinct(list(endpoint))) AS s FROM calls GROUP BY conv_id), sigs AS (SELECT c.*, coalesce(s, []) AS signature FROM convs c LEFT JOIN sets USING (conv_id))"
_PER = "per AS (SELECT c.*, coalesce(n_calls, 0) AS n_calls, coalesce(n_tools, 0) AS n_tools, coalesce(n_endpoints, 0) AS n_endpoints FROM convs c LEFT JOIN (SELECT conv_id, count(*) AS n_calls, count(DISTINCT tool) AS n_tools, count(DISTINCT endpoint) AS n_endpoints FROM calls GROUP BY conv_id) USING (conv_id))"
_USAGE = f"(SELECT round(CASE WHEN count(*) <= 1 THEN 0.0 ELSE ({_H}) / log2(count(*)) END, 9) FROM (SELECT endpoint, count(*) AS n FROM calls GROUP BY endpoint))"
_UNIQUE = "(SELECT count(DISTINCT endpoint) FROM calls)"
_REG = "(SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part))"
_TOP5 = "(SELECT round(sum(n) FILTER (r <= 5) / sum(n), 9) FROM (SELECT n, row_number() OVER (ORDER BY n DESC, endpoint) AS r FROM (SELECT endpoint, count(*) AS n FROM calls GROUP BY endpoint)))"
_COMBO = f"(SELECT round({_H}, 9) FROM (SELECT signature, count(*) AS n FROM sigs GROUP BY signature))"
_DOMAIN = f"(SELECT round(({_H}) / log2(count(*)), 9) FROM (SELECT category, count(*) AS n FROM cats GROUP BY category))"


@query(f"{B.sql('calls')} SELECT {_USAGE} AS usage_entropy")
def usage_entropy(spark, d):
    return M.usage_entropy(B.calls(spark, d))


@query(f"{B.sql('calls')} SELECT {_UNIQUE} AS unique_tools_used")
def unique_tools(spark, d):
    return M.unique_tools(B.calls(spark, d))


@query(f"{B.sql('calls')} SELECT round({_UNIQUE} / {_REG}, 9) AS coverage_ratio")
def coverage_ratio(spark, d):
    return M.coverage(B.calls(spark, d), _size(spark, d))


@query(f"{B.sql('calls')} SELECT {_TOP5} AS top5_concentration")
def top5_concentration(spark, d):
    return M.concentration(B.calls(spark, d))


@query(f"{B.sql('calls', 'convs')}, {_SIGS} SELECT {_COMBO} AS combo_entropy")
def combo_entropy(spark, d):
    return M.combo_entropy(B.conversations(spark, d), B.calls(spark, d))


@query(f"{B.sql('cats')} SELECT {_DOMAIN} AS domain_uniformity")
def domain_uniformity(spark, d):
    return M.domain_uniformity(B.categories(spark, d))


@query(f"{B.sql('calls', 'cats')}, own AS (SELECT * FROM cats WHERE category = 'ASIA' OR (category = 'EUROPE' AND conv_id % 5 <> 0)), u AS (SELECT * FROM own UNION ALL SELECT DISTINCT conv_id, tool FROM calls WHERE conv_id NOT IN (SELECT conv_id FROM own)), e AS (SELECT category, count(*) AS n FROM u GROUP BY category) SELECT round(({_H}) / log2(count(*)), 9) AS domain_uniformity FROM e")
def domain_fallback(spark, d):
    """Two regions are listed as categories, one not everywhere; a conversation without any counts by its tools."""
    own = B.categories(spark, d).where("category = 'ASIA' or (category = 'EUROPE' and conv_id % 5 <> 0)")
    return M.domain_uniformity(M.used_domains(B.conversations(spark, d), own, B.calls(spark, d)))


@query(f"{B.sql('calls', 'convs')}, {_SIGS} SELECT count(DISTINCT signature) AS unique_chains, round(count(DISTINCT signature) / count(*), 9) AS chain_ratio FROM sigs")
def chain_ratio(spark, d):
    return M.chain_ratio(B.conversations(spark, d), B.calls(spark, d))


@query(f"""{B.sql('calls', 'convs', 'cats')}, {_SIGS} SELECT {_USAGE} AS usage_entropy, {_UNIQUE} AS unique_tools_used, round({_UNIQUE} / {_REG}, 9) AS coverage_ratio,
  {_TOP5} AS top5_concentration, {_COMBO} AS combo_entropy, (SELECT count(DISTINCT signature) FROM sigs) AS unique_chains, (SELECT round(count(DISTINCT signature) / count(*), 9) FROM sigs) AS chain_ratio,
  {_DOMAIN} AS domain_uniformity, (SELECT count(*) FROM calls) AS total_tool_calls""")
def diversity_summary(spark, d):
    return M.diversity_summary(B.conversations(spark, d), B.calls(spark, d), B.categories(spark, d), _size(spark, d))


_MEANS = "SELECT round(avg(naturalness), 9) AS naturalness, round(avg(tool_correctness), 9) AS tool_correctness, round(avg(task_completion), 9) AS task_completion, round((avg(naturalness) + avg(tool_correctness) + avg(task_completion)) / 3, 9) AS overall_mean, count(naturalness) AS scored_count FROM scores"
_MSMT = "SELECT round(avg(CASE WHEN n_calls >= 3 AND {} >= 2 THEN 1.0 ELSE 0.0 END), 9) AS ms_mt_rate FROM per"
_LEAF = "x.type NOT IN ('OBJECT', 'ARRAY', 'NULL') AND json_extract_string(x.atom, '$') <> ''"
_TEXT = "CASE WHEN x.type = 'BOOLEAN' THEN upper(x.atom[1:1]) || CAST(x.atom AS VARCHAR)[2:] ELSE json_extract_string(x.atom, '$') END"
_CHAINED = f"""seen AS (SELECT conv_id, {_TEXT} AS value, min(call_idx) AS seen FROM ncalls, json_tree(response) AS x WHERE {_LEAF} GROUP BY 1, 2),
used AS (SELECT conv_id, {_TEXT} AS value, max(call_idx) AS used FROM ncalls, json_each(arguments) AS x WHERE {_LEAF} AND (x.type <> 'VARCHAR' OR length(json_extract_string(x.atom, '$')) >= 3) GROUP BY 1, 2),
ch AS (SELECT conv_id, bool_or(coalesce(seen < used, false)) AS chained FROM (SELECT DISTINCT conv_id FROM ncalls) LEFT JOIN (SELECT * FROM seen JOIN used USING (conv_id, value)) USING (conv_id) GROUP BY conv_id)"""


@query(f"{B.sql('scores')} {_MEANS}")
def mean_scores(spark, d):
    return M.mean_scores(B.scores(spark, d))


@query(f"{B.sql('calls', 'convs')}, {_PER} {_MSMT.format('n_endpoints')}")
def ms_mt_rate(spark, d):
    return M.ms_mt_rate(B.conversations(spark, d), B.calls(spark, d))


@query(f"{B.sql('calls', 'convs')}, {_PER} {_MSMT.format('n_tools')}")
def ms_mt_tool_level(spark, d):
    return M.ms_mt_rate(B.conversations(spark, d), B.calls(spark, d), "n_tools")


@query(f"{B.sql('ncalls')}, {_CHAINED} SELECT round(avg(CASE WHEN chained THEN 1.0 ELSE 0.0 END), 9) AS real_chaining_rate, count(*) FILTER (chained) AS chained, count(*) AS conversations FROM ch")
def real_chaining(spark, d):
    return M.real_chaining_rate(B.nested_calls(spark, d))


def _quality(spark, d):
    out = M.mean_scores(B.scores(spark, d)).join(F.broadcast(M.ms_mt_rate(B.conversations(spark, d), B.calls(spark, d))))
    return out.join(F.broadcast(M.real_chaining_rate(B.nested_calls(spark, d)).select("real_chaining_rate")))


@query(f"{B.sql('scores', 'calls', 'convs', 'ncalls')}, {_PER}, {_CHAINED} SELECT * FROM ({_MEANS}), ({_MSMT.format('n_endpoints')}), (SELECT round(avg(CASE WHEN chained THEN 1.0 ELSE 0.0 END), 9) AS real_chaining_rate FROM ch)")
def quality_summary(spark, d):
    return _quality(spark, d)


_HIT = "n_calls >= 3 AND n_endpoints >= 2"


@query(f"{B.sql('calls', 'convs')}, {_PER} SELECT type, count(*) FILTER (run = 'A') AS total_a, count(*) FILTER (run = 'A' AND {_HIT}) AS hits_a, count(*) FILTER (run = 'B') AS total_b, count(*) FILTER (run = 'B' AND {_HIT}) AS hits_b FROM per GROUP BY type")
def per_type_ms_mt(spark, d):
    return M.per_type(B.conversations(spark, d), B.calls(spark, d))


def _run_parts(spark, d):
    lines = B.read(spark, d, "lineitem")
    return [lines.where(f"l_orderkey % 2 = {k}").select(F.col("l_partkey").alias("endpoint")) for k in (0, 1)]


@query("WITH a AS (SELECT DISTINCT l_partkey AS e FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT DISTINCT l_partkey AS e FROM lineitem WHERE l_orderkey % 2 = 1) SELECT (SELECT count(*) FROM (SELECT e FROM a INTERSECT SELECT e FROM b)) AS both, (SELECT count(*) FROM (SELECT e FROM a EXCEPT SELECT e FROM b)) AS only_a, (SELECT count(*) FROM (SELECT e FROM b EXCEPT SELECT e FROM a)) AS only_b, (SELECT count(*) FROM (SELECT e FROM a UNION SELECT e FROM b)) AS either")
def run_overlap(spark, d):
    return M.overlap(*_run_parts(spark, d))


@query("SELECT DISTINCT o_orderpriority AS type FROM orders")
def run_types(spark, d):
    c = B.conversations(spark, d)
    return c.where("run = 'A'").select("type").union(c.where("run = 'B'").select("type")).distinct()


@query(f"{B.sql('calls', 'convs')}, {_PER}, {_SIGS}, m AS (SELECT run, count(*) AS conversations, sum(n_calls) AS total_calls, round(avg(CASE WHEN {_HIT} THEN 1.0 ELSE 0.0 END), 9) AS ms_mt_rate FROM per GROUP BY run), s AS (SELECT run, count(DISTINCT signature) AS unique_chains FROM sigs GROUP BY run) SELECT run, conversations, CAST(total_calls AS BIGINT) AS total_calls, ms_mt_rate, unique_chains FROM m JOIN s USING (run)")
def compare_report(spark, d):
    convs, calls = B.conversations(spark, d), B.calls(spark, d)
    hit = (F.col("n_calls") >= 3) & (F.col("n_endpoints") >= 2)
    per = M.per_conversation(convs, calls).groupBy("run").agg(F.count(F.lit(1)).alias("conversations"), F.sum("n_calls").alias("total_calls"), F.round(F.avg(hit.cast("double")), 9).alias("ms_mt_rate"))
    return per.join(M.signatures(convs, calls).groupBy("run").agg(F.count_distinct("signature").alias("unique_chains")), "run")


_DELTAS = ", ".join(f"('{c}', CAST({c} AS DOUBLE))" for c in ("conversations", "total_calls", "ms_mt_rate", "unique_chains"))


@query(f"WITH r AS ({_sql['compare_report']}), v AS (SELECT run, x.* FROM r, (VALUES {_DELTAS}) AS x(metric, value)), s AS (SELECT metric, max(value) FILTER (run = 'A') AS a, max(value) FILTER (run = 'B') AS b FROM v GROUP BY metric) SELECT metric, a, b, round(b - a, 9) AS delta FROM s")
def compare_deltas(spark, d):
    return M.deltas(compare_report(spark, d))


@query(f"{B.sql('scores', 'calls', 'convs')}, {_PER}, m AS (SELECT * FROM ({_MEANS}), ({_MSMT.format('n_endpoints')})), c AS (" + " UNION ALL ".join(f"SELECT '{k}' AS name, CAST({t} AS DOUBLE) AS threshold, CAST({k} AS DOUBLE) AS value FROM m" for k, t in K.GATES) + ") SELECT *, value >= threshold AS passed FROM c")
def threshold_checks(spark, d):
    one = M.mean_scores(B.scores(spark, d)).join(F.broadcast(M.ms_mt_rate(B.conversations(spark, d), B.calls(spark, d))))
    return M.threshold_checks(one)


_PATTERN = "CASE WHEN n_calls = 1 THEN 'single_call' WHEN n_tools = 1 THEN 'single_tool_multi_step' WHEN n_calls <= 3 THEN 'short_multi_tool' ELSE 'long_multi_tool' END"


def _patterns(spark, d):
    return M.per_conversation(B.conversations(spark, d), B.calls(spark, d)).withColumn("pattern", M.pattern(F.col("n_calls"), F.col("n_tools")))


@query(f"{B.sql('calls', 'convs', 'cats')}, {_PER} SELECT 'tool' AS kind, endpoint AS key, count(*) AS n FROM calls GROUP BY endpoint UNION ALL SELECT 'category', category, count(*) FROM cats GROUP BY category UNION ALL SELECT 'pattern', {_PATTERN}, count(*) FROM per GROUP BY 2")
def steering_counts(spark, d):
    return M.steering_counts(B.calls(spark, d), B.categories(spark, d), _patterns(spark, d))


@query(f"{B.sql('calls', 'convs')}, {_PER} SELECT {_PATTERN} AS pattern, count(*) AS n, round(count(*) / (SELECT count(*) FROM per), 9) AS share FROM per GROUP BY 1")
def pattern_mix(spark, d):
    p = _patterns(spark, d)
    return p.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(p.agg(F.count(F.lit(1)).alias("t")))).select("pattern", "n", F.round(F.col("n") / F.col("t"), 9).alias("share"))


_WORDS = "c AS (SELECT word AS key, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1)"


def _word_calls(spark, d):
    """Every word of every document as a call: few are very common, most are rare."""
    return B.read(spark, d, "documents").select(F.col("doc_id").alias("conv_id"), F.explode(F.split("text", "[ \\n]+")).alias("endpoint")).where("endpoint <> ''")


def _word_counts(spark, d):
    return _word_calls(spark, d).groupBy(F.col("endpoint").alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_WORDS} SELECT key AS endpoint, n FROM (SELECT *, row_number() OVER (ORDER BY n DESC, key) AS r FROM c) WHERE r <= 10 AND n > 3 * (SELECT avg(n) FROM c)")
def exclude_tools(spark, d):
    return M.exclude_tools(_word_calls(spark, d), B.read(spark, d, "documents").select(F.col("doc_id").alias("conv_id")), factor=3.0)


@query(f"WITH {_WORDS} SELECT key, n FROM c WHERE n > 2 * (SELECT avg(n) FROM c)")
def overused_tools(spark, d):
    return M.against_mean(_word_counts(spark, d), 2.0, above=True)


@query(f"WITH {_WORDS} SELECT key, n FROM c WHERE n < 0.5 * (SELECT avg(n) FROM c)")
def underused_categories(spark, d):
    return M.against_mean(_word_counts(spark, d), 0.5, above=False)


@query(f"{B.sql('scores')} SELECT conv_id, coalesce(naturalness, 1.0 + conv_id % 5) AS naturalness, coalesce(tool_correctness, 2.0) AS tool_correctness, coalesce(task_completion, 1.0 + conv_id % 3) AS task_completion, naturalness IS NULL AS fresh FROM scores")
def filled_scores(spark, d):
    """Only what has no scores gets new ones."""
    s = B.scores(spark, d)
    fresh = s.select("conv_id", (1.0 + F.col("conv_id") % 5).alias("naturalness"), F.lit(2.0).alias("tool_correctness"), (1.0 + F.col("conv_id") % 3).alias("task_completion"))
    return M.fill_scores(s, fresh)


@query("SELECT count(DISTINCT p_brand) AS tools, count(DISTINCT p_brand || '/' || p_type) AS endpoints, count(DISTINCT p_type) AS categories, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS names FROM part")
def registry_summary(spark, d):
    p = B.read(spark, d, "part")
    return p.agg(F.count_distinct("p_brand").alias("tools"), F.count_distinct("p_brand", "p_type").alias("endpoints"), F.count_distinct("p_type").alias("categories"), F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("names"))


@query("WITH s AS (SELECT conv_id AS slot, turn AS attempt, 1.0 + length(text) % 41 / 10.0 AS score FROM conversations), t AS (SELECT *, coalesce(bool_or(score >= 4.5) OVER (PARTITION BY slot ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS done FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY score DESC, attempt) AS r, max(attempt) OVER (PARTITION BY slot) AS retries FROM t WHERE NOT done) SELECT slot, attempt, score, retries FROM k WHERE r = 1")
def attempt_pick(spark, d):
    m = B.messages(spark, d).select(F.col("conv_id").alias("slot"), F.col("msg_idx").alias("attempt"), (1.0 + F.length("content") % 41 / 10.0).alias("score"))
    return M.best_attempt(m, 4.5)


@query(f"{B.sql('calls', 'convs', 'cats')}, {_PER}, l AS (SELECT conv_id, list(category) AS c FROM cats GROUP BY conv_id) SELECT conv_id, type, n_calls FROM per JOIN l USING (conv_id) WHERE list_contains(c, 'ASIA') AND {_HIT} AND run = 'A'")
def metadata_filters(spark, d):
    lists = B.categories(spark, d).groupBy("conv_id").agg(F.collect_list("category").alias("c"))
    per = M.per_conversation(B.conversations(spark, d), B.calls(spark, d)).join(lists, "conv_id")
    return per.where(F.array_contains("c", "ASIA") & (F.col("n_calls") >= 3) & (F.col("n_endpoints") >= 2) & (F.col("run") == "A")).select("conv_id", "type", "n_calls")


# Graph

_STATS = "tot AS (SELECT count(DISTINCT endpoint) AS n, count(DISTINCT category) AS c FROM fields), stats AS (SELECT field, df, categories, ln(n / df) AS idf, least(ln(n / df) / ln(n), 1.0) AS specificity, CASE WHEN df < n * {0} THEN 'rare' WHEN categories >= c * 0.5 THEN 'generic' ELSE 'bridge' END AS class FROM (SELECT field, count(DISTINCT endpoint) AS df, count(DISTINCT category) AS categories FROM fields GROUP BY field), tot)"
_FR = K.GENERIC_FRACTION
_IO = "o AS (SELECT endpoint AS src, tool AS st, category AS sc, field FROM fields WHERE kind = 'output'), i AS (SELECT endpoint AS dst, tool AS dt, category AS dc, field FROM fields WHERE kind = 'input')"
_EXACT = "ex0 AS (SELECT src, dst, field, 0.2 + 0.1 + CASE WHEN sc = dc THEN 1.0 ELSE 0.3 END * 0.3 + specificity * 0.4 AS c FROM o JOIN stats USING (field) JOIN i USING (field) WHERE class <> 'generic' AND st <> dt), ex AS (SELECT src, dst, round(c, 3) AS confidence, CASE WHEN c >= 0.7 THEN 'hard' ELSE 'soft' END AS edge_class, field FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY c DESC, field DESC) AS r FROM ex0 WHERE c >= 0.6) WHERE r = 1)"
_F = B.sql("fields") + ", " + _STATS.format(_FR)


@query(f"{_F} SELECT field, df, round(idf, 9) AS idf FROM stats")
def field_idf(spark, d):
    return G.field_stats(B.fields(spark, d), _FR).select("field", "df", F.round("idf", 9).alias("idf"))


@query(f"{_F} SELECT field, class, categories FROM stats")
def field_class(spark, d):
    return G.field_stats(B.fields(spark, d), _FR).select("field", "class", "categories")


@query(f"{B.sql('fields')}, {_STATS.format(0.005)} SELECT class, count(*) AS n FROM stats GROUP BY class")
def field_class_default(spark, d):
    return G.field_stats(B.fields(spark, d)).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_F} SELECT field, round(specificity, 9) AS specificity FROM stats")
def specificity(spark, d):
    return G.field_stats(B.fields(spark, d), _FR).select("field", F.round("specificity", 9).alias("specificity"))


@query(f"{_F}, cf AS (SELECT DISTINCT category, field FROM fields JOIN stats USING (field) WHERE class <> 'generic') SELECT a.category AS a, b.category AS b, count(*) AS shared FROM cf a JOIN cf b USING (field) WHERE a.category < b.category GROUP BY 1, 2 HAVING count(*) >= 3")
def category_affinity(spark, d):
    f = B.fields(spark, d)
    return G.category_affinity(f, G.field_stats(f, _FR))


@query(f"{B.sql('fields')} SELECT endpoint, md5(array_to_string(list_sort(list(field) FILTER (kind = 'output')), ' ')) AS outputs, md5(coalesce(array_to_string(list_sort(list(field) FILTER (kind = 'input')), ' '), '')) AS inputs FROM fields GROUP BY endpoint")
def field_sets(spark, d):
    """The names around an endpoint, as digests of the sorted lists."""
    return G.field_sets(B.fields(spark, d)).select("endpoint", F.when(F.size("outputs") > 0, F.md5(F.array_join("outputs", " "))).alias("outputs"), F.md5(F.array_join("inputs", " ")).alias("inputs"))


@query(f"{_F} SELECT field, df FROM stats WHERE class = 'bridge' ORDER BY df DESC, field LIMIT 15")
def bridge_fields(spark, d):
    return G.field_stats(B.fields(spark, d), _FR).where("class = 'bridge'").orderBy(F.desc("df"), "field").limit(15).select("field", "df")


@query(f"{B.sql('fields')}, {_IO} SELECT src, dst, array_to_string(list_sort(list(DISTINCT field)), ',') AS shared FROM o JOIN i USING (field) WHERE st = dt AND src <> dst GROUP BY src, dst")
def same_tool_edges(spark, d):
    return G.same_tool_edges(B.fields(spark, d)).select("src", "dst", F.array_join("shared_fields", ",").alias("shared"))


@query(f"{_F}, {_IO}, {_EXACT} SELECT * FROM ex")
def feeds_exact(spark, d):
    return G.feeds_exact(B.fields(spark, d), _FR)


def _suffixed(spark, d):
    """Fields with suffixes as their last letter tells, so that roots meet."""
    n = F.length("field") % 3
    name = F.when(n == 0, F.concat(F.col("field"), F.lit("_id"))).when(n == 1, F.concat(F.col("field"), F.lit("_code"))).otherwise(F.col("field"))
    return B.fields(spark, d).withColumn("field", F.when(F.col("kind") == "output", name).otherwise(F.concat(F.col("field"), F.lit("_key"))))


_SUF = B.sql("fields").replace("fields AS (", "fields0 AS (") + ", fields AS (SELECT endpoint, tool, category, kind, CASE WHEN kind = 'input' THEN field || '_key' WHEN length(field) % 3 = 0 THEN field || '_id' WHEN length(field) % 3 = 1 THEN field || '_code' ELSE field END AS field FROM fields0), " + _STATS.format(_FR)
# The normal name of a field (words apart, lower case in every script, single underscores) without a known suffix.
_ROOT = "regexp_replace(trim(regexp_replace(lower(regexp_replace(regexp_replace(field, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')), '_+', '_', 'g'), '_'), '^(.+)_(id|identifier|code|key|number|token|date|time|name|type|url|uri|link)$', '\\1')"


@query(f"{_SUF}, {_IO}, {_EXACT}, oo AS (SELECT o.*, {_ROOT} AS root, specificity FROM o JOIN stats USING (field) WHERE class <> 'generic'), ii AS (SELECT i.*, {_ROOT} AS root FROM i), r0 AS (SELECT src, dst, oo.field, 0.1 + 0.1 + CASE WHEN sc = dc THEN 1.0 ELSE 0.3 END * 0.3 + specificity * 0.4 AS c FROM oo JOIN ii USING (root) WHERE length(root) >= 3 AND st <> dt AND oo.field <> ii.field AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.src = oo.src AND ex.dst = ii.dst)) SELECT src, dst, round(c, 3) AS confidence, CASE WHEN c >= 0.7 THEN 'hard' ELSE 'soft' END AS edge_class, field FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY c DESC, field DESC) AS r FROM r0 WHERE c >= 0.6) WHERE r = 1")
def feeds_root(spark, d):
    return G.feeds_root(_suffixed(spark, d), _FR)


@query(f"{_F}, {_IO}, {_EXACT} SELECT edge_class, count(*) AS n, count(DISTINCT src) AS sources FROM ex GROUP BY edge_class")
def ep_flow(spark, d):
    return feeds_exact(spark, d).groupBy("edge_class").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src").alias("sources"))


@query(f"{_F}, {_IO}, {_EXACT}, e AS (SELECT DISTINCT endpoint, regexp_replace(tool, '/[0-9]+$', '') AS tool FROM fields) SELECT a.endpoint AS a, b.endpoint AS b FROM e a JOIN e b ON a.endpoint < b.endpoint AND a.tool = b.tool WHERE NOT EXISTS (SELECT 1 FROM ex WHERE edge_class = 'hard' AND ((src = a.endpoint AND dst = b.endpoint) OR (src = b.endpoint AND dst = a.endpoint)))")
def independent_pairs(spark, d):
    """Endpoints of one source, whichever of its tools they belong to, without a hard flow either way."""
    f = B.fields(spark, d)
    ends = cut(f.select("endpoint", F.regexp_replace("tool", "/[0-9]+$", "").alias("group")).distinct())
    return G.independent_pairs(ends, G.feeds_exact(f, _FR, within=ends).where("edge_class = 'hard'"))


@query(f"{_F}, {_IO}, {_EXACT} SELECT DISTINCT endpoint FROM fields WHERE endpoint IN (SELECT src FROM ex WHERE edge_class = 'hard') OR endpoint IN (SELECT src FROM o JOIN i USING (field) WHERE st = dt AND src <> dst)")
def chainable_endpoints(spark, d):
    f = B.fields(spark, d)
    sources = G.hard_sources(f, _FR).union(G.same_tool_sources(f))
    return f.select("endpoint").distinct().join(sources, "endpoint", "left_semi")


@query(f"{B.sql('fields')}, {_IO} SELECT src, dst, count(DISTINCT field) AS shared, CAST(round(0.5 + 0.3 * count(DISTINCT field), 6) AS DOUBLE) AS confidence FROM o JOIN i USING (field) WHERE sc = dc AND src <> dst GROUP BY src, dst")
def category_fallback(spark, d):
    return G.category_fallback(B.fields(spark, d))


@query("WITH n AS (SELECT vec_id AS id, label AS category, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), u AS (SELECT id, category, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM n), h AS (SELECT a.id AS src, b.id AS dst, list_sum(list_transform(list_zip(a.u, b.u), lambda p: p[1] * p[2])) AS c FROM u a JOIN u b ON a.id < b.id AND a.category <> b.category), k AS (SELECT src, dst, round(c, 6) AS cosine FROM h WHERE c >= 0.35) SELECT * FROM k UNION ALL SELECT dst, src, cosine FROM k")
def semantic_bridge(spark, d):
    return G.semantic_bridge(B.vectors(spark, d), None, 0.35)


_PAIRS = "cf AS (SELECT DISTINCT category, field FROM fields JOIN stats USING (field) WHERE class <> 'generic'), pairs AS (SELECT a.category AS ca, b.category AS cb FROM cf a JOIN cf b USING (field) WHERE a.category < b.category GROUP BY 1, 2 HAVING count(*) >= 3)"
_TF = "tf AS (SELECT doc_id AS id, word, count(*) AS tf FROM (SELECT doc_id, unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2), dfs AS (SELECT word, count(*) AS df FROM tf GROUP BY 1), raw AS (SELECT id, word, tf * ln((SELECT count(DISTINCT id) FROM tf) / df) AS x FROM tf JOIN dfs USING (word)), tv AS (SELECT raw.id, category, word, x / sqrt(sum(x * x) OVER (PARTITION BY raw.id)) AS w FROM raw JOIN (SELECT DISTINCT endpoint AS id, category FROM fields) USING (id) WHERE x > 0)"


@query(f"{_F}, {_PAIRS}, {_TF}, k AS (SELECT a.id AS src, b.id AS dst, round(sum(a.w * b.w), 6) AS cosine FROM tv a JOIN tv b USING (word) JOIN pairs ON ca = least(a.category, b.category) AND cb = greatest(a.category, b.category) WHERE a.category <> b.category GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 0.75) SELECT * FROM k")
def description_bridge(spark, d):
    """Endpoints of categories that share fields whose texts, as tf-idf vectors of all their words, are alike."""
    f = B.fields(spark, d)
    pairs = G.category_affinity(f, G.field_stats(f, _FR)).select(F.col("a").alias("ca"), F.col("b").alias("cb"))
    texts = B.read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.filter(F.split("text", "[ \\n]+"), lambda w: w != "").alias("words"))
    rows = G.packed_texts(texts).join(f.select(F.col("endpoint").alias("id"), "category").distinct(), "id")
    return G.packed_cosine_join(rows, 0.75, pairs)


def _mixed(spark, d):
    """Fields of which a third meets by equal names and the others by roots."""
    n, f = F.length("field") % 3, F.col("field")
    out, into = F.when(n == 0, F.concat(f, F.lit("_id"))).otherwise(f), F.when(n == 1, F.concat(f, F.lit("_key"))).otherwise(f)
    return B.fields(spark, d).withColumn("field", F.when(F.col("kind") == "output", out).otherwise(into))


_MIX = B.sql("fields").replace("fields AS (", "fields0 AS (") + ", fields AS (SELECT endpoint, tool, category, kind, CASE WHEN kind = 'output' AND length(field) % 3 = 0 THEN field || '_id' WHEN kind = 'input' AND length(field) % 3 = 1 THEN field || '_key' ELSE field END AS field FROM fields0), " + _STATS.format(_FR)
_NROOT = "regexp_replace(trim(regexp_replace(lower(field), '_+', '_', 'g'), '_'), '^(.+)_(id|identifier|code|key|number|token|date|time|name|type|url|uri|link)$', '\\1')"
_NEAR = "CASE WHEN sc = dc THEN 1.0 ELSE 0.3 END * 0.3"
_FLOW = f"""fx AS (SELECT src, dst, field, 0.2 + 0.1 + {_NEAR} + specificity * 0.4 AS c FROM o JOIN stats USING (field) JOIN i USING (field) WHERE class <> 'generic' AND st <> dt),
  ro AS (SELECT *, {_NROOT} AS root FROM o), ri AS (SELECT dst, dt, dc, field AS taken, {_NROOT} AS root FROM i),
  fr AS (SELECT src, dst, ro.field, 0.1 + 0.1 + {_NEAR} + coalesce(specificity, 0.0) * 0.4 AS c FROM ro JOIN ri USING (root) LEFT JOIN stats ON stats.field = root WHERE length(root) >= 3 AND coalesce(class, '') <> 'generic' AND st <> dt AND ro.field <> taken),
  flow AS (SELECT src, dst, round(c, 3) AS confidence, CASE WHEN c >= 0.7 THEN 'hard' ELSE 'soft' END AS edge_class, field FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY c DESC, field DESC) AS r FROM (SELECT * FROM fx UNION ALL SELECT * FROM fr) WHERE c >= 0.6) WHERE r = 1)"""


@query(f"{B.sql('fields')} SELECT DISTINCT 'category:' || category AS id, 'category' AS node_type, category AS name, category FROM fields UNION ALL SELECT DISTINCT 'tool:' || tool, 'tool', tool, category FROM fields UNION ALL SELECT DISTINCT 'endpoint:' || CAST(endpoint AS VARCHAR), 'endpoint', CAST(endpoint AS VARCHAR), category FROM fields UNION ALL SELECT DISTINCT 'parameter:' || CAST(endpoint AS VARCHAR) || '/' || field, 'parameter', field, category FROM fields WHERE kind = 'input' UNION ALL SELECT DISTINCT 'output_field:' || CAST(endpoint AS VARCHAR) || '/' || field, 'output_field', field, category FROM fields WHERE kind = 'output'")
def graph_nodes(spark, d):
    return G.nodes(B.fields(spark, d))


@query(f"{_MIX}, {_IO}, {_FLOW}, e AS (SELECT 'same_tool' AS edge_type, 'hard' AS edge_class, 1.0 AS c, count(*) AS n FROM (SELECT DISTINCT src, dst FROM o JOIN i USING (field) WHERE st = dt AND src <> dst) UNION ALL SELECT 'feeds_into', edge_class, sum(confidence), count(*) FROM flow GROUP BY edge_class UNION ALL SELECT 'belongs_to', NULL, NULL, count(*) FROM (SELECT DISTINCT tool, category FROM fields) UNION ALL SELECT 'has_endpoint', NULL, NULL, count(*) FROM (SELECT DISTINCT tool, endpoint FROM fields) UNION ALL SELECT CASE kind WHEN 'input' THEN 'takes_input' ELSE 'produces' END, NULL, NULL, count(*) FROM (SELECT DISTINCT kind, endpoint, field FROM fields) GROUP BY kind) SELECT edge_type, edge_class, n, CAST(round(CASE WHEN edge_type = 'same_tool' THEN n ELSE c END, 3) AS DOUBLE) AS confidence FROM e")
def graph_edges(spark, d):
    """The whole graph in one plan; its edges by type and class, with their confidence."""
    return G.build(_mixed(spark, d), _FR)["edges"].groupBy("edge_type", "edge_class").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 3).alias("confidence"))


@query(f"{B.sql('fields')} SELECT 'category' AS node_type, count(DISTINCT category) AS n FROM fields UNION ALL SELECT 'tool', count(DISTINCT tool) FROM fields UNION ALL SELECT 'endpoint', count(DISTINCT endpoint) FROM fields UNION ALL SELECT 'parameter', count(*) FROM (SELECT DISTINCT endpoint, field FROM fields WHERE kind = 'input') UNION ALL SELECT 'output_field', count(*) FROM (SELECT DISTINCT endpoint, field FROM fields WHERE kind = 'output')")
def node_type_counts(spark, d):
    return G.node_counts(B.fields(spark, d))


@query(f"{B.sql('fields')} SELECT 'belongs_to' AS edge_type, count(*) AS n FROM (SELECT DISTINCT tool, category FROM fields) UNION ALL SELECT 'has_endpoint', count(*) FROM (SELECT DISTINCT tool, endpoint FROM fields) UNION ALL SELECT 'takes_input', count(*) FROM (SELECT DISTINCT endpoint, field FROM fields WHERE kind = 'input') UNION ALL SELECT 'produces', count(*) FROM (SELECT DISTINCT endpoint, field FROM fields WHERE kind = 'output')")
def edge_type_counts(spark, d):
    return G.structural_edges(B.fields(spark, d)).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))


_UNIT = "u AS (SELECT id, category, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM n), h AS (SELECT a.id AS src, b.id AS dst, a.category AS ca, b.category AS cb, list_sum(list_transform(list_zip(a.u, b.u), lambda p: p[1] * p[2])) AS c FROM u a JOIN u b ON a.id < b.id AND a.category <> b.category)"
_STEPS = f"""{_FLOW}, {_PAIRS}, n AS (SELECT vec_id AS id, category, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings JOIN (SELECT DISTINCT endpoint, category FROM fields) ON vec_id = endpoint), {_UNIT},
  sem AS (SELECT src, dst, round(c, 6) AS cosine FROM h JOIN pairs ON pairs.ca = least(h.ca, h.cb) AND pairs.cb = greatest(h.ca, h.cb) WHERE c >= 0.35),
  t0 AS (SELECT DISTINCT src, dst, 0 AS tier, 'same_tool' AS kind, 3.0 AS weight FROM o JOIN i USING (field) WHERE st = dt AND src <> dst
    UNION ALL SELECT src, dst, CASE WHEN edge_class = 'hard' THEN 0 ELSE 1 END, 'feeds_into_' || edge_class, round(CASE WHEN edge_class = 'hard' THEN 4 ELSE 2 END * confidence, 6) FROM flow
    UNION ALL SELECT src, dst, 2, 'semantic_bridge', round(2.5 * cosine, 6) FROM sem UNION ALL SELECT dst, src, 2, 'semantic_bridge', round(2.5 * cosine, 6) FROM sem),
  rich AS (SELECT src FROM t0 GROUP BY src HAVING count(DISTINCT dst) >= 4),
  t AS (SELECT * FROM t0 UNION ALL SELECT src, dst, 3, 'same_category_fallback', CAST(round(0.5 + 0.3 * count(DISTINCT field), 6) AS DOUBLE) FROM o JOIN i USING (field) WHERE sc = dc AND src <> dst AND src NOT IN (SELECT src FROM rich) GROUP BY src, dst)"""


@query(f"{_MIX}, {_IO}, {_FLOW} SELECT * FROM flow")
def flow_targets(spark, d):
    """Endpoints that data flows to over two hops, by names and by roots, with the most confident pair of fields."""
    return X.flows(_mixed(spark, d), _FR)


def _endpoints(f):
    e = F.col("endpoint")
    return f.select("endpoint", "tool", "category").distinct().withColumn("quality", F.when(e % 3 == 0, "complete").when(e % 3 == 1, "inferred").otherwise("minimal"))


def _bridges(spark, d, f):
    """Semantic bridges between endpoints of categories that share fields; a vector belongs to the endpoint of its number."""
    vectors = B.vectors(spark, d).drop("category").join(f.select(F.col("endpoint").alias("id"), "category").distinct(), "id")
    pairs = G.category_affinity(f, G.field_stats(f, _FR)).select(F.col("a").alias("ca"), F.col("b").alias("cb"))
    return G.semantic_bridge(vectors, pairs, 0.35)


def _steps(spark, d):
    f = _mixed(spark, d)
    return cut(_endpoints(f)), cut(X.edges(f, cut(X.flows(f, _FR)), cut(_bridges(spark, d, f)), steps=4))  # every walk reads both


@query(f"{_MIX}, {_IO}, {_STEPS} SELECT tier, kind, count(*) AS n, count(DISTINCT src) AS sources, round(sum(weight), 3) AS mass FROM t GROUP BY tier, kind")
def transition_candidates(spark, d):
    f = _mixed(spark, d)
    steps = X.edges(f, X.flows(f, _FR), _bridges(spark, d, f), steps=4)  # read once, so no edge is written
    return steps.groupBy("tier", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src").alias("sources"), F.round(F.sum("weight"), 3).alias("mass"))


@query(f"{_MIX}, {_IO}, {_STEPS} SELECT src, min(tier) AS tier, count(*) FILTER (tier = 0) AS first, CAST(round(sum(weight) FILTER (tier = 0), 3) AS DOUBLE) AS mass FROM t GROUP BY src")
def transition_store(spark, d):
    """What the store to draw from holds: each source's best tier, and the candidates and the weight of its first."""
    endpoints, steps = _steps(spark, d)
    first = F.get(F.filter("tables", lambda t: t["tier"] == 0), 0)
    mass = F.aggregate(first["c"], F.lit(0.0), lambda s, x: s + x["weight"])
    return X.store(steps, endpoints).heads.select("src", F.get("tables", 0)["tier"].alias("tier"), F.coalesce(first["n"], F.lit(0).cast("long")).alias("first"), F.round(mass, 3).alias("mass"))


def _slots(spark, d):
    """A slot for each order."""
    return B.read(spark, d, "orders").select(F.col("o_orderkey").alias("slot"))


@query()
def sampled_chains(spark, d):
    """A walk for each order under the default constraints; no SQL, as picks are hashed."""
    endpoints, steps = _steps(spark, d)
    return S.walk(endpoints, steps, _slots(spark, d))


@query(f"{_MIX}, {_IO}, {_STEPS}, w AS (SELECT src, min(tier) = 0 AS follows, bool_or(kind <> 'same_tool') AS flows FROM t WHERE tier < 2 GROUP BY src), e AS (SELECT DISTINCT endpoint, tool, category FROM fields WHERE category <> 'c4'), g AS (SELECT *, coalesce(follows, false) AS f FROM e LEFT JOIN w ON endpoint = src) SELECT endpoint, tool, category, round(CAST(CASE endpoint % 3 WHEN 0 THEN 1.2 WHEN 1 THEN 1.0 ELSE 0.8 END * CASE WHEN flows THEN 1.5 ELSE 1.0 END * CASE WHEN category = 'c1' THEN 3.0 ELSE 1.0 END AS DOUBLE), 6) AS weight FROM g WHERE f = (SELECT max(f) FROM g)")
def seed_weights(spark, d):
    f = _mixed(spark, d)
    return S.seed_weights(_endpoints(f), X.sources(f, _FR), S.Constraints(categories=("c0", "c1", "c2", "c3"), must_include=("c1",)))


# Selection

@query(f"{B.sql('fields')}, useful AS (SELECT * FROM fields WHERE field NOT IN ({', '.join(repr(x) for x in K.GENERIC_FIELDS)})), base AS (SELECT tool, category, count(DISTINCT endpoint) AS n_endpoints, count(*) FILTER (kind = 'input') AS n_inputs FROM fields GROUP BY tool, category), outs AS (SELECT DISTINCT tool, field FROM useful WHERE kind = 'output'), rl AS (SELECT tool, count(*) AS real_outputs FROM outs GROUP BY tool), cx AS (SELECT tool, least(count(*), 30) AS cross_tool FROM outs JOIN (SELECT DISTINCT category, field FROM useful WHERE kind = 'input') USING (field) GROUP BY tool), br AS (SELECT field, list(DISTINCT category) AS cats FROM useful WHERE length(field) > 2 GROUP BY field HAVING count(DISTINCT category) >= 2), cc AS (SELECT tool, least(count(DISTINCT (endpoint, kind, field)), 15) + 3 * least(count(DISTINCT CASE WHEN other <> category THEN other END), 5) AS cross_category FROM (SELECT tool, category, endpoint, kind, field, unnest(cats) AS other FROM useful JOIN br USING (field)) GROUP BY tool) SELECT tool, category, n_endpoints, n_inputs, coalesce(real_outputs, 0) AS real_outputs, coalesce(cross_tool, 0) AS cross_tool, coalesce(cross_category, 0) AS cross_category FROM base LEFT JOIN rl USING (tool) LEFT JOIN cx USING (tool) LEFT JOIN cc USING (tool)")
def score_features(spark, d):
    return Q.tool_features(B.fields(spark, d))


@query("WITH r AS (SELECT p_partkey AS tool_id, p_type AS category, round(p_retailprice + p_size, 2) AS score FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, tool_id) AS r FROM r), m AS (SELECT greatest(100 // count(DISTINCT category) * 2, 7) AS most FROM r), f AS (SELECT * FROM k WHERE r <= 5), g AS (SELECT k.* FROM k, m WHERE r > 5 AND r <= most ORDER BY score DESC, tool_id LIMIT (SELECT greatest(0, 100 - count(*)) FROM f)) SELECT tool_id, category, score, CAST(r AS INTEGER) AS r FROM f UNION ALL SELECT tool_id, category, score, CAST(r AS INTEGER) FROM (SELECT tool_id, category, score, r FROM g)")
def select_quota(spark, d):
    return Q.select_quota(B.registry(spark, d), 100, 5)


@query("SELECT tool, tool_id FROM (SELECT p_brand AS tool, p_partkey AS tool_id, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS r FROM part) WHERE r <= 35")
def trim_topk(spark, d):
    p = B.read(spark, d, "part").select(F.col("p_brand").alias("tool"), F.col("p_partkey").alias("tool_id"), "p_size")
    return Q.trim(p, "tool", [F.desc("p_size"), F.col("tool_id")], 35).select("tool", "tool_id")


@query()
def fuzzy_dedup(spark, d):
    """Greedy groups by text similarity depend on order; no SQL, a plain loop in the tests."""
    r = B.registry(spark, d)
    return Q.fuzzy_dedup(r.select("category", F.col("tool_id").alias("pos"), T.dedup_name(F.col("name")).alias("name"), "tool_id", "score"))


# Catalogue

_RAW = """defs AS (SELECT p_partkey AS k, * FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0),
eps AS (SELECT k AS tool_id, 0 AS pos, trim(p_name) AS tool_name, CASE k % 4 WHEN 0 THEN 'search rooms' WHEN 1 THEN 'book room' WHEN 2 THEN 'cancel_room' ELSE 'room info' END AS name, p_type AS description, CASE WHEN k % 2 = 0 THEN 'POST' ELSE 'GET' END AS method,
  CASE k % 3 WHEN 0 THEN ['hotel_id number Hotel id'] WHEN 1 THEN ['userName string who'] ELSE ['page integer Page'] END AS required,
  CASE WHEN k % 4 = 2 THEN ['message', 'status'] WHEN k % 4 = 0 THEN ['results', 'status', 'total_count']
    ELSE list_sort(list_concat(CASE k % 3 WHEN 0 THEN ['hotel_id', 'hotel_name'] WHEN 1 THEN ['userName', 'id'] ELSE ['page', 'id'] END, CASE WHEN k % 4 = 1 THEN ['room_id', 'created_at', 'status'] ELSE ['status'] END)) END AS fields FROM defs
  UNION ALL SELECT k, 1, trim(p_name), 'given', '', 'GET', [], ['size'] FROM defs)"""


def _catalogue(spark, d):
    return C.parse(B.tool_definitions(spark, d))


def _read_catalogue(spark, d):
    """The catalogue as tables, for what reads it several times."""
    tools, endpoints = _catalogue(spark, d)
    return cut(tools), cut(endpoints)


@query(f"WITH {_RAW} SELECT tool_id, CAST(pos AS INTEGER) AS pos, tool_name, name, description, method, array_to_string(required, ';') AS required, array_to_string(fields, ',') AS fields, pos = 1 AS given FROM eps")
def parse_catalogue(spark, d):
    shown = F.array_join(F.transform("required", lambda p: F.concat_ws(" ", p["name"], p["type"], p["description"])), ";")
    fields = F.array_join(F.array_sort(F.json_object_keys(F.get_json_object("schema", "$.properties"))), ",")
    return _catalogue(spark, d)[1].select("tool_id", "pos", "tool_name", "name", "description", "method", shown.alias("required"), fields.alias("fields"), "given")


@query(f"WITH {_RAW} SELECT p_partkey AS tool_id, trim(p_name) AS tool_name, trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS standardized_name, CASE WHEN k % 2 = 0 THEN p_type ELSE p_brand END AS description, 'c' || CAST(k % 5 AS VARCHAR) AS category, 2 AS n_endpoints FROM defs")
def parsed_tools(spark, d):
    return _catalogue(spark, d)[0].select("tool_id", "tool_name", "standardized_name", "description", "category", "n_endpoints")


@query(f"WITH {_RAW}, l AS (SELECT trim(p_name) AS tool_name, max(k) AS last FROM defs GROUP BY 1), w AS (SELECT DISTINCT p_name AS tool_name FROM part) SELECT w.tool_name, last AS tool_id FROM w LEFT JOIN l USING (tool_name)")
def registry_lookup(spark, d):
    wanted = B.read(spark, d, "part").select(F.col("p_name").alias("tool_name")).distinct()
    return C.find_tools(_catalogue(spark, d)[0], wanted).select("tool_name", "tool_id")


@query(f"WITH {_RAW} SELECT 'c' || CAST(k % 5 AS VARCHAR) AS category, count(*) AS n FROM defs GROUP BY 1")
def category_index(spark, d):
    return C.by_category(_catalogue(spark, d)[0]).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("WITH n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'abc' WHEN 1 THEN p_name WHEN 2 THEN 'Ünited ' || p_name ELSE p_name || ' Tool' END AS name, CASE p_partkey % 3 WHEN 0 THEN 'Testing' WHEN 1 THEN NULL ELSE p_type || ' ' || p_name END AS about, CASE WHEN p_partkey % 4 = 0 THEN ['a', 'a', 'a'] ELSE ['a', 'b'] END AS eps FROM part) "
       f"SELECT p_partkey, ascii(name) > 127 OR regexp_matches(name, '(?i){'|'.join(K.JUNK_NAMES)}') OR (length(name) <= 3 AND length(coalesce(about, '')) < 20) OR (lower(coalesce(about, '')) IN ('test api', 'this is the description', 'test', 'testing', '') AND (length(name) < 15 OR NOT regexp_matches(name[2:], '[A-Z]'))) OR (len(eps) >= 3 AND len(list_distinct(eps)) = 1) AS junk FROM n")
def junk_tools(spark, d):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, "abc").when(k % 5 == 1, F.col("p_name")).when(k % 5 == 2, F.concat(F.lit("Ünited "), "p_name")).otherwise(F.concat("p_name", F.lit(" Tool")))
    about = F.when(k % 3 == 0, "Testing").when(k % 3 == 2, F.concat("p_type", F.lit(" "), "p_name"))
    names = F.when(k % 4 == 0, F.array(*[F.lit("a")] * 3)).otherwise(F.array(F.lit("a"), F.lit("b")))
    return B.read(spark, d, "part").select("p_partkey", Q.junk_tool(name, about, names).alias("junk"))


@query("SELECT p_partkey AS tool_id, CAST(NULL AS INTEGER) AS place, CASE WHEN p_partkey % 13 = 0 THEN 'no JSON object' WHEN p_partkey % 11 = 0 THEN 'no name' ELSE 'no endpoint with a name' END AS reason FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 11 = 0 OR p_partkey % 7 = 0")
def quarantined_tools(spark, d):
    """What parsing leaves out, with the reason; with the parsed tools these are all definitions."""
    return C.quarantine(B.tool_definitions(spark, d)).select("tool_id", "place", "reason")


@query("SELECT p_partkey AS tool_id, unnest([b, b || '_2', b || '_2_2', replace(p_brand, '#', '-'), b || '_3', 'param', 'param_2']) AS identifier, unnest([p_brand, replace(p_brand, '#', ' '), b || '_2', replace(p_brand, '#', '-'), replace(p_brand, '#', '?'), '##', '']) AS name FROM (SELECT *, replace(p_brand, '#', '_') AS b FROM part)")
def parameter_identifiers(spark, d):
    """Identifiers for parameters whose names clash, also with numbered ones, and the names they lead back to."""
    p = cut(B.dealt(B.read(spark, d, "part").select("p_partkey", "p_brand", "p_type"), "p_partkey")).withColumn("b", F.translate("p_brand", "#", "_"))
    names = F.array("p_brand", F.translate("p_brand", "#", " "), F.concat("b", F.lit("_2")), F.translate("p_brand", "#", "-"), F.translate("p_brand", "#", "?"), F.lit("##"), F.lit(""), F.lit("api_key"))
    params = F.transform(names, lambda n: F.struct(n.alias("name"), F.lit("string").alias("type"), F.lit("").alias("description")))
    e = p.select(F.col("p_partkey").cast("string").alias("tool_name"), F.col("p_type").alias("name"), F.lit("").alias("description"), F.slice(params, 1, 4).alias("required"), F.slice(params, 5, 4).alias("optional"))
    return DF.definitions(e).select(F.col("tool_name").cast("long").alias("tool_id"), F.explode("parameters").alias("x")).select("tool_id", "x.identifier", "x.name")


@query(f"WITH {_RAW}, e AS (SELECT *, CASE WHEN len(required) = 0 THEN NULL ELSE string_split(required[1], ' ') END AS p FROM eps) SELECT tool_id, CAST(pos AS INTEGER) AS pos, CASE WHEN p IS NULL THEN '{{\"type\":\"object\",\"properties\":{{}},\"required\":[]}}' ELSE '{{\"type\":\"object\",\"properties\":{{\"' || p[1] || '\":{{\"type\":\"' || p[2] || '\",\"description\":\"' || array_to_string(p[3:], ' ') || '\"}}}},\"required\":[\"' || p[1] || '\"]}}' END AS input_schema FROM e")
def assistant_definitions(spark, d):
    """The input schemas that an assistant gets of all parsed endpoints."""
    e = _catalogue(spark, d)[1].withColumns({"tool": F.col("tool_name"), "tool_name": F.concat_ws(":", F.col("tool_id").cast("string"), F.col("pos").cast("string"))})
    at = F.split("tool_name", ":")
    return DF.definitions(e).select(at[0].cast("long").alias("tool_id"), at[1].cast("int").alias("pos"), "input_schema")


@query()
def tool_scores(spark, d):
    """No SQL: tests hold it against plain loops over random catalogues."""
    return Q.score_tools(*_read_catalogue(spark, d))


@query(f"WITH {_RAW}, q AS (SELECT tool_id, pos, name, 2 * len(fields) + 3 * len(required) + CASE WHEN length(description) > 10 THEN 2 ELSE 0 END AS endpoint_quality FROM eps) SELECT tool_id, CAST(pos AS INTEGER) AS pos, name, CAST(endpoint_quality AS INTEGER) AS endpoint_quality FROM (SELECT *, row_number() OVER (PARTITION BY tool_id ORDER BY endpoint_quality DESC, pos) AS r FROM q) WHERE r = 1")
def trimmed_endpoints(spark, d):
    """Each tool's best endpoint; a selection keeps 35."""
    return Q.trim_endpoints(_catalogue(spark, d)[1], 1).select("tool_id", "pos", "name", "endpoint_quality")


@query()
def selected_catalogue(spark, d):
    """Junk filter, real outputs, scores, near-equal names, quotas and trimmed endpoints as one chain; tests hold it against plain loops."""
    chosen, endpoints = Q.select_tools(*_read_catalogue(spark, d), target=100, least=3)
    return chosen.join(endpoints.groupBy("tool_id").agg(F.count(F.lit(1)).alias("endpoints")), "tool_id")


@query(f"{B.sql('ncalls')} SELECT conv_id, call_idx, x.type = 'VARCHAR' AS is_text, {_TEXT} AS value FROM ncalls, json_tree(response) AS x WHERE {_LEAF}")
def value_leaves(spark, d):
    each = B.nested_calls(spark, d).select("conv_id", "call_idx", F.explode(W.leaf_values(F.col("response"))).alias("x"))
    return each.select("conv_id", "call_idx", (F.col("x.kind") == "string").alias("is_text"), F.col("x.value").alias("value"))


_ITEM0 = "CASE WHEN event_id % 2 = 1 THEN '\"' || json_extract_string(response, '$.dataSet.items[0].itemId') || '\"' ELSE json_extract_string(response, '$.dataSet.items[0].itemId') END"


@query(f"{B.sql('ncalls')} SELECT event_id, unnest(['dataSet.items[0].itemId', 'tags', 'open']) AS key, unnest([{_ITEM0}, '\"a\"', 'false']) AS value FROM ncalls")
def value_flatten(spark, d):
    return B.nested_calls(spark, d).select("event_id", F.explode(W.path_values(F.col("response"))).alias("x")).select("event_id", "x.key", "x.value")


@query(f"{B.sql('ncalls')} SELECT event_id, unnest(['itemId', 'item_id', 'items_count', 'tags', 'open']) AS key, unnest([{_ITEM0}, {_ITEM0}, '2', '\"a\"', 'false']) AS value FROM ncalls")
def session_values(spark, d):
    """What a session keeps of a response, under the keys and their normal forms."""
    kept = B.nested_calls(spark, d).select("event_id", W.key_values(F.col("response")).alias("items"))
    return kept.select("event_id", F.explode(W.aliased(F.col("items"))).alias("x")).select("event_id", "x.key", "x.value")


@query("SELECT p_partkey AS tool_id, 'Values from previous tool calls:' || chr(10) || '  - size: ' || CAST(p_size + 1 AS VARCHAR) || chr(10) || '  - brand: ' || p_brand AS block FROM part")
def values_block(spark, d):
    """Known values as the lines of a prompt: a key keeps its place and takes its last value."""
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    values = F.array(pair("size", F.col("p_size")), pair("brand", F.col("p_brand")), pair("size", F.col("p_size") + 1))
    return B.read(spark, d, "part").select(F.col("p_partkey").alias("tool_id"), P.values_text(values).alias("block"))


@query(f"{B.sql('ncalls')} SELECT 'item_id' AS field, count(DISTINCT value) AS n, min(value) AS least FROM (SELECT unnest([json_extract_string(response, '$.dataSet.items[0].itemId'), json_extract_string(response, '$.dataSet.items[1].itemId')]) AS value FROM ncalls) UNION ALL SELECT 'tags', 1, 'a'")
def field_values(spark, d):
    each = B.nested_calls(spark, d).select(F.explode(W.comparable_values(F.col("response"))).alias("x"))
    return each.groupBy(T.normal_name(F.col("x.key"), "judge").alias("field")).agg(F.count_distinct("x.value").alias("n"), F.min("x.value").alias("least"))


@query("SELECT p_partkey, unnest(['size', 'box', 'w', 'list', 'n', 'plain']) AS field, unnest(['integer', 'object', 'number', 'array', 'int', 'str']) AS type FROM part")
def schema_walk(spark, d):
    schema = F.concat(F.lit('{"type":"object","required":["size"],"properties":{"size":{"type":"integer","description":'), F.to_json(F.array("p_name")), F.lit('},"box":{"type":"object","properties":{"w":{"type":"number"}}},"list":{"type":"array","items":{"n":"int"}}},"plain":"str"}'))
    return B.dealt(B.read(spark, d, "part"), "p_partkey").select("p_partkey", F.explode(W.fields_of(schema)).alias("x")).select("p_partkey", F.col("x.key").alias("field"), F.col("x.kind").alias("type"))


# Planning

_KINDS = [P.Kind("quick_lookup", 0.1, 1, 1, 1, 1), P.Kind("parallel_lookup", 0.1, 2, 3, 2, 3), P.Kind("simple_sequential", 0.1, 2, 2, 2, 2), P.Kind("multi_step_chain", 0.4, 2, 4, 3, 4), P.Kind("full_workflow", 0.3, 3, 4, 4, 4)]


_SHARES = "[" + ", ".join(f"CAST({k.share} AS DOUBLE)" for k in _KINDS) + "]"
_TYPES = "[" + ", ".join(f"'{k.name}'" for k in _KINDS) + "]"


@query(f"WITH RECURSIVE f AS (SELECT CAST(0 AS BIGINT) AS slot, CAST(4 AS BIGINT) AS pick, [CAST(0 AS BIGINT), 0, 0, 1, 0] AS made UNION ALL SELECT slot + 1, p, list_transform(made, lambda c, k: c + CASE WHEN k = p THEN 1 ELSE 0 END) FROM (SELECT slot, made, list_position(gaps, list_max(gaps)) AS p FROM (SELECT slot, made, list_transform({_SHARES}, lambda s, k: s - made[k] / (slot + 1)) AS gaps FROM f) WHERE slot + 1 < (SELECT count(*) FROM orders))) SELECT slot, {_TYPES}[pick] AS type FROM f")
def next_types(spark, d):
    """The types of as many slots as there are orders."""
    n = B.read(spark, d, "orders").count()
    return P.plan_table(spark, _KINDS, n, "multi_step_chain")


def turn_events(spark, d):
    """Messages as events: five kinds of endpoints by the length of texts, the first three turns' planned; long answers ask, users answer."""
    m = B.read(spark, d, "conversations").select("conv_id", "turn", (F.col("role") == "user").alias("user"), F.length("text").alias("n"))
    tool = F.concat(F.lit("t"), (F.col("n") % 5).cast("string"))
    at = lambda k: F.col("turn") * 10 + k
    row = lambda df, k, event, tool=F.lit(None).cast("string"): df.select("conv_id", (k if isinstance(k, Column) else at(k)).alias("seq"), F.lit(event).alias("event"), tool.alias("tool"))
    out = row(m.where("turn < 3"), F.col("turn") - 10, "plan", tool)
    for more in (row(m, 0, "message"), row(m.where("user"), 1, "turn"), row(m.where("user"), 2, "answer"), row(m.where("not user"), 3, "use", F.concat(F.lit("t"), (F.col("n") % 7).cast("string"))), row(m.where("not user and n % 4 = 0"), 4, "ask"), row(m, 5, "look")):
        out = out.unionByName(more)
    return out


_TURNS = """m AS (SELECT conv_id, turn, role = 'user' AS u, length(text) AS n FROM conversations), pl AS (SELECT conv_id, list('t' || CAST(n % 5 AS VARCHAR)) AS planned FROM m WHERE turn < 3 GROUP BY conv_id),
s AS (SELECT *, row_number() OVER w AS messages, count(*) FILTER (u) OVER w AS turns, coalesce(list_distinct(list('t' || CAST(n % 7 AS VARCHAR)) FILTER (NOT u) OVER w), []) AS used, NOT u AND n % 4 = 0 AS asks FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
q AS (SELECT s.*, coalesce(planned, []) AS planned, coalesce(last_value(CASE WHEN u THEN false WHEN asks THEN true END IGNORE NULLS) OVER (PARTITION BY s.conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), false) AS asked FROM s LEFT JOIN pl USING (conv_id)),
v AS (SELECT *, len(planned) AS k, len(list_filter(list_distinct(planned), lambda x: NOT list_contains(used, x))) AS remaining FROM q),
g AS (SELECT conv_id, messages AS i, turn, 4 * k + 4 + CASE WHEN NOT asked AND messages < 5 * k + 6 AND remaining > 0 AND messages >= 4 * k + 2 THEN 4 ELSE 0 END AS mm, k + 2 + CASE WHEN NOT asked AND messages < 5 * k + 6 AND remaining > 0 AND turns >= k + 1 THEN 1 ELSE 0 END AS mt FROM v WHERE messages = 1
 UNION ALL SELECT v.conv_id, v.messages, v.turn, mm + CASE WHEN NOT asked AND messages < 5 * k + 6 AND remaining > 0 AND messages >= mm - 2 THEN 4 ELSE 0 END, mt + CASE WHEN NOT asked AND messages < 5 * k + 6 AND remaining > 0 AND turns >= mt - 1 THEN 1 ELSE 0 END FROM g JOIN v ON v.conv_id = g.conv_id AND v.messages = g.i + 1)"""


@query(f"WITH RECURSIVE {_TURNS} SELECT conv_id, turn * 10 + 5 AS seq, CASE WHEN asked THEN 'in_progress' WHEN messages >= 5 * k + 6 THEN 'done' WHEN remaining > 0 THEN 'in_progress' ELSE 'completing' END AS status, CAST(mm AS INTEGER) AS max_messages, CAST(mt AS INTEGER) AS max_turns, CAST(len(list_distinct(planned)) - remaining AS INTEGER) AS completed, CAST(remaining AS INTEGER) AS remaining, CAST(len(list_filter(used, lambda x: NOT list_contains(planned, x))) AS INTEGER) AS unplanned FROM v JOIN g USING (conv_id, turn)")
def turn_states(spark, d):
    """Each message's look at its conversation: status, limits and what is left."""
    return TU.looks(turn_events(spark, d))


_END = f"WITH {_TURNS.split('g AS (')[0].rstrip().rstrip(',')}, last AS (SELECT *, list_distinct(planned) AS plan, CASE WHEN asked THEN 'in_progress' WHEN messages >= 5 * k + 6 THEN 'done' WHEN remaining > 0 THEN 'in_progress' ELSE 'completing' END AS status FROM v QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY messages DESC) = 1)"


# Texts of prompts


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _repr(items: str) -> str:
    """SQL for a list of texts in brackets, each in quotes."""
    plain = r"replace(replace(replace(x, '\', '\\'), chr(13), '\r'), chr(9), '\t')"
    single = rf"'''' || replace({plain}, '''', '\''') || ''''"
    return f"('[' || array_to_string(list_transform({items}, lambda x: CASE WHEN contains(x, '''') AND NOT contains(x, '\"') THEN '\"' || {plain} || '\"' ELSE {single} END), ', ') || ']')"


def _filled(text: str, *values: str) -> str:
    """SQL for a text with values for its places."""
    parts = text.replace("%%", "\0").replace("%d", "%s").split("%s")
    return "(" + " || ".join(x for part, value in zip(parts, (*values, "''")) for x in (_quote(part.replace("\0", "%")), value)) + ")"


_SO_FAR = _filled(GU.STATUS_OPEN, "CAST(len(plan) - remaining AS VARCHAR)", "CAST(len(plan) AS VARCHAR)")


@query(f"{_END} SELECT conv_id, CASE WHEN remaining = 0 THEN {_quote(GU.STATUS_DONE)} WHEN conv_id % 3 = 0 THEN {_SO_FAR} || {_quote(GU.STATUS_SHORT)} ELSE {_SO_FAR} || {_filled(GU.STATUS_LONG, 'CAST(remaining AS VARCHAR)')} END AS status_text FROM last")
def completion_texts(spark, d):
    """What each conversation's user is told at its end; every third one is a short lookup."""
    s = P.progress(TU.states(turn_events(spark, d)))
    kind = F.when(F.col("conv_id") % 3 == 0, "quick_lookup")
    return s.select("conv_id", GU.completion_guidance(F.size("remaining"), F.size("completed"), kind).alias("status_text"))


_PLAN_LEFT, _PLAN_DONE = _repr("list_sort(list_filter(plan, lambda p: NOT list_contains(used, p)))"), _repr("list_sort(list_filter(plan, lambda p: list_contains(used, p)))")


@query(f"""{_END} SELECT conv_id, CASE status WHEN 'in_progress' THEN {_filled(GU.HINT_OPEN, "CAST(CASE WHEN k = 0 THEN 100 ELSE CAST(floor((len(plan) - remaining) / k * 100) AS INTEGER) END AS VARCHAR)", _PLAN_LEFT)} WHEN 'completing' THEN {_quote(GU.HINT_WRAP)} ELSE {_quote(GU.HINT_DONE)} END AS hint,
  CASE WHEN status = 'in_progress' AND remaining > 0 THEN {_filled(GU.ASSISTANT_LEFT, _PLAN_DONE, _PLAN_LEFT)} WHEN status = 'in_progress' THEN {_quote(GU.ASSISTANT_OPEN)} WHEN status = 'completing' THEN {_quote(GU.ASSISTANT_WRAP)} ELSE '' END AS for_assistant,
  CASE WHEN status = 'in_progress' AND asked THEN {_quote(GU.USER_ASKED)} WHEN status = 'in_progress' AND remaining > 0 THEN {_quote(GU.USER_LEFT)} WHEN status = 'in_progress' THEN {_quote(GU.USER_OPEN)} WHEN status = 'completing' THEN {_quote(GU.USER_WRAP)} ELSE '' END AS for_user FROM last""")
def plan_prompts(spark, d):
    """The three texts for each conversation's state after all its events."""
    return GU.plan_texts(TU.states(turn_events(spark, d)))


@query(f"{B.sql('scores')}, s AS (SELECT * FROM scores JOIN documents ON doc_id = conv_id) SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN {_quote(GU.REPAIR_ISSUES)} || 'second of ' || source ELSE concat_ws(' ', CASE WHEN naturalness < 3 THEN {_quote(GU.REPAIR_NATURALNESS)} END, CASE WHEN tool_correctness - conv_id % 2 < 3 THEN {_quote(GU.REPAIR_TOOLS)} END, CASE WHEN task_completion < 3 THEN {_quote(GU.REPAIR_TASK)} END) END AS hints FROM s")
def repair_texts(spark, d):
    """What a repair is told of each document's scores and of a judge's words."""
    k = F.col("conv_id") % 3
    reasoning = F.when(k == 0, F.concat(F.lit("ok specific_issues: first specific_issues:  second of "), "source", F.lit(" "))).when(k == 1, "fine; specific_issues:  ")
    s = B.scores(spark, d).join(B.read(spark, d, "documents").select(F.col("doc_id").alias("conv_id"), "source"), "conv_id")
    return s.select("conv_id", GU.repair_hints(F.col("naturalness"), F.col("tool_correctness") - F.col("conv_id") % 2, F.col("task_completion"), reasoning).alias("hints"))


@query(f"""WITH {_WORDS}, w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS place FROM (SELECT doc_id, string_split_regex(text, '[ \\n]+') AS ws FROM documents)), ov AS (SELECT doc_id, list(word ORDER BY place) AS over FROM w WHERE word IN (SELECT key FROM c WHERE n > 2 * (SELECT avg(n) FROM c)) GROUP BY doc_id),
  sc AS (SELECT source AS key, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source), un AS (SELECT list(key ORDER BY first, key) AS under FROM (SELECT * FROM sc WHERE n < 0.5 * (SELECT avg(n) FROM sc) ORDER BY first, key LIMIT 3))
  SELECT doc_id AS slot, concat_ws(' ', CASE WHEN len(over) > 0 THEN {_filled(GU.OVERUSED, _repr("over"))} END, CASE WHEN len(under) > 0 THEN {_filled(GU.UNDERUSED, _repr("under"))} END, CASE WHEN doc_id % 2 = 0 THEN {_filled(GU.SIMILAR, "source || ' b; c; d'")} END) AS guidance FROM (SELECT DISTINCT doc_id FROM w WHERE word <> '') JOIN documents USING (doc_id) LEFT JOIN ov USING (doc_id), un""")
def steering_guidance(spark, d):
    """Each document's words as candidates, its source as a category, and for every second one what a search found."""
    docs = B.read(spark, d, "documents")
    words = docs.select(F.col("doc_id").alias("slot"), F.posexplode(F.split("text", "[ \\n]+")).alias("place", "endpoint")).where("endpoint <> ''")
    sources = docs.groupBy(F.col("source").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    found = lambda place, score, memory: F.struct(F.lit(place).alias("place"), F.lit(score).alias("score"), memory.alias("memory"))
    past = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("slot"), F.explode(F.array(found(5, 0.9, F.lit("e")), found(0, 0.2, F.lit("a")), found(1, 0.3, F.concat("source", F.lit(" b"))), found(2, 0.8, F.lit("c")), found(4, 0.21, F.lit("d")))).alias("x")).select("slot", "x.*")
    return GU.steering_text(words, _word_counts(spark, d), sources, docs, past)


@query(f"WITH {_RAW} SELECT k AS slot, '1. ' || p_type || CASE k % 3 WHEN 0 THEN ' (accepts: Hotel id)' WHEN 1 THEN ' (accepts: who)' ELSE '' END || chr(10) || '2. ' || about || chr(10) || '3. ' || about || chr(10) || '4. Step 4' AS capabilities FROM (SELECT *, CASE WHEN k % 2 = 0 THEN p_type ELSE p_brand END AS about FROM defs)")
def chain_capabilities(spark, d):
    """Each tool's two endpoints, one that it lacks, and one of a tool that is not there, as a chain."""
    tools, endpoints = _catalogue(spark, d)
    by_id = lambda df: df.withColumn("tool_name", F.col("tool_id").cast("string"))
    first = endpoints.where("pos = 0").select(F.col("tool_id").alias("slot"), F.lit(1).alias("step"), F.col("tool_id").cast("string").alias("tool_name"), "name")
    more = F.array(*[F.struct(F.lit(k).alias("step"), t.alias("tool_name"), F.lit(n).alias("name")) for k, t, n in ((2, F.col("tool_name"), "given"), (3, F.col("tool_name"), "lacking"), (4, F.lit("none"), "given"))])
    chains = first.unionByName(first.select("slot", F.explode(more).alias("x")).select("slot", "x.*"))
    return GU.chain_text(chains, by_id(tools), by_id(endpoints))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS key, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_counts(spark, d):
    """Steering counters by the hour, as the stream appends them."""
    return ST.windowed(B.read(spark, d, "events").select("ts", F.col("event_type").alias("key")))


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS end, user_id AS key, count(*) AS n FROM s GROUP BY user_id, k")
def session_counts(spark, d):
    """Sessions of users and their events, as the stream appends them."""
    return ST.sessions(B.read(spark, d, "events").select("ts", F.col("user_id").alias("key")))


_PLAN = "p AS (SELECT l_orderkey AS slot, list(DISTINCT l_partkey % 7) FILTER (l_linenumber <= 3) AS planned, list(DISTINCT l_suppkey % 7) AS used, count(*) AS messages FROM lineitem GROUP BY 1)"


def _plans(spark, d):
    lines = B.read(spark, d, "lineitem")
    planned = F.coalesce(F.collect_set(F.when(F.col("l_linenumber") <= 3, F.col("l_partkey") % 7)), F.array())
    return lines.groupBy(F.col("l_orderkey").alias("slot")).agg(planned.alias("planned"), F.collect_set(F.col("l_suppkey") % 7).alias("used"), F.count(F.lit(1)).alias("messages"))


@query(f"WITH {_PLAN}, q AS (SELECT slot, messages, coalesce(planned, []) AS planned, used FROM p), r AS (SELECT *, list_filter(planned, lambda x: NOT list_contains(used, x)) AS remaining FROM q) SELECT slot, array_to_string(list_sort(remaining), ',') AS remaining, array_to_string(list_sort(list_filter(used, lambda x: NOT list_contains(planned, x))), ',') AS unplanned, round(CASE WHEN len(planned) = 0 THEN 1.0 ELSE (len(planned) - len(remaining)) / len(planned) END, 9) AS fraction, CASE WHEN slot % 5 = 0 THEN 'in_progress' WHEN 6 * messages >= 5 * len(planned) + 6 THEN 'done' WHEN len(remaining) > 0 THEN 'in_progress' ELSE 'completing' END AS status FROM r")
def plan_progress(spark, d):
    p = P.progress(_plans(spark, d))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    state = P.status(F.col("planned"), F.col("used"), F.col("slot") % 5 == 0, 6 * F.col("messages"), F.lit(0), F.lit(0))
    return p.select("slot", text("remaining").alias("remaining"), text("unplanned").alias("unplanned"), "fraction", state.alias("status"))


@query("WITH c AS (SELECT l_orderkey AS slot, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS step, l_partkey AS endpoint FROM lineitem), n AS (SELECT *, lead(endpoint) OVER (PARTITION BY slot ORDER BY step) AS next FROM c) SELECT slot, CAST(step AS INTEGER) AS step, endpoint, next, p_type AS needs FROM n LEFT JOIN part ON next = p_partkey")
def chain_context(spark, d):
    lines = B.read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("slot")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("c"))
    chains = lines.select("slot", F.transform("c", lambda x: x["l_partkey"]).alias("chain"))
    endpoints = B.read(spark, d, "part").select(F.col("p_partkey").alias("endpoint"), F.col("p_type").alias("required"))
    return P.next_parameters(chains, endpoints)


@query()
def parallel_chains(spark, d):
    """Independent endpoints for each order; no SQL, as picks are hashed."""
    endpoints, steps = _steps(spark, d)
    return S.parallel(endpoints, steps, _slots(spark, d))


@query()
def sequential_chains(spark, d):
    """A chain by up to eight attempts for each order, which must touch a category; no SQL, as picks are hashed."""
    endpoints, steps = _steps(spark, d)
    return S.sequential(endpoints, steps, _slots(spark, d), S.Constraints(must_include=("c1",)))


# Text

_NAMES = "names AS (SELECT DISTINCT word, x FROM (SELECT word, unnest([word, upper(word[1:1]) || word[2:] || 'Id', word || 'HTTPCode', '_' || word || '__' || upper(word) || '_', word || '-name']) AS x FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)))"


def _names(spark, d):
    w = B.read(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    word = F.col("word")
    return w.select("word", F.explode(F.array(word, F.concat(F.upper(F.substring("word", 1, 1)), F.expr("substring(word, 2)"), F.lit("Id")), F.concat(word, F.lit("HTTPCode")), F.concat(F.lit("_"), word, F.lit("__"), F.upper("word"), F.lit("_")), F.concat(word, F.lit("-name")))).alias("x")).distinct()


_SPLIT1 = "regexp_replace(x, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
_SPLIT2 = f"lower(regexp_replace({_SPLIT1}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g'))"
_GRAPHN = f"trim(regexp_replace({_SPLIT2}, '_+', '_', 'g'), '_')"
_JUDGEN = f"trim(regexp_replace(regexp_replace({_SPLIT2}, '[^a-z0-9]+', '_', 'g'), '_+', '_', 'g'), '_')"


@query(f"WITH {_NAMES} SELECT x, {_GRAPHN} AS graph, {_JUDGEN} AS judge, trim(lower({_SPLIT1}), '_') AS simple, {_SPLIT2} AS session FROM names")
def normalize_names(spark, d):
    return _names(spark, d).select("x", *[T.normal_name(F.col("x"), m).alias(m) for m in ("graph", "judge", "simple", "session")])


@query(f"WITH {_NAMES} SELECT x, regexp_replace({_GRAPHN}, '^(.+)_(id|identifier|code|key|number|token|date|time|name|type|url|uri|link)$', '\\1') AS root FROM names")
def field_roots(spark, d):
    return _names(spark, d).select("x", T.field_root(F.col("x")).alias("root"))


@query(f"WITH n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'test ' || p_name WHEN 1 THEN 'abc' WHEN 2 THEN 'my api ' || p_name WHEN 3 THEN p_name || ' Demo' ELSE p_name END AS name FROM part) SELECT p_partkey, regexp_matches(name, '(?i){'|'.join(K.JUNK_NAMES)}') AS junk FROM n")
def junk_filter(spark, d):
    p = B.read(spark, d, "part")
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, F.concat(F.lit("test "), "p_name")).when(k == 1, "abc").when(k == 2, F.concat(F.lit("my api "), "p_name")).when(k == 3, F.concat("p_name", F.lit(" Demo"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", T.junk_name(name).alias("junk"))


@query("WITH c AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g'), '\"+$', ''), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS t FROM pages) SELECT page_id, length(t) AS chars, md5(t) AS hash FROM c")
def clean_html(spark, d):
    t = T.clean_description(F.col("html"))
    return B.read(spark, d, "pages").select("page_id", t.alias("t")).select("page_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("hash"))


_PARAMS = "params AS (SELECT p_partkey, lower(p_name) || CASE p_partkey % 6 WHEN 0 THEN '_token' WHEN 1 THEN '_key' WHEN 2 THEN '-api_key' WHEN 3 THEN 'word' WHEN 4 THEN '[0]' ELSE ' id' END AS name FROM part)"


def _params(spark, d):
    k = F.col("p_partkey") % 6
    tail = F.when(k == 0, "_token").when(k == 1, "_key").when(k == 2, "-api_key").when(k == 3, "word").when(k == 4, "[0]").otherwise(" id")
    return B.read(spark, d, "part").select("p_partkey", F.concat(F.lower("p_name"), tail).alias("name"))


_TOK = "|".join(K.AUTH_TOKENS)


@query(f"WITH {_PARAMS}, n AS (SELECT p_partkey, name, trim(replace(lower(name), '-', '_'), '_') AS n FROM params) SELECT p_partkey, regexp_matches(n, '^({_TOK})$|_({_TOK})$|^({_TOK})_|{'|'.join(K.AUTH_PARTS)}') AS auth, regexp_matches(name || ' ', '{'|'.join(K.SCENARIO_AUTH)}') OR regexp_matches(name, '{'|'.join(K.SCENARIO_INFRA)}') AS hidden FROM n")
def auth_params(spark, d):
    return _params(spark, d).select("p_partkey", T.auth_param(F.col("name")).alias("auth"), T.scenario_param(F.col("name"), F.lit("")).alias("hidden"))


@query(f"WITH {_PARAMS}, n AS (SELECT p_partkey, name, regexp_replace(CASE WHEN p_partkey % 2 = 0 THEN '9' ELSE '' END || name, '[^a-zA-Z0-9_]', '_', 'g') AS t, trim(regexp_replace(regexp_replace(name, '[^a-zA-Z0-9_.-]', '_', 'g'), '_+', '_', 'g'), '_') AS p FROM params) SELECT p_partkey, (CASE WHEN regexp_matches(t, '^[^a-zA-Z]') THEN 't_' || t ELSE t END)[1:60] AS tool_name, CASE WHEN p = '' THEN 'param' ELSE p[1:64] END AS param_name FROM n")
def sanitize_names(spark, d):
    tool = F.concat(F.when(F.col("p_partkey") % 2 == 0, "9").otherwise(""), "name")
    return _params(spark, d).select("p_partkey", T.tool_identifier(tool).alias("tool_name"), T.param_identifier(F.col("name")).alias("param_name"))


@query("WITH e AS (SELECT page_id, regexp_extract(url, '://(.*)$', 1) AS e FROM pages) SELECT page_id, split_part(e, '/', 1) AS tool, CASE WHEN instr(e, '/') > 0 THEN e[instr(e, '/') + 1:] ELSE e END AS api FROM e")
def endpoint_split(spark, d):
    e = B.read(spark, d, "pages").select("page_id", F.regexp_extract("url", "://(.*)$", 1).alias("e"))
    tool, api = T.endpoint_parts(F.col("e"))
    return e.select("page_id", tool.alias("tool"), api.alias("api"))


_TYPES = "types AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'STRING' WHEN 1 THEN ' Int ' WHEN 2 THEN 'DATE (YYYY-MM-DD)' WHEN 3 THEN 'double' WHEN 4 THEN 'list' WHEN 5 THEN 'Boolean (optional)' WHEN 6 THEN 'enum' END AS raw, CASE event_id % 4 WHEN 0 THEN ' post' WHEN 1 THEN 'Patch' WHEN 2 THEN 'fetch' END AS m FROM events)"


@query(f"WITH {_TYPES}, b AS (SELECT *, trim(regexp_replace(lower(trim(raw)), '[ \\t]*\\(.*\\)', '')) AS t FROM types) SELECT event_id, CASE " + " ".join(f"WHEN t = '{k}' THEN '{v}'" for k, v in K.TYPE_NAMES.items()) + " ELSE 'string' END AS type, CASE WHEN trim(upper(m)) IN ('GET', 'POST', 'PUT', 'DELETE', 'PATCH', 'HEAD', 'OPTIONS') THEN trim(upper(m)) ELSE 'GET' END AS method FROM b")
def normalize_types(spark, d):
    k, j = F.col("event_id") % 8, F.col("event_id") % 4
    raw = F.when(k == 0, "STRING").when(k == 1, " Int ").when(k == 2, "DATE (YYYY-MM-DD)").when(k == 3, "double").when(k == 4, "list").when(k == 5, "Boolean (optional)").when(k == 6, "enum")
    m = F.when(j == 0, " post").when(j == 1, "Patch").when(j == 2, "fetch")
    return B.read(spark, d, "events").select("event_id", T.normal_type(raw).alias("type"), T.normal_method(m).alias("method"))


# Dialogue

_LINES = "string_agg({}, {} ORDER BY msg_idx)"


@query(f"{B.sql('msgs')} SELECT conv_id, string_agg(upper(role[1:1]) || role[2:] || ': ' || content, chr(10) ORDER BY msg_idx) AS history FROM msgs WHERE role IN ('user', 'assistant') AND content <> '' GROUP BY conv_id")
def user_visible_history(spark, d):
    return D.user_visible(B.messages(spark, d))


@query(f"{B.sql('msgs')} SELECT conv_id, string_agg('[' || upper(role) || '] ' || coalesce(content, ''), chr(10) ORDER BY msg_idx) AS transcript FROM msgs GROUP BY conv_id")
def transcript(spark, d):
    return D.transcript(B.messages(spark, d))


@query(f"{B.sql('msgs')}, w AS (SELECT conv_id, string_agg(upper(role) || ': ' || coalesce(content, ''), chr(10) || chr(10) ORDER BY msg_idx) AS c FROM msgs GROUP BY conv_id) SELECT conv_id, CASE WHEN length(c) > 400 THEN '[earlier turns left out]' || chr(10) || right(c, 400) ELSE c END AS context FROM w")
def context_tail(spark, d):
    return D.context_tail(B.messages(spark, d), 400)


@query(f"""{B.sql('msgs')}, w AS (SELECT conv_id, unnest(regexp_split_to_array(content, '[ \\t\\n\\x0b\\f\\r]+')) AS w FROM msgs WHERE role = 'user') SELECT DISTINCT conv_id, word FROM (SELECT conv_id, trim(w, '.,!?;:"''()[]{{}}') AS word FROM w) WHERE length(word) >= 3""")
def user_words(spark, d):
    return D.user_words(B.messages(spark, d))


@query(f"{B.sql('msgs')} SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS user_turns FROM msgs GROUP BY conv_id")
def turn_counts(spark, d):
    return D.turn_counts(B.messages(spark, d))


@query(f"{B.sql('msgs')} SELECT conv_id, arg_max(content, msg_idx) AS last_user FROM msgs WHERE role = 'user' GROUP BY conv_id")
def last_user_message(spark, d):
    return D.last_user_message(B.messages(spark, d))


@query(f"{B.sql('msgs')} SELECT conv_id, msg_idx, contains(content, '?') OR row_number() OVER (PARTITION BY conv_id ORDER BY msg_idx) = 1 AS clarifies FROM msgs WHERE role = 'assistant'")
def clarification_flags(spark, d):
    return D.clarifications(B.messages(spark, d))


@query(f"{B.sql('msgs')}, s AS (SELECT *, CASE WHEN lag(role) OVER w IS DISTINCT FROM role THEN 1 ELSE 0 END AS s FROM msgs WINDOW w AS (PARTITION BY conv_id ORDER BY msg_idx)), i AS (SELECT *, CAST(sum(s) OVER (PARTITION BY conv_id ORDER BY msg_idx) AS BIGINT) AS island FROM s) SELECT conv_id, island, any_value(role) AS role, count(*) AS parts, CAST(sum(length(content)) AS BIGINT) AS chars FROM i GROUP BY conv_id, island")
def role_islands(spark, d):
    return D.role_islands(B.messages(spark, d))


@query(f"{B.sql('calls', 'convs')}, {_PER} SELECT conv_id, CAST(least(CASE WHEN n_calls = 0 THEN 1.0 ELSE 5.0 END, CASE WHEN n_tools >= 5 THEN 2.5 ELSE 5.0 END) AS DOUBLE) AS tool_correctness, CAST(CASE WHEN n_calls <= 2 THEN 2.0 ELSE 5.0 END AS DOUBLE) AS task_completion FROM per")
def structural_caps(spark, d):
    per = M.per_conversation(B.conversations(spark, d), B.calls(spark, d))
    rows = per.select("conv_id", F.lit(5.0).alias("tool_correctness"), F.lit(5.0).alias("task_completion"), F.lit(1).alias("planned"), "n_calls", F.col("n_calls").alias("n_messages"), (F.col("n_tools") >= 5).alias("broken"))
    return D.structural_caps(rows).select("conv_id", "tool_correctness", "task_completion")


@query(f"{B.sql('jcalls')}, a AS (SELECT conv_id, call_idx, json_extract_string(arguments, '$.k') AS value FROM jcalls), k AS (SELECT conv_id, value, min(call_idx) AS since FROM a GROUP BY 1, 2) SELECT a.conv_id, a.call_idx, 'hotelId' AS name, a.value FROM a JOIN k USING (conv_id, value) WHERE call_idx > 0 AND since >= call_idx AND value NOT IN ('1', '2', '3')")
def chain_breaks(spark, d):
    rows = B.json_calls(spark, d).select("conv_id", "call_idx", F.get_json_object("arguments", "$.k").alias("value"))
    said = rows.select("conv_id").distinct().select("conv_id", F.explode(F.array(F.lit("1"), F.lit("2"), F.lit("3"))).alias("word"))
    return D.chain_breaks(rows.withColumn("name", F.lit("hotelId")), rows.withColumn("name", F.lit("hotel_id")), said)


_GEN = ", ".join(f"'{x}'" for x in dict.fromkeys(K.GENERIC_FIELDS + K.INFRA_FIELDS))


@query(f"{B.sql('fields')}, e AS (SELECT endpoint, list(DISTINCT field) FILTER (kind = 'output') AS o, list(DISTINCT field) FILTER (kind = 'input') AS i FROM fields GROUP BY endpoint), l AS (SELECT endpoint, coalesce(o, []) AS o, coalesce(i, []) AS i FROM e) SELECT endpoint, len(o) = 0 OR len(list_filter(o, lambda x: list_contains(i, x))) / greatest(len(o), 1) > 0.5 OR len(list_filter(o, lambda x: NOT list_contains(i, x) AND x NOT IN ({_GEN}))) < 2 AS needed FROM l")
def needs_enrichment(spark, d):
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("field"))).alias(kind)
    return B.fields(spark, d).groupBy("endpoint").agg(of("output"), of("input")).select("endpoint", Q.needs_enrichment(F.col("output"), F.col("input")).alias("needed"))


_SCHEMAS = "schemas AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{\"properties\": ' || props || '}' WHEN 1 THEN '{\"a\": 1, \"b\": 2}' WHEN 2 THEN props ELSE '{\"properties\": {}, \"type\": \"object\"}' END AS s FROM events)"


@query(f"WITH {_SCHEMAS} SELECT event_id, CASE WHEN len(coalesce(json_keys(json_extract(s, '$.properties')), [])) > 0 THEN 'complete' WHEN len(json_keys(s)) > 1 THEN 'inferred' ELSE 'minimal' END AS quality FROM schemas")
def schema_quality(spark, d):
    k = F.col("event_id") % 4
    s = F.when(k == 0, F.concat(F.lit('{"properties": '), "props", F.lit("}"))).when(k == 1, '{"a": 1, "b": 2}').when(k == 2, F.col("props")).otherwise('{"properties": {}, "type": "object"}')
    return B.read(spark, d, "events").select("event_id", Q.schema_quality(s).alias("quality"))


@query("WITH t AS (SELECT p_type AS category, p_brand AS stem, CAST(p_partkey AS VARCHAR) AS api, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN p_name END AS schema FROM part), x AS (SELECT p_type AS category, p_brand AS stem, CAST(p_partkey AS VARCHAR) AS api, max(CAST(p_size AS VARCHAR)) AS example FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2, 3) SELECT category, stem, api, coalesce(nullif(schema, ''), example) AS schema FROM t LEFT JOIN x USING (category, stem, api)")
def response_merge(spark, d):
    p = B.read(spark, d, "part").select(F.col("p_type").alias("category"), F.col("p_brand").alias("stem"), F.col("p_partkey").cast("string").alias("api"), "p_partkey", "p_name", "p_size")
    k = F.col("p_partkey") % 3
    tools = p.select("category", "stem", "api", F.when(k == 0, "").when(k == 1, F.col("p_name")).alias("schema"))
    return wire.merge_responses(tools, p.where("p_partkey % 2 = 0").select("category", "stem", "api", F.col("p_size").cast("string").alias("schema")))


@query("WITH l AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{\"messages\": [], \"x\": ' || props || '}' WHEN 1 THEN '{\"messages\": [], \"tool_calls\": []}' ELSE props END AS line FROM events) SELECT event_id, list_contains(json_keys(line), 'messages') AND NOT list_contains(json_keys(line), 'tool_calls') AND NOT list_contains(json_keys(line), 'tool_outputs') AS wire FROM l")
def wire_detect(spark, d):
    k = F.col("event_id") % 3
    line = F.when(k == 0, F.concat(F.lit('{"messages": [], "x": '), "props", F.lit("}"))).when(k == 1, '{"messages": [], "tool_calls": []}').otherwise(F.col("props"))
    return B.read(spark, d, "events").select("event_id", wire.is_wire(line).alias("wire"))


_BOTH = "l AS (SELECT event_id, event_id % 4 AS k, CAST(event_id AS VARCHAR) AS id FROM events)"


@query(f"WITH {_BOTH} SELECT 'c' || id AS conversation_id, 2 AS n_messages, 't' || id AS tool, CASE k WHEN 2 THEN 't' || id ELSE 'go' END AS api, CASE WHEN k = 1 THEN 4.0 END AS naturalness FROM l WHERE k <> 3")
def read_conversations(spark, d):
    """Both forms in one input: wire, full, wire with a call of a tool alone, and full with scores out of range, which goes."""
    call = F.col("messages")[1]["tool_calls"][0]
    return wire.read_any(_both(spark, d)).select("conversation_id", F.size("messages").alias("n_messages"), call["tool"].alias("tool"), call["api"].alias("api"), "naturalness")


def _both(spark, d):
    k, i = F.col("event_id") % 4, F.col("event_id").cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    wire_line = text('{"conversation_id":"c', i, '","messages":[{"role":"user","content":"x"},{"role":"assistant","tool_calls":[{"endpoint":"t', i, F.when(k == 0, "/go").otherwise(""), '"}]}]}')
    full = text('{"conversation_id":"c', i, '","tool_calls":[],"messages":[{"role":"user","content":"x"},{"role":"assistant","tool_calls":[{"tool_name":"t', i, '","api_name":"go"}]}],"judge_scores":{"naturalness":', F.when(k == 1, "4").otherwise("9"), ',"tool_correctness":3,"task_completion":3}}')
    return B.read(spark, d, "events").select(F.when(k % 2 == 0, wire_line).otherwise(full).alias("value"))


def _islands(spark, d):
    """Wire lines of an assistant with so many calls as the event's number says, and so many tool messages after it, of which the second is text."""
    e = F.col("event_id")
    call = lambda i: F.concat(F.lit('{"endpoint":"t'), i.cast("string"), F.lit('/a","arguments":{"n":'), i.cast("string"), F.lit("}}"))
    out = lambda i: F.when(i == 1, '{"role":"tool","content":"plain"}').otherwise(F.concat(F.lit('{"role":"tool","content":{"r":'), i.cast("string"), F.lit("}}")))
    some = lambda n, f: F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), f), ",")).otherwise("")
    calls, outs = (e % 4).cast("int"), (F.floor(e / 4) % 5).cast("int")
    tools = F.when(outs > 0, F.concat(F.lit(","), some(outs, out))).otherwise("")
    line = F.concat(F.lit('{"conversation_id":"c'), e.cast("string"), F.lit('","messages":[{"role":"user","content":"x"},{"role":"assistant","content":null,"tool_calls":['), some(calls, call), F.lit("]}"), tools, F.lit(',{"role":"odd"},{"role":"assistant","content":"done"}]}'))
    return cut(B.dealt(B.read(spark, d, "events").select("event_id"), "event_id")).select(line.alias("value"))


_ISL = "l AS (SELECT event_id, event_id % 4 AS k, (event_id // 4) % 5 AS n FROM events)"


@query(f"WITH {_ISL}, j AS (SELECT *, unnest(range(n)) AS i FROM l) SELECT 'c' || CAST(event_id AS VARCHAR) AS conversation_id, CASE WHEN i < k THEN 't' || CAST(i AS VARCHAR) ELSE 'unknown' END AS tool, CASE WHEN i = 1 THEN '{{\"result\":\"plain\"}}' ELSE '{{\"r\":' || CAST(i AS VARCHAR) || '}}' END AS response, CAST(CASE WHEN i < k THEN 2 ELSE 2 + CASE WHEN least(k, n) > 0 THEN 1 ELSE 0 END + i - least(k, n) END AS INTEGER) AS msg_idx FROM j")
def message_islands(spark, d):
    """Outputs with the calls that take them, the message that holds them, and orphans."""
    rows = wire.read_wire(_islands(spark, d)).select("conversation_id", F.posexplode("messages").alias("msg_idx", "m"))
    return rows.select("conversation_id", "msg_idx", F.explode("m.tool_outputs").alias("o")).select("conversation_id", "o.tool", "o.response", "msg_idx")


@query(f"WITH {_ISL}, j AS (SELECT *, unnest(range(k)) AS i FROM l) SELECT 'c' || CAST(event_id AS VARCHAR) AS conversation_id, 1 AS msg_idx, 't' || CAST(i AS VARCHAR) AS tool, 'a' AS api FROM j WHERE i >= n")
def unanswered_calls(spark, d):
    """Calls without an output, which get an error for a result."""
    return wire.unanswered(wire.read_wire(_islands(spark, d))).drop("response")


@query(f"WITH {_ISL} SELECT 'c' || CAST(event_id AS VARCHAR) AS conversation_id, CASE WHEN k = 0 THEN 1 ELSE 0 END AS empty_messages, CAST(greatest(n - k, 0) AS INTEGER) AS orphan_outputs, CAST(greatest(k - n, 0) AS INTEGER) AS unanswered_calls, CASE WHEN k > 0 THEN 1 ELSE 0 END AS deepest, k > 0 AND n = k AS sound FROM l")
def conversation_invariants(spark, d):
    return wire.invariants(wire.read_wire(_islands(spark, d)))


@query(f"WITH {_BOTH} SELECT CASE k WHEN 3 THEN 'scores are from 1 to 5' ELSE 'read' END AS outcome, count(*) AS n FROM l GROUP BY 1")
def line_outcomes(spark, d):
    """Every line is read or rejected with a reason."""
    return wire.sorted_lines(_both(spark, d)).groupBy(F.coalesce("reason", F.lit("read")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
