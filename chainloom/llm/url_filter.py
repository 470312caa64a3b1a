"""URL filters by empirical-Bayes host reputation [native].

Labelled page outcomes are counted by host, registered domain and public suffix. Each level's
rate is shrunk towards the level above it through a beta-binomial prior whose strength is
estimated from the labelled counts (method of moments). A host is blocked if even the lower
posterior bound of its rate of bad pages exceeds a limit. Explicit rules come first.

Everything is DataFrame expressions; counts are aggregated before any join, so a host with a
third of all pages contributes one row per task.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule, and the
reputation of the corpus as a whole. Repeated page ids are judged row by row. With no labelled
pages nothing is known and only the rules block. Extra columns of either table are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: (rule, verdict): a rule is a host followed by the start of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@dataclass(frozen=True)
class Reputation:
    """``z``: how many posterior standard deviations below the mean the bound lies.
    ``limit``: the rate of bad pages that the bound must exceed to block.
    ``least``, ``most``: range of a prior's strength in pages. ``two_label``: suffixes of two labels."""

    z: float = 1.645
    limit: float = 0.5
    least: float = 2.0
    most: float = 10_000.0
    two_label: tuple[str, ...] = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, two_label: tuple[str, ...]) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), two).otherwise(F.substring_index(host, ".", -1)) if two_label else F.substring_index(host, ".", -1)


def domain_of(host: Column, two_label: tuple[str, ...]) -> Column:
    """The suffix and one label more; hosts that are only a suffix stand for themselves."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), F.substring_index(host, ".", -3)).otherwise(two) if two_label else two


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null. A rule fits its host and its subdomains."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        of_host, slash, start = rule.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _strength(level: DataFrame, key: str, prior: Column, conf: Reputation) -> DataFrame:
    """One row: the prior's strength from the spread of the groups' rates around their priors.

    For a beta-binomial group with n pages, E[(b - n m)^2] = n m (1 - m) (1 + (n - 1) rho),
    and rho = 1 / (strength + 1). Summed over groups this gives rho by moments.
    """
    m, n, b = prior, F.col("n").cast("double"), F.col("bad").cast("double")
    over = F.sum((b - n * m) * (b - n * m) - n * m * (1 - m))
    scale = F.sum(n * (n - 1) * m * (1 - m))
    rho = F.greatest(F.lit(0.0), F.coalesce(F.try_divide(over, scale), F.lit(0.0)))
    return level.agg(F.round(F.least(F.lit(conf.most), F.greatest(F.lit(conf.least), F.coalesce(F.try_divide(1 - rho, rho), F.lit(conf.most)))), 6).alias(f"k_{key}"))


def reputation(labelled: DataFrame, conf: Reputation = Reputation()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``labelled``: host, bad (0 or 1). Returns posterior (mean, n) by host, domain, suffix and overall."""
    hosts = labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), conf.two_label), "suffix": suffix_of(F.col("host"), conf.two_label)})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("all_bad"))
    total = total.select("all_n", F.round((F.col("all_bad") + 0.5) / (F.col("all_n") + 1.0), 9).alias("m_all"))

    def posterior(level: DataFrame, above: DataFrame, on: str | None, prior: str, key: str) -> DataFrame:
        joined = level.join(above, on, "left") if on else level.join(F.broadcast(above))
        k = _strength(joined, key, F.col(prior), conf)
        joined = joined.join(F.broadcast(k))  # one row
        strength = F.col(f"k_{key}")
        return joined.withColumn(f"m_{key}", F.round((F.col("bad") + strength * F.col(prior)) / (F.col("n") + strength), 9))

    suffixes = posterior(suffixes, total.select("m_all"), None, "m_all", "suffix")
    domains = posterior(domains, suffixes.select("suffix", "m_suffix"), "suffix", "m_suffix", "domain")
    hosts = posterior(hosts, domains.select("domain", "m_domain"), "domain", "m_domain", "host")
    weigh = lambda df, key: df.select(key, f"m_{key}", (F.col("n") + F.col(f"k_{key}")).alias(f"w_{key}"))
    return weigh(hosts, "host"), weigh(domains, "domain"), weigh(suffixes, "suffix"), total.select(F.col("m_all"), (F.col("all_n") + 1.0).alias("w_all"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, conf: Reputation = Reputation()) -> DataFrame:
    """``pages``: page_id, url. ``labelled``: host, bad. Adds the rule, the posterior and the verdict.

    A host without labelled pages has its domain's posterior, else its suffix's, else the corpus's.
    """
    hosts, domains, suffixes, total = reputation(labelled, conf)
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    # Bounds are worked out once a distinct host, not once a page.
    known = judged.select("host").distinct().withColumns({"domain": domain_of(F.col("host"), conf.two_label), "suffix": suffix_of(F.col("host"), conf.two_label)})
    known = known.join(hosts, "host", "left").join(domains, "domain", "left").join(suffixes, "suffix", "left").join(F.broadcast(total))
    mean = F.coalesce("m_host", "m_domain", "m_suffix", "m_all")
    weight = F.coalesce("w_host", "w_domain", "w_suffix", "w_all")
    bound = F.round(mean - conf.z * F.sqrt(mean * (1 - mean) / (weight + 1)), 6)
    known = known.select("host", F.round(mean, 6).alias("bad_rate"), bound.alias("bad_bound"))
    verdict = F.when(F.col("bad_bound") > conf.limit, "block").otherwise("allow")
    by_rule = F.create_map(*[F.lit(x) for rule in rules for x in rule]) if rules else F.lit(None).cast("map<string,string>")
    verdict = F.coalesce(by_rule[F.col("rule")], verdict)
    # The page side keeps its rows where they are skewed: adaptive execution splits a hot host's partition.
    return judged.join(known, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bad_rate", "bad_bound")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page's outcome is that of the document its path names: ``/<lang>/<doc_id>``. Bad: low quality or toxic."""
    named = F.regexp_extract(path_of(F.col("url")), r"^/[a-z]+/([0-9]{1,18})", 1)
    of_page = pages.select(host_of(F.col("url")).alias("host"), F.when(named != "", named).cast("long").alias("doc_id")).where("doc_id is not null")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    of_doc = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return of_page.join(of_doc, "doc_id").select("host", "bad")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    return filter_urls(pages, labelled_pages(pages, labels))


def _sql() -> str:
    conf = Reputation()
    two = ", ".join(f"'{x}'" for x in conf.two_label)
    last = lambda k: f"array_to_string(list_slice(string_split(host, '.'), -{k}, -1), '.')"
    domain = f"CASE WHEN {last(2)} IN ({two}) THEN {last(3)} ELSE {last(2)} END"
    suffix = f"CASE WHEN {last(2)} IN ({two}) THEN {last(2)} ELSE {last(1)} END"
    fits = []
    for rule, _ in sorted(RULES, key=lambda r: -len(r[0])):
        h, _, start = rule.partition("/")
        fits.append(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{start}') THEN '{rule}'")
    by_rule = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    k = lambda m: (f"round(least({conf.most}, greatest({conf.least}, coalesce((1 - r) / nullif(r, 0), {conf.most}))), 6) FROM (SELECT greatest(0.0, coalesce(sum((bad - n * {m}) * (bad - n * {m}) - n * {m} * (1 - {m})) / nullif(sum(n * (n - 1.0) * {m} * (1 - {m})), 0), 0)) AS r FROM")
    return f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS h0 FROM pages
), p AS (
  SELECT page_id, translate(h0, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u
), o AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id
), l AS (
  SELECT host, bad FROM (SELECT host, TRY_CAST(nullif(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1), '') AS BIGINT) AS doc_id FROM p) JOIN o USING (doc_id)
), h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, {domain} AS domain, {suffix} AS suffix FROM l GROUP BY host
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix
), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix
), t AS (SELECT coalesce(sum(n), 0) + 1.0 AS w_all, round((coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0), 9) AS m_all FROM s
), s1 AS (SELECT s.*, m_all FROM s, t
), ks AS (SELECT {k('m_all')} s1)
), s2 AS (SELECT suffix, round((bad + k * m_all) / (n + k), 9) AS m_suffix, n + k AS w_suffix FROM s1, (SELECT * FROM ks) x(k)
), d1 AS (SELECT d.*, m_suffix FROM d LEFT JOIN s2 USING (suffix)
), kd AS (SELECT {k('m_suffix')} d1)
), d2 AS (SELECT domain, round((bad + k * m_suffix) / (n + k), 9) AS m_domain, n + k AS w_domain FROM d1, (SELECT * FROM kd) x(k)
), h1 AS (SELECT h.*, m_domain FROM h LEFT JOIN d2 USING (domain)
), kh AS (SELECT {k('m_domain')} h1)
), h2 AS (SELECT host, round((bad + k * m_domain) / (n + k), 9) AS m_host, n + k AS w_host FROM h1, (SELECT * FROM kh) x(k)
), hosts AS (SELECT DISTINCT host, {domain} AS domain, {suffix} AS suffix FROM p
), known AS (
  SELECT host, coalesce(m_host, m_domain, m_suffix, m_all) AS m, coalesce(w_host, w_domain, w_suffix, w_all) AS w
  FROM hosts LEFT JOIN h2 USING (host) LEFT JOIN d2 USING (domain) LEFT JOIN s2 USING (suffix), t
), bounds AS (SELECT host, round(m, 6) AS bad_rate, round(m - {conf.z} * sqrt(m * (1 - m) / (w + 1)), 6) AS bad_bound FROM known
), judged AS (SELECT page_id, host, path, CASE {' '.join(fits)} END AS rule FROM p)
SELECT page_id, host, path, rule,
       coalesce(CASE rule {by_rule} END, CASE WHEN bad_bound > {conf.limit} THEN 'block' ELSE 'allow' END) AS verdict, bad_rate, bad_bound
FROM judged LEFT JOIN bounds USING (host)"""


ORACLE = _sql()
