"""URL filters by empirical-Bayes host reputation, DataFrame functions only.

A url is judged by the longest rule that fits its host and path; where none
fits, by the reputation of its host.  Reputations come from pages with a known
outcome (1: bad, 0: good) by beta-binomial shrinkage down a tree: all pages ->
suffix (last label of a host) -> registered domain (last two labels, three
behind a two-part suffix) -> host.  A node with n outcomes, b of them bad, and
a parent of mean m has the posterior Beta(b + s m, n - b + s (1 - m)); its mean
is the parent mean of the next level.  The strength s is estimated per level
from all its nodes by the method of moments: for the beta-binomial,
E[n (b/n - m)^2] = m (1 - m) (1 + r (n - 1)), s = 1/r - 1.  A host is blocked
if the lower bound of its posterior (mean minus ``Z`` standard deviations)
reaches ``BLOCK_AT``, so that few outcomes don't block a host on their own.

Hosts are aggregated before anything is joined.  A join looks a parent up by a
key that a third of all rows may share (``common.look_up``: the few heavy keys are
broadcast, the others joined by a shuffle).  Sums of the moments are taken in
integer millionths: the same in any order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import look_up, materialize, read_table

#: (host, path, verdict) of the rules of ``op12_url_filter``; fixed values.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block")]
#: Second labels behind which a registered domain has three labels.
TWO_PART = ["ac", "co", "com", "edu", "gov", "net", "org"]
#: Posterior standard deviations of the bound, least bound that blocks.
Z, BLOCK_AT = 1.645, 0.5
#: Bounds of the estimated correlation r of the outcomes within a node.
LEAST_R, MOST_R = 0.001, 0.999
EDGE = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty where it is null or has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of two as long, one that blocks), else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block")):  # a later, longer rule covers an earlier one
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def parents(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; a port is no part of them, an address is its own domain."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    label = F.split(name, r"\.")
    n = F.size(label)
    take = F.when((n > 2) & (F.length(F.element_at(label, -1)) == 2) & F.try_element_at(label, F.lit(-2)).isin(TWO_PART), 3).otherwise(2)
    whole = (n <= take) | name.rlike(r"^([0-9]+\.){3}[0-9]+$")
    return F.when(whole, name).otherwise(F.array_join(F.slice(label, -take, take), ".")), F.element_at(label, -1)


def _strength(nodes: DataFrame) -> float:
    """s of a level: ``nodes`` have n, b and the parent's mean m (strictly between 0 and 1)."""
    spread = F.col("n") * F.pow(F.col("b") / F.col("n") - F.col("m"), 2.0) / (F.col("m") * (1 - F.col("m")))
    x = (nodes.where("n > 0").agg(F.sum(F.round(spread * 1e6).cast("long")).alias("spread"), F.count("*").alias("k"),
                                  F.sum(F.col("n") - 1).alias("more")).first())
    r = (x["spread"] / 1e6 - x["k"]) / x["more"] if x["more"] else LEAST_R
    return 1 / min(MOST_R, max(LEAST_R, r)) - 1


def _shrunk(s: float) -> Column:
    """Posterior mean, kept off 0 and 1 where rounding would reach them."""
    return F.least(F.lit(1 - EDGE), F.greatest(F.lit(EDGE), (F.col("b") + s * F.col("m")) / (F.col("n") + s)))


def host_reputations(outcomes: DataFrame) -> DataFrame:
    """host, pages, n, b, mean, low for every host of ``outcomes``.

    ``outcomes``: host, bad (1, 0, or null for a page without a known outcome);
    other values of bad count as unknown, a null host as the empty one.  Without
    any known outcome all means are one half and no host is blocked.
    """
    known = F.col("bad").isin(0, 1)
    hosts = outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(
        F.count("*").alias("pages"), F.count(F.when(known, 1)).alias("n"), F.count(F.when(F.col("bad") == 1, 1)).alias("b"))
    domain, suffix = parents(F.col("host"))
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("b").alias("b"), F.count("*").alias("uses")]
    domains = materialize(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(*sums), "suffixes")
    every = suffixes.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.sum("uses").alias("uses")).first()
    n, b = every["n"] or 0, every["b"] or 0
    suffixes = suffixes.withColumn("m", F.lit((b + 1) / (n + 2)))
    suffixes = suffixes.withColumn("mean", _shrunk(_strength(suffixes)))
    domains = materialize(look_up(domains.withColumnRenamed("uses", "hosts"), suffixes.select("suffix", "uses", F.col("mean").alias("m")),
                                  "suffix", every["uses"] or 0), "domains")
    domains = domains.withColumn("mean", _shrunk(_strength(domains)))
    count = domains.agg(F.sum("hosts")).first()[0] or 0
    # a host's suffix is that of its domain
    hosts = materialize(look_up(hosts, domains.select("domain", F.col("hosts").alias("uses"), F.col("mean").alias("m")), "domain", count), "hosts")
    s = _strength(hosts)
    mean = _shrunk(s)
    low = F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + s + 1))
    return hosts.withColumn("mean", mean).select("host", "pages", "n", "b", "mean", low.alias("low"))


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, bad: str | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, low for every row of ``pages``.

    ``bad`` names the column with the known outcome of a page (1, 0, else
    unknown); without it the outcome of a page is the verdict of the rule that
    fits it, and unknown where none does.  low is the bound of the host's
    reputation.  Null urls and such without ``://`` have an empty host, which has a
    reputation like any other.  Rows that repeat, and null ids, are judged one by
    one; other columns are not read; an empty table gives an empty result.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
                         (F.col(bad).cast("int") if bad else F.lit(None).cast("int")).alias("bad"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "verdict": verdict})
    if not bad:
        parts = parts.withColumn("bad", (F.col("verdict") == "block").cast("int"))
    seen = materialize(host_reputations(parts), "reputations")
    total = seen.agg(F.sum("pages")).first()[0] or 0
    known = look_up(parts.drop("bad"), seen.select("host", F.col("pages").alias("uses"), "low"), "host", total)
    by_host = F.when(F.col("low") >= BLOCK_AT, "block").otherwise("allow")
    return known.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"), "low")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages.  The pages that a rule fits are those with a known
    outcome (no table labels pages); the others are judged by their hosts."""
    return filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url")).drop("low")


def _sql_rules(column: int) -> str:
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    best = sorted(RULES, key=lambda r: (len(r[0] + r[1]), r[2] == "block"), reverse=True)
    return "CASE " + " ".join(f"WHEN {fits.format(h, p)} THEN '{v if column else h + p}'" for h, p, v in best) + " END"


_SPREAD = "sum(round(n * power(b / nullif(n, 0) - m, 2) / (m * (1 - m)) * 1e6)::BIGINT)"


def _sql_strength(level: str) -> str:
    r = f"coalesce(({_SPREAD} / 1e6 - count(*) FILTER (n > 0)) / nullif(sum(n - 1) FILTER (n > 0), 0), {LEAST_R})"
    return f"SELECT 1 / least({MOST_R}, greatest({LEAST_R}, {r})) - 1 AS s FROM {level}"


_SHRUNK = f"least(1 - {EDGE}, greatest({EDGE}, (b + s * m) / (n + s)))"
_TWO_PART = ", ".join(f"'{x}'" for x in TWO_PART)
OP12_SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, {_sql_rules(0)} AS rule, {_sql_rules(1)} AS verdict FROM parts),
h0 AS (SELECT host, count(verdict)::DOUBLE AS n, count(*) FILTER (verdict = 'block')::DOUBLE AS b,
              regexp_replace(host, ':[0-9]*$', '') AS name FROM ruled GROUP BY host),
h1 AS (SELECT host, n, b, name, string_split(name, '.') AS label FROM h0),
h2 AS (SELECT *, label[-1] AS suffix, CASE WHEN len(label) > 2 AND length(label[-1]) = 2 AND label[-2] IN ({_TWO_PART}) THEN 3 ELSE 2 END AS take FROM h1),
h3 AS (SELECT host, n, b, suffix, CASE WHEN len(label) <= take OR regexp_matches(name, '^([0-9]+\.){{3}}[0-9]+$') THEN name
              ELSE array_to_string(label[len(label) - take + 1:], '.') END AS domain FROM h2),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM h3 GROUP BY domain, suffix),
s0 AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM d0 GROUP BY suffix),
s1 AS (SELECT *, (SELECT (sum(b) + 1) / (sum(n) + 2) FROM s0) AS m FROM s0),
s2 AS (SELECT suffix, {_SHRUNK} AS m FROM s1, ({_sql_strength('s1')})),
d1 AS (SELECT d0.*, s2.m FROM d0 JOIN s2 USING (suffix)),
d2 AS (SELECT domain, {_SHRUNK} AS m FROM d1, ({_sql_strength('d1')})),
h4 AS (SELECT h3.*, d2.m FROM h3 JOIN d2 USING (domain)),
h5 AS (SELECT host, n + s AS size, {_SHRUNK} AS mean FROM h4, ({_sql_strength('h4')}))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN mean - {Z} * sqrt(mean * (1 - mean) / (size + 1)) >= {BLOCK_AT} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN h5 USING (host)
"""
