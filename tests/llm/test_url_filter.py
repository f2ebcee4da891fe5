from collections import Counter

import pytest
from pyspark.sql import functions as F

from aurum.llm import common
from aurum.llm.url_filter import RULES, filter_urls, host_reputations, op12_url_filter

URLS = [(1, "http://a.com/x"), (2, "HTTP://WWW.Example.COM/en/?q#f"), (3, "x://m.example.com/en/1"), (4, "http://s.net/es/"), (5, "http://s.net/en/1"),
        (6, "http://s.net"), (7, None), (8, "no scheme"), (9, ""), (10, "http://1.2.3.4:80/fr/"), (10, "http://1.2.3.4:80/fr/"),
        (None, "http://notnet/es/"), (12, "http://é.NET/es/é?x"), (13, "http://a.co.uk/a/b?c#d"), (14, "http://"), (15, "http://a.com")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end], rest[end:]
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules_against_plain_python(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'?' AS host", "'?' AS path", "'?' AS rule", "1 AS uses", "0 AS bad")
    got = filter_urls(df).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter(
        (i, *plain_parts(u), plain_rule(*plain_parts(u))[0]) for i, u in URLS)
    for r in got:
        if r.rule:
            assert r.verdict == plain_rule(r.host, r.path)[1]
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert next(r.rule for r in got if r.page_id == 2) == "www.example.com/en/"
    assert next(r.rule for r in got if r.page_id == 15) is None  # an empty path doesn't start with /


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def outcomes(spark, hosts):
    """hosts: {host: (good, bad, unknown)}"""
    rows = [(h, x) for h, ns in hosts.items() for x, n in zip((0, 1, None), ns, strict=True) for _ in range(n)]
    return spark.createDataFrame(rows, "host string, bad int")


def plain_reputations(hosts):
    """Means of hosts with two labels below domains, by the formulas, level by level."""
    def strength(nodes):
        nodes = [x for x in nodes if x[0]]
        more = sum(n - 1 for n, _, _ in nodes)
        spread = sum(round(n * (b / n - m) ** 2 / (m * (1 - m)) * 1e6) for n, b, m in nodes) / 1e6
        r = (spread - len(nodes)) / more if more else 0.001
        return 1 / min(0.999, max(0.001, r)) - 1
    n_b = {h: (g + b, b) for h, (g, b, _) in hosts.items()}
    tree = [{}, {}]
    for h, (n, b) in n_b.items():
        for level, key in enumerate((h.split(".")[-1], ".".join(h.split(".")[-2:]))):
            x = tree[level].get(key, (0, 0))
            tree[level][key] = x[0] + n, x[1] + b
    n, b = map(sum, zip(*n_b.values(), strict=True))
    parent = dict.fromkeys(tree[0], (b + 1) / (n + 2))
    for level, above in ((tree[0], lambda k: k), (tree[1], lambda k: k.split(".")[-1]), (n_b, lambda k: ".".join(k.split(".")[-2:]))):
        s = strength([(n, b, parent[above(k)]) for k, (n, b) in level.items()])
        parent = {k: (b + s * parent[above(k)]) / (n + s) for k, (n, b) in level.items()}
    return parent


HOSTS = {"a.bad.net": (1, 40, 0), "b.bad.net": (0, 9, 3), "c.bad.net": (0, 0, 5), "x.good.net": (50, 1, 2), "y.good.net": (0, 1, 1), "z.good.net": (30, 0, 0),
         "q.one.org": (0, 0, 4), "r.one.org": (5, 5, 0)}


def test_reputations_follow_the_formulas(spark):
    got = {r.host: r for r in host_reputations(outcomes(spark, HOSTS)).collect()}
    want = plain_reputations(HOSTS)
    assert {h: r.mean for h, r in got.items()} == pytest.approx(want, rel=1e-9)
    assert all(r.low < r.mean for r in got.values())
    # a host without outcomes takes after its domain; one bad outcome weighs less than forty
    assert got["c.bad.net"].mean > 0.8 > 0.3 > got["y.good.net"].mean
    assert got["a.bad.net"].low > 0.5 > got["y.good.net"].low


def test_no_outcomes_block_nothing(spark):
    got = host_reputations(outcomes(spark, {"a.b.net": (0, 0, 3), "": (0, 0, 1)})).collect()
    assert all(r.mean == pytest.approx(0.5) and r.low < 0.5 for r in got)


def test_given_outcomes_take_the_place_of_the_rules(spark):
    rows = [(i, f"http://evil.org/{i}", 1) for i in range(40)] + [(100 + i, f"http://fine{i % 5}.org/{i}", 0) for i in range(60)] + [(200, "http://evil.org/new", None)]
    got = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, known int"), bad="known").collect()}
    assert got[200] == "block" and got[100] == "allow"


def test_heavy_keys_are_broadcast_and_the_others_shuffled(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"), "id")
    table = rows.groupBy("key").agg(F.count("*").alias("uses"), F.min("id").alias("least"))
    out = common.look_up(rows, table, "key", 5000)
    assert out.count() == 5000 and out.where("least > id").count() == 0
    assert out.where("key = 'hot' AND least <> 0").count() == 0


def test_plan_has_no_python(spark):
    plan = op12_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
