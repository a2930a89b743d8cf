from __future__ import annotations

import pytest

from skyledger.llm import url_filter as uf

URLS = [
    (1, "http://a.com/x"), (2, "https://Example.COM/en/1"), (3, "http://www.example.com/en/?q"), (4, "http://m.www.example.com/en/2#t"),
    (5, "http://b.net/es/3"), (6, "http://b.net/en/3"), (7, "http://example.com"), (8, "http://example.com/fr/"), (9, None), (10, "no scheme"),
    (11, ""), (12, "http://"), (13, "http://net/fr/"), (14, "http://x.net?u=/es/"), (15, "http://online-bets.org/"), (16, "http://casino.org/p"),
    (17, "http://my.adult-site.org"), (18, "http://site.org/a/online-casino.html?x"), (19, "a://b://c.net/es/"), (20, "http://x.org/EN/ÄÖ"),
    (21, "http://notexample.com/en/"), (22, "http://" + "a." * 3000 + "net/fr/" + "y" * 5000), (5, "http://b.net/es/3"), (None, "http://b.net/fr/"),
]


def plain(url):
    """Host, path, rule, verdict without patterns."""
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, a) for h, p, a in uf.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, action = max(fits, key=lambda f: len(f[0]), default=(None, None))
    return host, path, rule, action


@pytest.fixture(scope="module")
def judged(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    return uf.filter_urls(pages, ["page_id"]).collect()


def test_host_rules(judged):
    expected = sorted(((i, *plain(u)[:3]) for i, u in URLS), key=str)
    assert sorted(((r.page_id, r._host, r._path, r._rule) for r in judged), key=str) == expected
    verdicts = {r.page_id: r._verdict for r in judged}
    assert all(verdicts[i] == plain(u)[3] for i, u in URLS if plain(u)[2])


def test_patterns_decide_where_no_rule_does(judged):
    by_page = {r.page_id: (r._pattern, r._verdict) for r in judged}
    assert by_page[15] == ("betting host", "block")
    assert by_page[16] == ("casino host", "block")
    assert by_page[17] == ("adult host", "block")
    assert by_page[18] == ("casino page", "block")
    assert by_page[9] == by_page[10] == by_page[11] == by_page[20] == (None, "allow")


def test_index_uses_the_rarest_literal(spark):
    pages = spark.createDataFrame([(k, f"http://h.org/common/{k}") for k in range(20)] + [(99, "http://h.org/common/rare")], "page_id long, url string")
    patterns = [uf.Pattern("both", "common/rare$", ("common", "rare")), uf.Pattern("open", "/7$", ())]
    tokens = uf._tokens(pages)
    assert tokens.filter("token = 'common'").count() == 21
    found = uf.filter_urls(pages, ["page_id"], patterns=uf.pattern_table(spark, patterns)).filter("_pattern IS NOT NULL").collect()
    assert sorted((r.page_id, r._pattern) for r in found) == [(7, "open"), (99, "both")]


MATCHING = {
    "adult host": ["http://adult-x.org/", "http://a.adult-x-y.b.org"],
    "betting host": ["http://bets.org", "http://my-bets-now.org/"],
    "casino host": ["http://casino.org", "http://a.best-casino-1.org/"],
    "pills host": ["http://cheap-pills.org", "http://x.online-pills.org/a"],
    "spam host": ["http://spam-x.org", "http://a.spam-y.org/"],
    "tracker host": ["http://ads-track.org", "http://ads-tracker.org/", "http://x.ads-tracking.org"],
    "casino page": ["http://h.org/online-casino", "http://h.org/a/online-casino-x", "http://h.org/online-casino/x", "http://h.org/ONLINE-casino.html"],
    "login page": ["http://h.org/login.php", "http://h.org/a/login.php5", "http://h.org/login.phpx?u=1", "http://h.org/Login.PHP/x", "http://h.org/login.php_old"],
}


@pytest.mark.parametrize("rarest", [0, 1])
def test_the_index_loses_no_match_whichever_literal_is_rarest(spark, rarest):
    urls = [u for found in MATCHING.values() for u in found]
    for p in uf.PATTERNS:
        # The other literals, and words that look like ones, stand in many more URLs.
        common = [t for k, t in enumerate(p.literals) if k != min(rarest, len(p.literals) - 1)]
        urls += [f"http://h.org/{p.name[0]}{k}/{t}" for t in common + ["login" if rarest else "php"] for k in range(9)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    without = uf.pattern_table(spark, [uf.Pattern(p.name, p.regex, ()) for p in uf.PATTERNS])
    indexed = {r.url: r._pattern for r in uf.filter_urls(pages, ["url"]).collect()}
    assert indexed == {r.url: r._pattern for r in uf.filter_urls(pages, ["url"], patterns=without).collect()}
    assert {u: indexed[u] for found in MATCHING.values() for u in found} == {u: name for name, found in MATCHING.items() for u in found}


def test_equally_long_rules_and_own_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x")], "page_id long, url string")
    rules = uf.host_rule_table(spark, [("a.b", "/", "allow"), ("a.b", "/", "block")])
    assert uf.filter_urls(pages, ["page_id"], rules=rules).first()._verdict == "block"


def test_clashing_columns_and_no_rows(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(URLS[:3], "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "token", "rule", "_url2", "name")})
    assert len(uf.filter_urls(pages, ["page_id"]).collect()) == 3
    assert uf.filter_urls(pages.limit(0), ["page_id"]).collect() == []
    clash = pages.withColumns({c: F.lit(1) for c in ("_url", "_keep", "_host")})
    found = uf.filter_urls(clash, ["page_id", "_url", "_keep", "_host", "url"]).collect()
    assert {(r.url, r._url, r._keep) for r in found} == {(u, 1, 1) for _, u in URLS[:3]}
    assert {r.page_id: r._host for r in found} == {i: plain(u)[0] for i, u in URLS[:3]}


def test_ten_thousand_rules_are_reached_by_their_index(spark):
    """Each rule has a literal that most rules and URLs have and one of its own; a URL meets only rules of its own."""
    from pyspark.sql import functions as F

    n = 10_000
    one = F.col("id").cast("string")
    patterns = spark.range(n).select(
        F.format_string("rule %05d", "id").alias("name"),
        F.concat(F.lit("://[^/]*/shop/item"), one, F.lit("([^0-9]|$)")).alias("regex"),
        F.array(F.lit("shop"), F.concat(F.lit("item"), one)).alias("literals"),
    )
    rules = spark.range(n).select(
        F.concat(F.lit("h"), one, F.lit(".org")).alias("host"), F.concat(F.lit("/"), one, F.lit("/")).alias("path"), F.lit("allow").alias("action")
    )
    urls = [(k, f"http://{'www.' * (k % 2)}h{k}.org/{['shop', str(k), str(k + 1)][k % 3]}/item{k * 7}?x") for k in range(3000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = {r.page_id: (r._rule, r._pattern, r._verdict) for r in uf.filter_urls(pages, ["page_id"], rules, patterns).collect()}
    expected = {}
    for k, _ in urls:
        named = f"rule {k * 7:05d}" if k % 3 == 0 and k * 7 < n else None
        expected[k] = (f"h{k}.org/{k}/" if k % 3 == 1 else None, named, "block" if named else "allow")
    assert found == expected
    # As many candidates as URLs whose own word is a rule's, not one per URL and rule.
    assert uf._candidates(pages.select("url"), patterns).count() == sum(k * 7 < n for k, _ in urls)


def test_no_table_of_several_rows_per_url_is_broadcast(spark):
    """Its file's size tells little of its rows: the driver would hold all tokens of the URLs. Rules are broadcast if they are small."""
    from pyspark.sql import functions as F

    from skyledger.llm.common import saved

    n = 3000
    one = F.col("id").cast("string")
    # More rules than URLs, so that by their estimates URLs are what is smaller.
    rules = saved(spark.range(n).select(F.concat(F.lit("h"), one, F.lit(".org")).alias("host"), F.lit("/").alias("path"), F.lit("allow").alias("action")))
    patterns = saved(spark.range(n).select(F.concat(F.lit("rule "), one).alias("name"), F.concat(F.lit("/item"), one, F.lit("$")).alias("regex"),
                                           F.array(F.concat(F.lit("item"), one)).alias("literals")))
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 2 * 5000 + F.col("id")).cast("string"),
                                                                           F.lit(".org/a/b/c/item"), one).alias("url"))
    urls = saved(pages.select("url").withColumns(dict(zip(("host", "path"), uf.url_parts(F.col("url"))))))
    for found, rows in ((uf._host_matches(urls, rules), 100), (uf._pattern_matches(urls, patterns), 200), (uf._candidates(urls, patterns), 200),
                        (uf._host_matches(urls, uf.host_rule_table(spark, [("org", "/", "allow")])), 200)):
        assert len(found.collect()) == rows
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" in plan and "BuildLeft" not in plan
    # Candidates that their expression turns down are no matches.
    other = patterns.withColumn("regex", F.lit("/x$"))
    assert {r.pattern for r in uf._pattern_matches(urls, other).collect()} <= {None}
    judged = uf.filter_urls(pages, ["page_id"], rules, other).collect()
    assert len(judged) == 200 and {(r._pattern, r._verdict) for r in judged} == {(None, "allow")}
    assert sum(r._rule is not None for r in judged) == 100
