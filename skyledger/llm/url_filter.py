"""URL filtering by host rules and by pattern rules.

A host rule decides about its host, all subdomains, and the paths that begin with its own; the longest that
fits wins. It is found by equality: a URL looks up its host's last labels with its path's first characters,
for the label counts and path lengths that rules have. A URL that no host rule decides about goes to the
pattern rules. These are indexed by their rarest literal token, rare in the URLs at hand; a URL's tokens
fetch its candidate rules, and only those run their regular expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import carried, saved

ALLOW, BLOCK = "allow", "block"

# The columns that :func:`filter_urls` adds.
ADDED = ["_host", "_path", "_rule", "_pattern", "_verdict"]

# Fixed by the query contract: (host, path, action).
HOST_RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


@dataclass(frozen=True)
class Pattern:
    """A URL that matches ``regex`` is blocked; each literal is a token of every such URL.

    A word that the expression does not end, like ``php`` where ``php5`` matches too, is no such literal.
    """

    name: str
    regex: str
    literals: tuple[str, ...]


_HOST = r"://([a-z0-9-]+[.])*"
PATTERNS = [
    Pattern("adult host", _HOST + r"adult-[a-z0-9-]+[.]", ("adult",)),
    Pattern("betting host", _HOST + r"([a-z0-9]+-)*bets(-[a-z0-9]+)*[.]", ("bets",)),
    Pattern("casino host", _HOST + r"([a-z0-9]+-)*casino(-[a-z0-9]+)*[.]", ("casino",)),
    Pattern("pills host", _HOST + r"(cheap|online)-pills[.]", ("pills",)),
    Pattern("spam host", _HOST + r"spam-[a-z0-9-]+[.]", ("spam",)),
    Pattern("tracker host", _HOST + r"ads-track(er|ing)?[.]", ("ads",)),
    Pattern("casino page", r"://[^/?#]+/([^?#]*/)?online-casino([/.-]|$)", ("online", "casino")),
    Pattern("login page", r"://[^/?#]+/([^?#]*/)?login[.]php", ("login",)),
]

_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(text, _UPPER, _LOW)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for NULL and for a URL without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def host_rule_table(spark: SparkSession, rules=None) -> DataFrame:
    """host, path, action."""
    rows = HOST_RULES if rules is None else rules
    made = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rows]
    return spark.range(1).select(F.inline(F.array(*made)))


def pattern_table(spark: SparkSession, patterns=None) -> DataFrame:
    """name, regex, literals."""
    rows = PATTERNS if patterns is None else patterns
    made = [
        F.struct(F.lit(p.name).alias("name"), F.lit(p.regex).alias("regex"), F.array(*map(F.lit, p.literals)).cast("array<string>").alias("literals"))
        for p in rows
    ]
    return spark.range(1).select(F.inline(F.array(*made)))


def _looked_up(asked: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """The inner join of what URLs ask for with rules, in which only the rules can be broadcast.

    What is asked comes from a compressed file and has several rows per URL, so that Spark's estimate is many times
    too low, and an inner join would send all of it through the driver. Spark never broadcasts the left side of these two
    joins; after the first, each row has a rule. A filter on a rule's column above them would make the second an inner join.
    """
    return asked.join(rules.select(*keys), keys, "left_semi").join(rules, keys, "left")


def _host_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule, action for every host rule that fits; ``urls`` has url, host, path."""
    rules = rules.withColumns({"labels": F.size(F.split("host", "[.]")), "length": F.char_length("path")})
    # As many pairs as there are label counts and path lengths among the rules, however many rules.
    shapes = [(r.labels, r.length) for r in rules.select("labels", "length").distinct().collect()]
    lookups = [
        F.struct(F.substring_index("host", ".", -labels).alias("host"), F.substring("path", 1, length).alias("path"),
                 F.lit(labels).alias("labels"), F.lit(length).alias("length"))
        for labels, length in sorted(shapes)
    ]
    if not lookups:
        return urls.select("url", F.lit("").alias("rule"), F.lit("").alias("action")).limit(0)
    asked = urls.select("url", F.explode(F.array(*lookups)).alias("asked")).select("url", "asked.*")
    named = rules.withColumn("rule", F.concat("host", "path"))
    return _looked_up(asked, named, ["host", "path", "labels", "length"]).select("url", "rule", "action")


def _tokens(urls: DataFrame) -> DataFrame:
    """url, token: its distinct runs of letters and digits, lower-cased."""
    return urls.select("url", F.explode(F.array_distinct(F.split(_lower(F.col("url")), "[^a-z0-9]+"))).alias("token")).filter("token <> ''")


def _candidates(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """token, url, name, regex: each URL with the rules whose rarest literal it has."""
    tokens = _tokens(urls)
    literals = patterns.select("name", "regex", F.explode("literals").alias("token"))
    counts = tokens.join(literals.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = literals.join(counts, "token", "left").groupBy("name", "regex").agg(
        F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")
    )
    # Written, as it is asked twice, and small tables are broadcast by the size of their file, before tokens are shuffled.
    return _looked_up(tokens, saved(rarest), ["token"])


def _pattern_matches(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """url, pattern (the first name) of the URLs that a pattern rule blocks, and of others that have a candidate, with NULL."""
    candidates = _candidates(urls, patterns)
    # A rule without a literal has no place in the index and looks at every URL; there should be few.
    open_rules = patterns.filter(F.size("literals") == 0).select("name", "regex").collect()
    everywhere = [
        urls.filter(_lower(F.col("url")).rlike(r.regex)).select("url", F.lit(r.name).alias("name")) for r in open_rules
    ]
    matched = candidates.select("url", F.when(F.expr(f"translate(url, '{_UPPER}', '{_LOW}') RLIKE regex"), F.col("name")).alias("name"))
    return reduce(DataFrame.unionByName, everywhere, matched).groupBy("url").agg(F.min("name").alias("pattern"))


def filter_urls(pages: DataFrame, keep: list[str], rules: DataFrame | None = None, patterns: DataFrame | None = None,
                url_column: str = "url") -> DataFrame:
    """``keep`` columns of every row, and _host, _path, _rule (of the longest fitting host rule), _pattern, _verdict.

    The verdict is the host rule's action, else ``block`` if a pattern matched, else ``allow``. Each distinct
    URL is judged once, so that a URL on a third of all rows is no hot key; rows take the verdict from there.
    NULL URLs, and those without ``://``, have empty parts, fit no host rule and, if NULL, no pattern. Of two
    equally long rules, the same host and path with two actions, ``block`` wins. No rows give no rows. ``keep`` may have any
    names; one like an added column's is replaced by that.
    """
    spark = pages.sparkSession
    rules = host_rule_table(spark) if rules is None else rules
    patterns = pattern_table(spark) if patterns is None else patterns
    host, path = url_parts(F.col("url"))
    urls = saved(pages.select(F.col(url_column).cast("string").alias("url")).filter("url IS NOT NULL").distinct().withColumns({"host": host, "path": path}))
    by_host = _host_matches(urls, rules).groupBy("url").agg(
        F.max(F.struct(F.char_length("rule").alias("length"), F.col("action"), F.col("rule"))).alias("best")
    )
    by_pattern = _pattern_matches(urls, patterns)
    judged = urls.join(by_host, "url", "left").join(by_pattern, "url", "left").select(
        F.col("url").alias("_url"), F.col("host").alias("_host"), F.col("path").alias("_path"),
        F.col("best.rule").alias("_rule"), F.col("pattern").alias("_pattern"),
        F.coalesce("best.action", F.when(F.col("pattern").isNotNull(), BLOCK), F.lit(ALLOW)).alias("_verdict"),
    )
    rows = pages.select(carried(keep, ADDED), F.col(url_column).cast("string").alias("_url"))
    return rows.join(judged, "_url", "left").select(
        "_keep.*", F.coalesce("_host", F.lit("")).alias("_host"), F.coalesce("_path", F.lit("")).alias("_path"),
        "_rule", "_pattern", F.coalesce("_verdict", F.lit(ALLOW)).alias("_verdict"),
    )
