"""URL filters: pattern rules found by their rarest literal token, in SQL functions only.

A rule is a regular expression over ``host + path`` with literal tokens that every
match must contain. Each rule is filed under the one of its tokens that fewest
distinct URLs hold. A URL's tokens fetch the rules filed under them, and only these
candidates run their expression. Rules that match compete by priority.

URLs are judged once each, however many pages repeat them, and rules are joined by
token; no page is compared with all rules. Token counts are aggregated before they
are shuffled and only kept for tokens that rules name, so common tokens cost little:
a rule is filed under a common token only if it has no other.

Defined results: a null URL, or one without ``://``, has an empty host and path,
matches no rule and gets the default verdict. Of equally strong matches the first
by text wins. Repeated pages get equal verdicts; pages may have a null id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DEFAULT_VERDICT = "allow"


@dataclass(frozen=True)
class UrlRule:
    """``tokens`` are whole tokens, or whole a-z0-9 runs of one, of every host + path that ``pattern`` matches; a higher ``priority`` wins."""

    rule: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int
    base: bool = False


def prefix_rule(verdict: str, host: str, path: str) -> UrlRule:
    """For a host, its subdomains, and paths that start with ``path``; longer rules are stronger than any pattern rule."""
    # The last token of a prefix may go on in a longer token of the URL.
    text = host + path
    whole = re.findall(TOKEN, host) + [m.group() for m in re.finditer(TOKEN, path.lower()) if m.end() < len(path)]
    return UrlRule(text, verdict, rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(whole), 1_000_000 + len(text), True)


def word_rule(verdict: str, word: str) -> UrlRule:
    """For a word that stands alone anywhere in the host or path."""
    return UrlRule(f"*{word}*", verdict, rf"(^|[^a-z0-9]){word}([^a-z0-9]|$)", (word,), len(word))


# Host and path rules of the base, and words of the pattern rules.
BASE_RULES = (
    prefix_rule("block", "net", "/"),
    prefix_rule("allow", "example.net", "/en/"),
    prefix_rule("block", "example.com", "/de/"),
    prefix_rule("allow", "org", "/fr/"),
)
PATTERN_RULES = (
    *(word_rule("block", w) for w in ("casino", "porn", "xxx", "adserver", "doubleclick", "phishing", "malware", "torrent", "gambling", "betting")),
    UrlRule("free-download", "block", r"(^|[^a-z0-9])free[-_]downloads?([^a-z0-9]|$)", ("free",), 13),
    UrlRule("wp-login.php", "block", r"/wp-login\.php$", ("wp", "login", "php"), 12),
)


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Distinct tokens; only A-Z are folded."""
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(small, F.lit(TOKEN), F.lit(0)))


def fetching(text: Column) -> Column:
    """Tokens, and their runs of a-z0-9: pattern rules take other letters as a boundary."""
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_union(tokens(text), F.regexp_extract_all(small, F.lit("[a-z0-9]+"), F.lit(0)))


def rule_frame(spark: SparkSession, rules: tuple[UrlRule, ...]) -> DataFrame:
    """The rules as rows; made of literals, so that no Python worker starts."""
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.rule} has no literal token")
    if not rules:
        none = "rule:string, verdict:string, pattern:string, tokens:array<string>, priority:int, base:boolean"
        return spark.range(0).select(F.lit(None).cast(f"struct<{none}>").alias("r")).select("r.*")

    def row(r: UrlRule):
        return F.struct(
            F.lit(r.rule).alias("rule"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.pattern).alias("pattern"),
            F.array(*map(F.lit, r.tokens)).alias("tokens"),
            F.lit(r.priority).cast("int").alias("priority"),
            F.lit(r.base).alias("base"),
        )

    return spark.range(1).select(F.inline(F.array(*map(row, rules))))


def indexed(rules: DataFrame, url_tokens: DataFrame) -> DataFrame:
    """The rules, each with the ``token`` of its own that fewest URLs hold (ties: first by text)."""
    named = rules.select("rule", "pattern", F.explode("tokens").alias("token"))
    counts = url_tokens.join(named.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = (
        named.join(counts, "token", "left")
        .groupBy("rule", "pattern")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("least"))
    )
    return rules.join(rarest, ["rule", "pattern"]).select("rule", "verdict", "pattern", "priority", "base", F.col("least.token").alias("token"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url and the strongest matching rule (rule, verdict, base) of distinct urls (url, host, path) that match one."""
    split = urls.select("url", F.concat("host", "path").alias("place"))
    held = split.select("url", "place", F.explode(fetching(F.col("place"))).alias("token"))
    candidates = held.join(indexed(rules, held.select("token")), "token")
    lowered = F.translate("place", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Base rules heed the case of a path, pattern rules do not.
    fits = F.when(F.col("base"), F.regexp(F.col("place"), F.col("pattern"))).otherwise(F.regexp(lowered, F.col("pattern")))
    strength = F.struct(F.col("priority"), F.col("verdict"), F.col("rule"), F.col("base"))
    return candidates.where(fits).groupBy("url").agg(F.max(strength).alias("won")).select("url", "won.rule", "won.verdict", "won.base")


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = (*BASE_RULES, *PATTERN_RULES), default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule (of the base, else null), verdict, and pattern_rule for every page (page_id, url)."""
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = rows.where("url IS NOT NULL").select("url", "host", "path").distinct()
    won = matches(urls, rule_frame(pages.sparkSession, rules)).withColumnRenamed("verdict", "found")
    return rows.join(won, "url", "left").select(
        "page_id",
        "host",
        "path",
        F.when(F.col("base"), F.col("rule")).alias("rule"),
        F.coalesce("found", F.lit(default)).alias("verdict"),
        F.when(~F.col("base"), F.col("rule")).alias("pattern_rule"),
    )
