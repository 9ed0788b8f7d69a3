"""Verdicts on URLs by pattern rules that are indexed by their rarest literal token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.rows import boxed, field
from ledgerloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules as (pattern, verdict), in the syntax of ``rules``; each fits a host and its subdomains.
SITES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

#: The method's own rules, below those for sites: paths that hold no prose, and addresses that serve advertising.
PATTERNS = (
    ("||ads.*^", "block"),
    ("||doubleclick.*^", "block"),
    ("/wp-login.php^", "block"),
    ("/wp-admin/", "block"),
    ("/cart/", "block"),
    ("/checkout/", "block"),
    ("/login^", "block"),
    ("/signup^", "block"),
    ("^replytocom=", "block"),
    ("^sessionid=", "block"),
    ("^utm_*=*^utm_", "block"),
    ("/tag/*/page/", "block"),
    (".zip|", "block"),
    (".exe|", "block"),
    (".mp4|", "block"),
    ("||wikipedia.org^", "allow"),
)


def rules(spark: SparkSession, sites=SITES, patterns=PATTERNS) -> DataFrame:
    """The rules as a table: ``name, pattern, verdict, priority, any_case``.

    In a pattern ``*`` is any text, ``^`` a separator or the end, ``|`` the start or end of the address, and ``||``
    the start of the host or of one of its parent domains. A site rule ``host/path`` is the pattern ``||host/path``
    and minds case.
    """
    rows = [(s, f"||{s}", v, 1, False) for s, v in sites] + [(p, p, v, 0, True) for p, v in patterns]
    return spark.createDataFrame(rows, "name string, pattern string, verdict string, priority int, any_case boolean")


def regular(pattern: Column, any_case: Column) -> Column:
    """The pattern as a regular expression on host, path and the rest of the address."""
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|?", ""), r"\|$", "")
    body = F.regexp_replace(body, r"([.+?$(){}\[\]\\|/-])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\*+", ".*"), r"\^", "(?:[^A-Za-z0-9_.%-]|\\$)")
    start = F.when(pattern.startswith("||"), r"^(?:[^/?#]*\.)?").when(pattern.startswith("|"), "^").otherwise("")
    end = F.when(pattern.endswith("|"), "$").otherwise("")
    return F.concat(F.when(any_case, "(?is)").otherwise("(?s)"), start, body, end)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def literals(pattern: Column) -> Column:
    """Tokens (runs of a-z and 0-9) that every address which fits has as whole tokens.

    A run counts if literal text, a separator or an anchor stands on both of its sides.
    """
    open_ended = F.regexp_replace(F.regexp_replace(F.concat(F.lit("*"), pattern, F.lit("*")), r"^\*\|\|?", "^"), r"\|\*$", "^")
    return F.array_distinct(F.regexp_extract_all(lowered(open_ended), F.lit(r"(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"), F.lit(1)))


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and the rest of a URL; all empty if it is null or has no ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$", n), F.lit(""))
    return lowered(part(1)), part(2), part(3)


def tokens(subject: Column) -> Column:
    """The address's distinct tokens, and "" for rules that have none."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lowered(subject), F.lit("[a-z0-9]+"), F.lit(0))))


def decisions(urls: DataFrame, rule_table: DataFrame) -> DataFrame:
    """``url, priority, rule, pattern, verdict`` for the URLs (column ``url``) that a rule fits.

    Each rule is filed under that of its literal tokens which the fewest URLs hold, or under "" without any. A URL's tokens
    fetch candidate rules by an equality join, and only candidates run their regular expression. Of the rules that fit,
    the one with the highest priority wins, then the longest, then the last by name. Null URLs fit none.
    """
    host, path, rest = address(F.col("url"))
    parsed = urls.filter(F.col("url").isNotNull()).select("url").distinct().select("url", F.concat(host, path, rest).alias("subject"))
    parsed = stage(parsed, "addresses")
    spread = parsed.select("url", "subject", F.explode(tokens(F.col("subject"))).alias("token"))
    made = stage(rule_table.select("*", regular(F.col("pattern"), F.col("any_case")).alias("expression"), literals(F.col("pattern")).alias("literal")), "rules")
    wanted = made.select("name", "pattern", F.explode("literal").alias("token"))
    counts = spread.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    ranked = wanted.join(counts, "token", "left").groupBy("name", "pattern").agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("rarest"))
    index = made.join(ranked, ["name", "pattern"], "left").select("name", "pattern", "verdict", "priority", "expression", F.coalesce("rarest.token", F.lit("")).alias("token"))
    index = stage(index, "index")
    fitting = spread.join(index, "token").filter(F.expr("subject rlike expression"))
    best = F.max(F.struct("priority", F.length("name").alias("length"), "name", "pattern", "verdict")).alias("best")
    chosen = fitting.groupBy("url").agg(best)
    return chosen.select("url", "best.priority", F.col("best.name").alias("rule"), "best.pattern", "best.verdict")


def judge(pages: DataFrame, rule_table: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every column of ``pages``, then ``host, path, priority, rule, verdict`` (clashing ones are replaced).

    Without a fitting rule the verdict is ``default`` and the rule null; null and malformed URLs have an empty host
    and path. Repeated rows stay.
    """
    found = stage(decisions(pages.select(F.col(url).alias("url")), rule_table), "decisions").select(F.col("url").alias("of"), "priority", "rule", "verdict")
    host, path, _ = address(F.col(url))
    joined = boxed(pages, url=F.col(url), host=host, path=path).join(found, F.col("url") == F.col("of"), "left")
    new = {"host": F.col("host"), "path": F.col("path"), "priority": F.col("priority"), "rule": F.col("rule"), "verdict": F.coalesce("verdict", F.lit(default))}
    return joined.select(*[F.col(field(c)).alias(c) for c in pages.columns if c.lower() not in new], *[c.alias(n) for n, c in new.items()])
