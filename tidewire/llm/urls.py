"""URL filters: pattern rules found by their rarest literal token, so that few regular expressions run."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = r"(?:/|\z)"  # a label or segment ends here
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A regular expression over host and path, with the literal tokens that every match holds.

    ``label`` is what the result names; a rule without one only gives the verdict. Tokens are whole host labels
    (``h:example``) or whole path segments (``p:login``). Of the rules that match, labelled ones go first, then the
    longest ``weight``.
    """

    label: str | None
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host and its subdomains and the paths that start with ``path``."""
    labels = [f"h:{label}" for label in host.split(".") if label]
    # The last segment may go on in the url, so it is no whole token.
    segments = [f"p:{segment}" for segment in path.split("/")[:-1] if segment]
    pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{re.escape(path) if path else WHOLE}"
    return Rule(host + path, verdict, pattern, (*labels, *segments), len(host + path))


def segment_rule(verdict: str, segment: str) -> Rule:
    """A rule without a label for urls with that path segment."""
    return Rule(None, verdict, rf"(?s)/{re.escape(segment)}{WHOLE}", (f"p:{segment}",), len(segment))


# Fixed values of the contract.
SITE_RULES = (
    site_rule("allow", "org", "/"),
    site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)
#: The method's own verdict where no site rule fits: pages that are forms or scripts, not text.
OWN_RULES = tuple(segment_rule("block", s) for s in ("login", "signup", "cart", "checkout", "cgi-bin", "wp-login.php"))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to the path, query or fragment, ASCII letters in lower case."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to the query or fragment."""
    at = F.instr(url, "://")
    path = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)
    return F.when(at > 0, path).otherwise("")


def tokens_of(host: Column, path: Column) -> Column:
    """The distinct host labels and path segments, told apart by a prefix."""
    labels = F.transform(F.split(host, r"\.", -1), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/", -1), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def _rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules as literals, so that no Python worker has to bring them."""
    schema = "rule_id int, label string, verdict string, pattern string, tokens array<string>, weight int"
    rows = [
        F.struct(
            F.lit(i).alias("rule_id"),
            F.lit(r.label).cast("string").alias("label"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.pattern).alias("pattern"),
            F.array(*map(F.lit, r.tokens)).cast("array<string>").alias("tokens"),
            F.lit(r.weight).alias("weight"),
        )
        for i, r in enumerate(rules)
    ]
    held = F.array(*rows).cast(f"array<{T.StructType.fromDDL(schema).simpleString()}>")
    return spark.range(1).select(F.inline(held))


def rule_index(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the one of its tokens that the fewest urls hold; of equal ones the first by name."""
    of_rules = rules.select("rule_id", F.explode("tokens").alias("token"))
    held = tokens.join(of_rules.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    ranked = of_rules.join(held, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), F.col("token").alias("token")))["token"].alias("token")
    )
    return rules.drop("tokens").join(ranked, "rule_id")


def filter_urls(
    pages: DataFrame,
    site_rules: tuple[Rule, ...] = SITE_RULES,
    own_rules: tuple[Rule, ...] = OWN_RULES,
    default: str = "allow",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    Every distinct url is judged once. A url that no rule fits, also a NULL one or one without host and path, gets
    ``default`` and no rule. ``page_id`` is passed on, NULL as well; repeated rows stay.
    """
    spark = pages.sparkSession
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"))
    parsed = rows.select(
        "page_id", "url",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
    )
    with_address = parsed.where("host != '' OR path != ''")
    # Distinct addresses meet once per map task, so one that a third of the rows hold is cut down before the shuffle.
    addresses = with_address.select("host", "path").distinct()
    tokens = addresses.select("host", "path", F.explode(tokens_of(F.col("host"), F.col("path"))).alias("token"))
    index = rule_index(tokens, _rule_table(spark, tuple(site_rules) + tuple(own_rules)))
    fits = tokens.join(index, "token").where(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
    best = F.max(F.struct(F.col("label").isNotNull(), "weight", F.col("label").alias("label"), F.col("verdict").alias("verdict")))
    judged = fits.groupBy("host", "path").agg(best.alias("best"))
    # Rows without host and path have no rule; they need no join, so they cannot crowd one of its tasks.
    found = with_address.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.label").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
    rest = parsed.where("host = '' AND path = ''").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
    )
    return found.unionByName(rest)


URLS_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), parsed AS (
  SELECT page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(path, '') AS path FROM part
), rules(rule_host, rule_path, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
)
SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  coalesce(max_by(says, length(rule_host || rule_path)),
    CASE WHEN regexp_matches(path, '/(login|signup|cart|checkout|cgi-bin|wp-login\\.php)(/|$)') THEN 'block'
      ELSE 'allow' END) AS verdict
FROM (SELECT *, row_number() OVER () AS row FROM parsed) LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY row, page_id, host, path
"""
