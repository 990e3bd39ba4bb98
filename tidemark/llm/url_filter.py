"""URL filter with redirect equivalence, with DataFrame operations only.

Rules name a host and the beginning of a path; a rule fits its host and all subdomains, and
of those that fit the longest decides. Addresses that lead to the same page are aliases:
an address without scheme, ``www.``, fragment and tracking parameters is one node, and
canonical links and refresh redirects found in the pages are edges between nodes. A block
rule that decides any page of a connected component, also one that only a link names, blocks
every page of it that no rule decides; an explicit allow rule on a page always outweighs what its component says. Pages
that neither a rule nor a blocked component reaches are allowed.

Rules are a policy, given as a list and held in the plan. Null urls and urls without
``://`` have an empty host and path, no rule and no aliases. Repeated rows are judged
alike. Null html has no links. Every refresh and canonical tag of a page counts. Relative
links are resolved against the page's own url, without regard to a ``base`` tag. The SQL
twin reads one absolute or rooted link per page and applies rules to rows only; it tells the
same for pages without other links. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored, table
from tidemark.llm.components import components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
CANONICAL = (r"""(?i)<link\b[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>""")
REFRESH = (r"""(?i)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""")
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
TARGET = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The address all aliases by spelling share; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(query, r"([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, "&&+", "&"), r"\?&+", "?")
    query = F.regexp_replace(query, "[?&]+$", "")
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.when(F.locate("://", url) > 0, F.concat(host, path, query))


def resolved(url: Column, link: Column) -> Column:
    """The address that a link on the page ``url`` means; null for schemes without ``//``."""
    scheme = F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit(":"))
    path = F.regexp_extract(link, r"(?s)^[^?#]*", 0)
    rest = link.substr(F.length(path) + 1, F.length(link))
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(url), r"(?s)^/(.*/)", 1))
    parts = F.split(F.when(link.startswith("/"), path).otherwise(F.concat(folder, path)), "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done)
        .when(x == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
        .otherwise(F.concat(done, F.array(x))))
    kept = F.when(F.element_at(parts, -1).isin(".", ".."),
                  F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    page = F.concat(scheme, F.lit("//"), host_of(url))
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (F.locate("://", url) == 0),
                  F.lit(None))
            .when(link.startswith("//"), F.concat(scheme, link))
            .when(link.startswith("#"), url)
            .when(link.startswith("?"), F.concat(page, path_of(url), link))
            .otherwise(F.concat(page, F.array_join(kept, "/"), rest)))


def links_of(url: Column, html: Column) -> Column:
    """Where a page says it is really found: all its refresh and canonical links."""
    def named(tag: str, value: str) -> Column:
        return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)),
                           lambda x: F.regexp_extract(x, value, 1))

    found = F.filter(F.concat(named(REFRESH, TARGET), named(CANONICAL, HREF)), lambda x: x != "")
    return F.array_distinct(F.transform(found, lambda x: resolved(url, x)))


def decided(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_of) for every page; alias_of is the
    smallest address of its component, null without ``://``."""
    url = F.col("url")
    rows = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"),
        node_of(url).alias("node"), links_of(url, F.col("html")).alias("goals"))
    name, verdict = decided(F.col("host"), F.col("path"), rules)
    rows = stored(rows.withColumns({"rule": name, "ruled": verdict}), "pages")
    goal = F.col("goal")
    links = rows.filter(F.col("node").isNotNull()).select(
        "node", F.explode("goals").alias("goal"))
    ends = links.select(node_of(goal).alias("node"),
                        decided(host_of(goal), path_of(goal), rules)[1].alias("ruled"))
    roots = components(links.select("node", node_of(goal).alias("to")), "node", "to")
    # rules hold for the pages that links lead to, whether they are rows or not
    nodes = (rows.select("node", "ruled").union(ends).filter(F.col("node").isNotNull())
             .groupBy("node")
             .agg(F.max(F.coalesce(F.col("ruled") == "block", F.lit(False))).alias("blocked"))
             .join(roots, "node", "left")
             .withColumn("alias_of", F.coalesce("root", "node")))
    blocked = (nodes.groupBy("alias_of").agg(F.max("blocked").alias("group_blocked"))
               .filter("group_blocked"))
    aliases = nodes.select("node", "alias_of").join(blocked, "alias_of", "left")
    return (rows.join(aliases, "node", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("group_blocked"), "block"),
                               F.lit("allow")).alias("verdict"), "alias_of"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every url."""
    return judge(table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH RECURSIVE cut AS (
  SELECT page_id, url, html,
         coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS rest,
         coalesce(regexp_extract(url, '(?s)^(.*?)://', 1), '') AS scheme FROM pages),
linked AS (
  SELECT *, coalesce(
      nullif(regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*?\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                            '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1), ''),
      nullif(regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*?\brel\s*=\s*["'']?canonical\b[^>]*>'),
                            '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1), '')) AS found,
      translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
goal AS (
  SELECT *, CASE WHEN contains(found, '://') THEN found
                 WHEN starts_with(found, '//') THEN scheme || ':' || found
                 WHEN starts_with(found, '/') THEN scheme || '://' || host || found END AS target
  FROM linked),
named AS (
  SELECT *, CASE WHEN contains(url, '://') THEN rest END AS a,
         CASE WHEN contains(target, '://')
              THEN regexp_extract(target, '(?s)^.*?://(.*)$', 1) END AS b FROM goal),
spelled AS (
  SELECT u, regexp_replace(translate(regexp_extract(u, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '^www\.', '')
       || coalesce(nullif(regexp_extract(u, '^[^/?#]*([^?#]*)', 1), ''), '/')
       || regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_extract(u, '^[^?#]*(\?[^#]*)', 1),
            '([?&])(utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&+', '?', 'g'),
            '[?&]+$', '') AS node
  FROM (SELECT a AS u FROM named UNION SELECT b FROM named) WHERE u IS NOT NULL),
ruled AS (
  SELECT n.*, x.node AS node, y.node AS goal_node, CASE
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM named n LEFT JOIN spelled x ON n.a = x.u LEFT JOIN spelled y ON n.b = y.u),
links AS (
  SELECT node AS p, goal_node AS q FROM ruled WHERE goal_node IS NOT NULL AND node IS NOT NULL
  UNION SELECT goal_node, node FROM ruled WHERE goal_node IS NOT NULL AND node IS NOT NULL),
reach AS (
  SELECT DISTINCT node AS p, node AS q FROM ruled WHERE node IS NOT NULL
  UNION SELECT r.p, l.q FROM reach r JOIN links l ON r.q = l.p),
grouped AS (
  SELECT r.p, min(r.q) AS alias_of,
         bool_or(coalesce(x.rule IN ('example.org/es/', 'example.org/en/1', 'com/de/'), FALSE)) AS blocked
  FROM reach r LEFT JOIN ruled x ON x.node = r.q GROUP BY 1)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN g.blocked THEN 'block' ELSE 'allow' END AS verdict, g.alias_of
FROM ruled LEFT JOIN grouped g ON ruled.node = g.p
"""
