"""URL filters with redirect equivalence, with DataFrame functions only.

Explicit rules decide the URLs that they fit, longest rule first. Redirects and canonical links make URLs aliases of
each other: connected components over these edges pass decisions on to URLs that no rule fits, where an explicit allow
anywhere among the aliases goes before a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.components import components
from tallgrass.llm.workspace import ascii_lower, stage

#: (verdict, host, start of the path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Rules up to this number become one expression; more are joined as a table.
INLINE_RULES = 500

_CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical[\"'\s>][^>]*>"
_REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh[\"'\s][^>]*>"
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL as a node of the graph: host, path and query, without scheme and fragment; null where there is no host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url)), query))


def resolve(link: Column, base: Column) -> Column:
    """``link`` as a full URL: absolute, ``//host/...``, ``/path``, or relative to the folder of ``base``."""
    root = F.concat(F.lit("http://"), host_of(base))
    folder = F.concat(root, F.regexp_replace(F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base)), r"[^/]*$", ""))
    return (
        F.when(link == "", F.lit(None).cast("string"))
        .when(F.instr(link, "://") > 0, link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(folder, link))
    )


def apply_rules(df: DataFrame, host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` (host and path of the longest rule that fits, else null) and ``ruled`` (its verdict).

    A rule fits its host and all subdomains, where the path starts with the rule's. Of equally long rules, allow wins.
    """
    ranked = sorted(set(rules), key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r))
    if len(ranked) <= INLINE_RULES:
        found = F.lit(None).cast("struct<rule:string,verdict:string>")
        for verdict, h, p in reversed(ranked):
            fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
            found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
        return df.withColumn("__f", found).withColumns({"rule": F.col("__f.rule"), "ruled": F.col("__f.verdict")}).drop("__f")
    # Many rules: (host, path) pairs are few compared with rows; each one meets the rules of its host's suffixes.
    table = df.sparkSession.createDataFrame([(r[1], r[2], r[1] + r[2], r[0], i) for i, r in enumerate(ranked)], "rh string, rp string, rule string, ruled string, ord int")
    keys = df.select(host, path).distinct()
    labels = F.split(F.col(host), r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    hit = keys.withColumn("rh", suffix).join(table, "rh").filter(F.col(path).startswith(F.col("rp")))
    best = hit.groupBy(host, path).agg(F.min(F.struct("ord", "rule", "ruled")).alias("f")).select(host, path, "f.rule", "f.ruled")
    return df.join(best, [host, path], "left")


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a`` and ``b``: nodes joined by a canonical link or a redirect in a page's HTML."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)
    links = F.array(F.regexp_extract(F.regexp_extract(html, _CANONICAL, 0), _HREF, 1), F.regexp_extract(F.regexp_extract(html, _REFRESH, 0), _URL, 1))
    found = pages.filter(html.rlike("(?i)canonical|refresh")).select(url.alias("url"), F.explode(links).alias("link"))
    found = found.withColumn("full", resolve(F.col("link"), F.col("url")))
    # Loops and nulls go in components(): a filter here would be pushed into all these expressions.
    return found.select(node_of(F.col("url")).alias("a"), node_of(F.col("full")).alias("b"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: identifier, ``host``, ``path``, ``rule``, ``verdict`` and ``inherited``.

    ``redirects`` may add rows ``src`` and ``dst`` (URLs). A URL that a rule fits has the rule's verdict. Any other one
    is allowed, unless one of its aliases is blocked by a rule and none is allowed by one. Null or malformed URLs
    have an empty host and path, fit no rule, and are allowed. Pages with the same URL are one node; repeated rows give repeated
    rows; null identifiers and other columns do no harm.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    rows = apply_rules(rows, "host", "path", rules)
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("src")), node_of(F.col("dst"))))
    edges = stage(edges, "alias-edges").filter("a <> b")
    inherited = F.lit(None).cast("string")
    if edges.limit(1).count():
        groups = components(edges)
        # Targets that are not pages count as well: a rule may fit them.
        known = groups.withColumns({"host": F.regexp_extract("node", r"^([^/?#]*)", 1), "path": F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)})
        known = apply_rules(known, "host", "path", rules)
        verdicts = known.groupBy("component").agg(F.max(F.col("ruled") == "allow").alias("allowed"), F.max(F.col("ruled") == "block").alias("blocked"))
        passed = verdicts.filter("blocked and not coalesce(allowed, false)").select("component")
        blocked = groups.join(passed, "component", "left_semi").select("node", F.lit("block").alias("inherited"))
        rows = rows.join(blocked, "node", "left")
        inherited = F.col("inherited")
    rows = rows.withColumn("inherited", F.when(F.col("rule").isNull(), inherited))
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", "inherited", F.lit("allow")).alias("verdict"), "inherited")


#: The same result in DuckDB, aliases included.
SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM p),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
own AS (SELECT q.page_id, q.host, q.path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS ruled
  FROM q LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL),
links AS (SELECT page_id, host, path, query, unnest([
   regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical["''\s>][^>]*>', 0), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
   regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh["''\s][^>]*>', 0), '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS link FROM q WHERE host <> ''),
full_links AS (SELECT host || CASE WHEN path = '' THEN '/' ELSE path END || query AS a, CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3) WHEN starts_with(link, '//') THEN substr(link, 3)
   WHEN starts_with(link, '/') THEN host || link ELSE host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || link END AS rest FROM links WHERE link <> ''),
ends AS (SELECT a, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS bh, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS bp, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS bq FROM full_links),
edge AS (SELECT a, bh || CASE WHEN bp = '' THEN '/' ELSE bp END || bq AS b FROM ends WHERE bh <> ''),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
alias AS (SELECT r.a, v.verdict FROM (SELECT a, b FROM reach UNION SELECT a, a FROM both_ways) r JOIN LATERAL (
   SELECT arg_max(verdict, length(rh || rp)) AS verdict FROM rules WHERE (regexp_extract(r.b, '^([^/?#]*)', 1) = rh OR ends_with(regexp_extract(r.b, '^([^/?#]*)', 1), '.' || rh)) AND starts_with(regexp_extract(r.b, '^[^/?#]*([^?#]*)', 1), rp)) v ON true),
passed AS (SELECT a FROM alias GROUP BY a HAVING bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), false))
SELECT o.page_id, o.host, o.path, o.rule, CASE WHEN o.rule IS NULL AND s.a IS NOT NULL THEN 'block' ELSE NULL END AS inherited,
  coalesce(o.ruled, CASE WHEN s.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM own o JOIN q ON o.page_id = q.page_id LEFT JOIN passed s ON s.a = q.host || CASE WHEN q.path = '' THEN '/' ELSE q.path END || q.query
"""


#: The same with redirects: of the pages by id, each third page leads to the page behind it.
REDIRECTS_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM p),
rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
own AS (SELECT q.page_id, q.host, q.path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS ruled
  FROM q LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL),
links AS (SELECT page_id, host, path, query, unnest([
   regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical["''\s>][^>]*>', 0), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
   regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh["''\s][^>]*>', 0), '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS link FROM q WHERE host <> ''),
full_links AS (SELECT host || CASE WHEN path = '' THEN '/' ELSE path END || query AS a, CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3) WHEN starts_with(link, '//') THEN substr(link, 3)
   WHEN starts_with(link, '/') THEN host || link ELSE host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || link END AS rest FROM links WHERE link <> ''),
ends AS (SELECT a, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS bh, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS bp, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS bq FROM full_links),
node AS (SELECT row_number() OVER (ORDER BY page_id) AS i, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || query END AS b FROM q),
edge AS (SELECT a, bh || CASE WHEN bp = '' THEN '/' ELSE bp END || bq AS b FROM ends WHERE bh <> '' UNION ALL SELECT m.b, n.b FROM node m JOIN node n ON n.i = m.i + 1 WHERE m.i % 3 = 0 AND m.b IS NOT NULL AND n.b IS NOT NULL),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
alias AS (SELECT r.a, v.verdict FROM (SELECT a, b FROM reach UNION SELECT a, a FROM both_ways) r JOIN LATERAL (
   SELECT arg_max(verdict, length(rh || rp)) AS verdict FROM rules WHERE (regexp_extract(r.b, '^([^/?#]*)', 1) = rh OR ends_with(regexp_extract(r.b, '^([^/?#]*)', 1), '.' || rh)) AND starts_with(regexp_extract(r.b, '^[^/?#]*([^?#]*)', 1), rp)) v ON true),
passed AS (SELECT a FROM alias GROUP BY a HAVING bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), false))
SELECT o.page_id, o.host, o.path, o.rule, CASE WHEN o.rule IS NULL AND s.a IS NOT NULL THEN 'block' ELSE NULL END AS inherited,
  coalesce(o.ruled, CASE WHEN s.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM own o JOIN q ON o.page_id = q.page_id LEFT JOIN passed s ON s.a = q.host || CASE WHEN q.path = '' THEN '/' ELSE q.path END || q.query
"""
