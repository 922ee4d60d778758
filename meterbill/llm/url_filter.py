"""URL filters with redirect equivalence; DataFrame operations only.

A rule names a host (with its subdomains) and a path prefix, and allows or blocks.  The longest rule that fits a url
is its explicit decision.  Urls that redirect to each other or name each other as canonical are aliases: the
connected components over the redirect and canonical-link edges.  A url without an explicit rule is blocked if any
alias of it is explicitly blocked, else allowed; an explicit allow always stands.

Edges come from the pages (``link rel=canonical``, ``meta http-equiv=refresh``; comments and scripts are not read) and
from an optional table of known redirects.  Two urls are the same node if they agree but for scheme, fragment
and case of the host.  References are resolved against the page's url, ``.`` and ``..`` included; ``rel`` is a list of words; a tag that holds ``<`` is not read.

Scale: up to ``EXPRESSION_RULES`` rules are part of the scan's expressions; more, or rules in a table, are met by an
equi-join of host suffixes and path prefixes (``joined_rules``).  Only urls that take part in
an edge enter the components; blocked aliases come back to the pages as an equi-join whose right side
has one row per node.

Defined cases: NULL url, or one without ``://``: host and path are empty, no rule fits, no edge, so it is allowed; NULL html has
no edges; repeated pages get equal results; of equally long rules allow wins; NULL ends of an edge are ignored; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import stored
from meterbill.llm.components import connected_components

EXPRESSION_RULES = 1000      # up to so many rules are one expression; more are joined, with the same result
ALLOW, BLOCK = "allow", "block"
Rule = tuple[str, str, str]     # host, path prefix, allow or block
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ATTRIBUTE = r"(?s)([^\s=\"'/>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def explicit_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct (size, allows, rule), NULL if none fits."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(action == ALLOW).alias("allows"), F.lit(h + p).alias("rule")))
            for h, p, action in rules]
    if not fits:
        return F.lit(None).cast("struct<size: int, allows: boolean, rule: string>")
    return F.array_max(F.array(*fits))


def joined_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, own): ``explicit_rule`` of every distinct place that a rule fits, for any number of rules.

    A place meets its rules by equality: each of its host's suffixes with each prefix of its path that is as long as
    some rule's path.  ``rules``: (host, path, action).  The lengths are as many as the longest rule's path has characters at most."""
    told = rules.select(F.col(rules.columns[0]).alias("suffix"), F.col(rules.columns[1]).alias("prefix"),
                        (F.col(rules.columns[2]) == ALLOW).alias("allows"))
    lengths = told.agg(F.collect_set(F.length("prefix")).alias("n")).scalar()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = places.select("host", "path").distinct().select("*", F.explode(lengths).alias("n")).filter(F.col("n") <= F.length("path")) \
        .select("host", "path", F.substring("path", F.lit(1), F.col("n")).alias("prefix"), F.explode(suffixes).alias("suffix"))
    own = F.struct((F.length("suffix") + F.length("prefix")).alias("size"), "allows", F.concat("suffix", "prefix").alias("rule"))
    return probes.join(told, ["suffix", "prefix"]).groupBy("host", "path").agg(F.max(own).alias("own"))


def with_rule(rows: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``rows`` (host, path, ...) with the longest fitting rule as ``own``."""
    if isinstance(rules, list) and len(rules) <= EXPRESSION_RULES:
        return rows.withColumn("own", explicit_rule(F.col("host"), F.col("path"), rules))
    if isinstance(rules, list):
        rules = rows.sparkSession.createDataFrame(rules, "host string, path string, action string")
    return rows.join(joined_rules(rows, rules), ["host", "path"], "left")


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` resolved."""
    parts = F.split(path, "/")
    up = lambda kept: F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
    kept = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, F.lit(1), F.lit(1)),
                       lambda kept, x: F.when(x == "..", up(kept)).when(x == ".", kept).otherwise(F.concat(kept, F.array(x))))
    joined = F.array_join(F.when(path.rlike(r"/\.{1,2}$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), joined).otherwise(path)


def node_of(url: Column, resolve: bool = False) -> Column:
    """What tells one url from another: host, path and query; NULL without ``://``."""
    host, path = host_and_path(url)
    query = F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))
    return F.when(url.contains("://"), F.concat(host, F.when(path == "", F.lit("/")).otherwise(without_dots(path) if resolve else path), query))


def page_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) nodes of the canonical links and refresh redirects in the pages."""
    html = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>", " ")
    tag = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta)[\s/][^<>]*>)"), 1)).alias("tag")
    tags = pages.filter(F.col("html").rlike(r"(?i)canonical|refresh")).select("url", tag) \
        .select("url", F.transform(F.regexp_extract_all("tag", F.lit(ATTRIBUTE), 1), F.lower).alias("names"),
                F.regexp_extract_all("tag", F.lit(ATTRIBUTE), 2).alias("told"))
    # the first attribute of a name counts
    value = lambda name: F.regexp_replace(F.get("told", F.array_position("names", name).cast("int") - 1), "^[\"']|[\"']$", "")
    canonical = F.when(F.array_contains(F.split(F.lower(value("rel")), r"\s+"), "canonical"), F.trim(value("href")))
    refresh = F.when(F.lower(value("http-equiv")) == "refresh",
                     F.trim(F.regexp_extract(value("content"), r"(?is)url\s*=\s*['\"]?([^'\"]+)", 1)))
    found = tags.select("url", F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&")).alias("href")).filter("href <> ''")
    host, path = host_and_path(F.col("url"))
    scheme = F.regexp_extract("url", "(?s)^(.*?)://", 1)
    href = F.col("href")
    # relative references against the page's own url
    target = F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href) \
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)) \
        .when(href.startswith("/"), F.concat(scheme, F.lit("://"), host, href)) \
        .when(href.startswith("#") | href.startswith("?"), F.concat(scheme, F.lit("://"), host, path, href)) \
        .otherwise(F.concat(scheme, F.lit("://"), host, F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", ""), href))
    return found.select(node_of(F.col("url")).alias("src"), node_of(target, True).alias("dst"))


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, alias_blocked, one row per page.

    ``rules``: a list, or a DataFrame of any size with the columns host, path, action.  ``redirects``: further edges, two columns of urls."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    edges = page_edges(plain)
    if redirects is not None:
        a, b = redirects.columns[:2]
        edges = edges.union(redirects.select(node_of(F.col(a)), node_of(F.col(b))))
    roots = connected_components(stored(edges.distinct(), "url-edges"))
    url = F.concat(F.lit("x://"), "node")
    node_host, node_path = host_and_path(url)
    placed = with_rule(roots.select("root", node_host.alias("host"), node_path.alias("path")), rules)
    blocked = placed.filter(~F.coalesce(F.col("own.allows"), F.lit(True))).select("root").distinct()
    aliases = roots.join(blocked, "root").select(F.col("node").alias("alias"))
    host, path = host_and_path(F.col("url"))
    # pages without a node get a key of their own, so that they don't meet in one task
    key = F.coalesce(node_of(F.col("url")), F.concat(F.lit("\0"), F.col("page_id").cast("string")), F.lit("\0"))
    named = with_rule(plain.select("page_id", host.alias("host"), path.alias("path"), key.alias("key")), rules)
    joined = named.join(aliases, named["key"] == aliases["alias"], "left")
    verdict = F.when(F.col("own").isNotNull(), F.when(F.col("own.allows"), ALLOW).otherwise(BLOCK)) \
        .when(F.col("alias").isNotNull(), BLOCK).otherwise(ALLOW)
    return joined.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"),
                         F.col("alias").isNotNull().alias("alias_blocked"))
