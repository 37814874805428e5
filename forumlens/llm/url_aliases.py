"""URL filters with redirect equivalence.

Pages that redirect to each other or name one canonical address are aliases. Rules judge a
page by host and path, the longest that fits first. A page that no rule fits takes the
decision of its aliases: allowed if a rule allows one of them, else blocked if a rule
blocks one, else allowed. Aliases are the connected components of a graph of addresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from forumlens.llm.components import components
from forumlens.session import materialise, small_side

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# patterns that Java and RE2 read alike, so that the SQL has them too
LINK, META = r"(?i)<link\s[^>]*>", r"(?i)<meta\s[^>]*>"
REL = r"""(?i)\srel\s*=\s*(?:"\s*|"[^"]*\s|'\s*|'[^']*\s|)canonical(?:["'\s/>])"""
REFRESH = r"""(?i)\shttp-equiv\s*=\s*["']?\s*refresh(?:["'\s/>])"""
HREF = r"""(?i)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
TARGET = r"""(?i)url\s*=\s*["']?([^"'\s>]+)"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
SITE = r"(?s)^(.*?://[^/?#]*)"
AROUND = "\"' \t\r\n\f"  # taken off both ends of an attribute's value


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    found = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What names a page: host, path and query, without scheme and fragment. Null: no ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), path(url), query))


def _undotted(target: Column) -> Column:
    """A target that begins with ``/``, with the path's ``.`` and ``..`` worked out."""
    found = F.regexp_extract(target, r"^([^?#]*)", 1)
    parts = F.split(F.substring(F.regexp_replace(found, r"/(\.\.?)$", "/$1/"), F.lit(2), F.length(found) + 2), "/")

    def step(done: Column, part: Column) -> Column:
        up = F.when(part == "..", F.regexp_replace(done, "/[^/]*$", ""))
        return up.when(part == ".", done).otherwise(F.concat(done, F.lit("/"), part))

    rest = F.substring(target, F.length(found) + 1, F.length(target))
    return F.concat(F.aggregate(parts, F.lit(""), step), rest)


def resolved(target: Column, url: Column) -> Column:
    """The whole url that ``target`` means on the page ``url``.

    Without a scheme a target is meant from the host (``//host/a``), the site (``/a``), the page
    (``?q``) or its folder (``a``, ``../a``). Null: an empty target, a mere fragment, or a scheme
    without ``://`` (such as ``mailto:``).
    """
    site = F.regexp_extract(url, SITE, 1)
    folder = F.regexp_extract(path(url), "(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(target.rlike(SCHEME + "//"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.rlike(SCHEME) | target.startswith("#") | (target == ""), F.lit(None))
        .when(target.startswith("?"), F.concat(site, path(url), target))
        .when(target.startswith("/"), F.concat(site, _undotted(target)))
        .otherwise(F.concat(site, _undotted(F.concat(folder, target))))
    )


def declared_links(pages: DataFrame) -> DataFrame:
    """``a, b``: from each page's address to all its canonical and refresh addresses.

    All of the html's link and meta elements count, with ``canonical`` anywhere in ``rel``; what
    they name is resolved against the page's url (a ``base`` element is not used).
    """

    def elements(tag: str, kind: str, value: str) -> Column:
        some = F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda e: e.rlike(kind))
        return F.transform(some, lambda e: F.replace(F.btrim(F.regexp_extract(e, value, 1), F.lit(AROUND)), F.lit("&amp;"), F.lit("&")))

    has = F.col("html").rlike(r"(?i)canonical|refresh")  # most pages have neither
    found = F.concat(elements(LINK, REL, HREF), elements(META, REFRESH, TARGET))
    ends = pages.filter(has).select("url", F.explode(found).alias("to"))
    links = ends.select(address(F.col("url")).alias("a"), address(resolved(F.col("to"), F.col("url"))).alias("b"))
    return links.filter("a IS NOT NULL AND b IS NOT NULL")


def matched(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` for each distinct host and path that a rule fits.

    Every host suffix is joined with every prefix of the path that is as long as some rule's,
    so that a page meets a rule by equality and no rule's pages meet each other.
    """
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    suffixes = F.transform(
        F.sequence(F.lit(0), F.size(F.split("host", r"\.")) - 1),
        lambda k: F.array_join(F.slice(F.split("host", r"\."), k + 1, F.lit(1 << 30)), "."),
    )
    tries = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    candidates = sites.withColumn("suffix", F.explode(suffixes)).withColumn("length", F.explode(tries))
    candidates = candidates.withColumn("prefix", F.substring("path", F.lit(1), F.col("length")))
    named = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.concat("host", "path").alias("rule"), "verdict"
    )
    fits = candidates.join(small_side(named), ["suffix", "prefix"])
    longest = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("suffix")))
    best = fits.groupBy("host", "path").agg(longest.alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias_of`` of every page.

    ``rules`` has ``host, path, verdict`` (allow or block), one row for each host and path;
    ``links`` has redirects as ``a, b``, addresses as ``address`` makes them, beside the links that
    the pages declare. Equal rules that differ in verdict count as allow. ``alias_of`` is the least
    address of the component, null without a link. A null url or one without ``://`` has empty host
    and path, and no alias. Repeated rows are judged each. An empty table gives no row.
    """
    rules = materialise(
        rules.filter("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.min("verdict").alias("verdict")),
        "rules",
    )
    named = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), address(F.col("url")).alias("address"))
    named = materialise(named, "pages")
    found = matched(named.select("host", "path").distinct(), rules)
    verdicts = materialise(named.join(found, ["host", "path"], "left"), "verdicts")
    edges = declared_links(pages.select("url", "html"))
    if links is not None:
        edges = edges.union(links.select("a", "b"))
    roots = components(edges).select(F.col("node").alias("address"), F.col("root").alias("alias_of"))
    roots = materialise(roots, "aliases")
    decided = verdicts.filter("verdict IS NOT NULL").groupBy("address").agg(F.min("verdict").alias("verdict"))
    # allow comes before block; an address that no page has can have a rule too
    outside = roots.join(verdicts.select("address").distinct(), "address", "left_anti")
    split = outside.select("address", F.regexp_extract("address", r"^([^/?#]*)", 1).alias("host"), F.regexp_extract("address", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    ruled = split.join(matched(split.select("host", "path").distinct(), rules), ["host", "path"]).select("address", "verdict")
    groups = roots.join(decided.union(ruled), "address").groupBy("alias_of").agg(F.min("verdict").alias("by_alias"))
    known = roots.join(groups, "alias_of", "left")
    return verdicts.join(known, "address", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "by_alias", F.lit("allow")).alias("verdict"), "alias_of"
    )
