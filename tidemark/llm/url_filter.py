"""URL filters by rules of host and path, with decisions carried over redirects.

A url that a rule fits has that rule's verdict. All others ask their equivalence class: urls
that one spelling, a redirect or a canonical link joins name one page. Classes are the
connected components of those links. A class with a blocked url blocks its urls that no rule
fits, unless a rule allows one of the class: an explicit allow takes precedence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.store import stored

# Spellings of one page: parameters that say where a visitor came from, first labels of a
# host and ends of a path that sites redirect away.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)"
DEFAULT_HOSTS = r"^(?:www|m)\."
DEFAULT_ENDS = r"(?:/|\.html?|/index\.html?)$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty if there is no host."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def page_key(url: Column) -> Column:
    """A digest that all spellings of a url share; null for null.

    Scheme, fragment, tracking parameters, a first label ``www`` or ``m`` and the usual ends
    of a path make no difference. A text that is no url has a key of its own.
    """
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike(rf"^(?:{TRACKING}=.*)?$"))
    place = F.concat(
        F.regexp_replace(host_of(url), DEFAULT_HOSTS, ""),
        F.regexp_replace(path_of(url), DEFAULT_ENDS, ""),
        F.lit("?"),
        F.array_join(F.array_sort(kept), "&"),
    )
    return F.md5(F.when(url.contains("://"), place).otherwise(F.concat(F.lit("#"), url)))


def _declared(html: Column) -> Column:
    """Targets of canonical links and of refresh redirects in a page, as written."""
    canonical = F.regexp_extract_all(
        html, F.lit(r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    )
    refresh = F.regexp_extract_all(
        html, F.lit(r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)")
    )
    return F.concat(canonical, refresh)


def _resolved(target: Column, url: Column) -> Column:
    """A target as an absolute url, seen from the page at ``url``; null where that has no host."""
    root = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"(?s)[^/]*$", "")
    return (
        F.when(target.contains("://"), target)
        .when(host_of(url) == "", F.lit(None))
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst)``: the urls that pages declare as their canonical or redirect target.

    Pages without a url or html declare nothing.
    """
    found = pages.select(F.col(url).alias("src"), F.explode(_declared(F.col(html))).alias("to"))
    return found.select("src", _resolved(F.col("to"), F.col("src")).alias("dst")).where(
        "src IS NOT NULL AND dst IS NOT NULL"
    )


def _rule_table(rules: DataFrame) -> DataFrame:
    """Per host its paths, longest first; of equal rules that differ in verdict allow counts."""
    cut = F.regexp_extract("pattern", r"(?s)^([^/]*)(.*)$", 1)
    parts = rules.select(
        F.translate(cut, _UPPER, _LOWER).alias("rule_host"),
        F.regexp_extract("pattern", r"(?s)^([^/]*)(.*)$", 2).alias("path"),
        F.col("verdict"),
    )
    one = parts.groupBy("rule_host", "path").agg(F.min("verdict").alias("verdict"))
    entry = F.struct((-F.length("path")).alias("order"), "path", "verdict")
    return one.groupBy("rule_host").agg(F.array_sort(F.collect_list(entry)).alias("paths"))


def _fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (a column ``url``) with host, path, rule and its verdict, both null if none fits.

    Of each host suffix that has rules only the longest path that fits counts, so a url meets
    as many rows as its host has labels, and no rule set needs to be broadcast.
    """
    placed = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    meets = placed.select("*", F.posexplode(suffixes).alias("_cut", "rule_host")).join(
        _rule_table(rules), "rule_host", "left"
    )
    hit = F.get(F.filter("paths", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    fits = F.struct(
        F.length(F.concat("rule_host", hit["path"])).alias("size"),
        F.length("rule_host").alias("host_size"),
        F.concat("rule_host", hit["path"]).alias("rule"),
        hit["verdict"].alias("verdict"),
    )
    # Equal rows are one group with their number, so no row needs a number of its own.
    return (
        meets.groupBy(*placed.columns)
        .agg(
            F.max(F.when(hit.isNotNull(), fits)).alias("_best"),
            F.sum((F.col("_cut") == 0).cast("int")).cast("int").alias("_copies"),
        )
        .select("*", F.explode(F.array_repeat(F.lit(0), F.col("_copies"))))
        .select(*placed.columns, "_best.rule", "_best.verdict")
    )


def _blocked_keys(known: DataFrame, links: DataFrame) -> DataFrame:
    """``page_key`` of the classes that a block decision reaches and no allow.

    Verdicts are summed per key, and keys per class, before each shuffle; the keys of a class
    are found again by a join whose other side has one row per class, which Spark may split.
    """
    flags = known.groupBy("page_key").agg(
        F.max((F.col("verdict") == "block").cast("int")).alias("blocked"),
        F.max((F.col("verdict") == "allow").cast("int")).alias("allowed"),
    )
    label = F.coalesce("component", "page_key").alias("label")
    keys = stored(
        flags.join(components(links).withColumnRenamed("node", "page_key"), "page_key", "left")
        .select("page_key", label, "blocked", "allowed"),
        "url-keys",
    )
    reached = (
        keys.groupBy("label")
        .agg(F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
        .where("blocked = 1 AND coalesce(allowed, 0) = 0")
        .select("label")
    )
    return keys.join(reached, "label", "left_semi").select("page_key")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame,
    links: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and decided_by.

    ``rules`` are pairs (pattern, ``allow`` or ``block``), or a table of the columns pattern
    and verdict; a pattern is a host, and from its first slash on a path. A rule fits its host
    and all its subdomains where the path begins with the rule's. The longest one that fits
    decides; of equal length the one with the longer host, of equal patterns allow. Where none
    fits, a page is blocked if its class has a blocked url and no allowed one, and is allowed
    otherwise; decided_by is ``rule``, ``alias`` or ``default``. Classes come from spellings
    (``page_key``), from what pages declare in ``html`` (None: nothing) and from ``links``,
    urls ``(src, dst)`` of redirects seen elsewhere; urls that are only linked to are judged
    by the rules too. A null url or one without ``://`` has an empty host and path, which no
    rule fits. Repeated rows stay rows of their own; an empty table gives an empty result;
    further columns, whatever their names, play no part.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "pattern string, verdict string")
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    edges = page_links(pages, url, html) if html else None
    if links is not None:
        given = links.select(F.col("src").alias("src"), F.col("dst").alias("dst"))
        edges = given if edges is None else edges.unionByName(given)
    keyed = own.withColumn("page_key", page_key(F.col("url")))
    judged = stored(_fitting(keyed, rules).drop("url"), "urls-judged")
    known = judged.select("page_key", "verdict").where("page_key IS NOT NULL")
    none = spark.createDataFrame([], "a string, b string")
    if edges is not None:
        edges = stored(edges.where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "url-links")
        ends = edges.select(F.col("src").alias("url")).unionAll(edges.select("dst")).distinct()
        ends = ends.withColumn("page_key", page_key(F.col("url")))
        known = known.unionByName(_fitting(ends, rules).select("page_key", "verdict"))
        none = edges.select(page_key(F.col("src")).alias("a"), page_key(F.col("dst")).alias("b"))
    blocked = _blocked_keys(known, none).withColumn("_aliased", F.lit(True))
    verdict = (
        F.when(F.col("verdict").isNotNull(), F.col("verdict"))
        .when(F.col("_aliased"), "block")
        .otherwise("allow")
    )
    by = F.when(F.col("rule").isNotNull(), "rule").when(F.col("_aliased"), "alias").otherwise("default")
    return judged.join(blocked, "page_key", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), by.alias("decided_by")
    )
