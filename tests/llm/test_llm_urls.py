import re

import pytest
from brute import find

from tidemark.llm import url_filter
from tidemark.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string"


def link(to):
    return f'<head><LINK rel="canonical" media=x href="{to}"></head>'


PAGES = [
    (1, "https://www.example.com/en/a", None),
    (2, "http://a.example.com/en/a?x=1", ""),
    (3, "http://B.Example.NET/es/1", "<p>no link</p>"),
    # Aliases of 3, directly, by a chain, by spelling and by a relative link; no rule fits them.
    (4, "http://alias.org/1", link("http://b.example.net/es/1#top")),
    (5, "http://other.org/2", '<meta http-equiv="refresh" content="0; url=http://alias.org/1">'),
    (6, "https://www.other.org/2.html?utm_source=feed", None),
    (7, "http://other.org/dir/x", link("../2")), (8, "http://other.org/dir/y", link("/2/")),
    # A class with a blocked and an allowed url, and one whose allowed url is only linked to.
    (9, "http://mixed.org/", link("http://x.net/fr/")), (10, "http://x.net/fr/", link("http://ok.com/a")),
    (11, "http://two.org/z", link("//ok.com/b")), (12, "http://three.org/z", link("http://y.net/es/9")),
    (13, None, link("http://x.net/fr/")), (14, "no url", None), (15, "", None), (16, "x://", None),
    (17, "http://com/", None), (18, "http://telecom/", None), (19, "http://x.com", None),
    (20, "http://x.net/en/" + "long/" * 5000, None), (21, "http://free.org/?a=1&ref=x#f", None),
    (4, "http://alias.org/1", link("http://b.example.net/es/1#top")), (None, "http://alias.org/1", None),
]


def parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def fitting(url):
    host, path = parts(url)
    fits = []
    for pattern, verdict in URL_RULES:
        rule_host, _, rest = pattern.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rest):
            fits.append((len(pattern), pattern, verdict))
    return max(fits)[1:] if fits else (None, None)


def key(url):
    if url is None or "://" not in url:
        return url and "#" + url
    host, path = parts(url)
    query = re.match(r"(?s)^[^?#]*\??([^#]*)", url)[1]
    kept = [p for p in query.split("&") if p and not re.match("(utm_[a-z]+|ref|fbclid|gclid)=", p)]
    return re.sub(r"^(www|m)\.", "", host) + re.sub(r"(/|\.html?|/index\.html?)$", "", path) + "?" + "&".join(sorted(kept))


def brute(pages, links):
    known = {u for _, u, _ in pages if u is not None} | {u for pair in links for u in pair}
    parent = {key(u): key(u) for u in known}
    for a, b in links:
        parent[find(parent, key(a))] = find(parent, key(b))
    verdicts = {}
    for u in known:
        verdicts.setdefault(find(parent, key(u)), set()).add(fitting(u)[1])
    out = []
    for i, u, _ in pages:
        rule, verdict = fitting(u)
        of = verdicts[find(parent, key(u))] if u is not None else set()
        aliased = "block" in of and "allow" not in of
        by = "rule" if rule else "alias" if aliased else "default"
        out.append((i, *parts(u), rule, verdict or ("block" if aliased else "allow"), by))
    return sorted(out, key=str)


LINKS = [
    ("http://alias.org/1", "http://b.example.net/es/1#top"), ("http://other.org/2", "http://alias.org/1"),
    ("http://other.org/dir/x", "http://other.org/dir/../2"), ("http://other.org/dir/y", "http://other.org/2/"),
    ("http://mixed.org/", "http://x.net/fr/"), ("http://x.net/fr/", "http://ok.com/a"),
    ("http://two.org/z", "http://ok.com/b"), ("http://three.org/z", "http://y.net/es/9"),
]


def found(df):
    assert df.columns == ["page_id", "host", "path", "rule", "verdict", "decided_by"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    got = found(url_filter.judge(spark.createDataFrame(PAGES, SCHEMA), URL_RULES))
    assert got == brute(PAGES, LINKS)
    by_id = {r[0]: r[3:] for r in got}
    assert by_id[5] == by_id[6] == by_id[8] == by_id[12] == (None, "block", "alias")
    assert by_id[9] == by_id[7] == (None, "allow", "default")
    assert by_id[10] == ("net/fr/", "block", "rule")


def test_links_seen_elsewhere(spark):
    """A chain of redirects through urls without a page, and one large star of aliases."""
    pages = [(i, f"http://h{i}.org/p", None) for i in range(300)] + [(300, "http://x.net/es/", None)]
    chain = [(f"http://h{i}.org/p", f"http://hop{i}.org/") for i in range(100)]
    chain += [(f"http://hop{i}.org/", f"http://h{i + 1}.org/p") for i in range(99)]
    chain += [("http://h99.org/p", "http://x.net/es/")]
    star = [(f"http://h{i}.org/p", "http://h0.org/p") for i in range(100, 200)]
    links = spark.createDataFrame([*chain, *star, (None, "http://h250.org/p")], "src string, dst string")
    got = found(url_filter.judge(spark.createDataFrame(pages, SCHEMA), URL_RULES, links))
    assert got == brute(pages, chain + star)
    assert sum(r[-1] == "alias" for r in got) == 200


def test_many_rules(spark):
    """Rules of one host that differ in path, equal patterns, and rules given as a table."""
    rules = [("a.org/x", "block"), ("a.org/x/", "allow"), ("A.org/x/y", "block"), ("org", "block"),
             ("b.org/", "block"), ("b.org/", "allow")]
    pages = [(1, "http://a.org/x1", None), (2, "http://a.org/x/1", None), (3, "http://a.org/x/y", None),
             (4, "http://c.org", None), (5, "http://b.org/", None), (6, "http://corg/", None)]
    table = spark.createDataFrame(rules, "pattern string, verdict string")
    got = url_filter.judge(spark.createDataFrame(pages, SCHEMA), table)
    verdicts = {r.page_id: r.verdict for r in got.collect()}
    assert verdicts == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow"}


@pytest.mark.parametrize("html", ["html", None])
def test_columns_and_empty_table(spark, html):
    rows = [(u, i, h, "x", "y") for i, u, h in PAGES]
    pages = spark.createDataFrame(rows, "url string, page_id long, html string, rule string, label string")
    got = found(url_filter.judge(pages, URL_RULES, html=html))
    assert got == brute(PAGES, LINKS if html else [])
    assert url_filter.judge(pages.limit(0), URL_RULES, html=html).count() == 0
