"""Targets of canonical links and refreshes as pages write them."""

from __future__ import annotations

from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from merchant_ledger.llm import url_filters

PAGE = "http://Alias.org/a/b/c.html?x=1#f"
TARGETS = [
    "next.html", "./next.html", "../x", "../../../x/./y/..", "?id=2", "/r?u=http://a.net/fr/1", "//b.org/x", "d/e/", "..", ".",
    "http://c.org/b?q=../z", "/x/../y", "#top", "HTTPS://D.org",
]


def named(url):
    parts = urlsplit(url)
    return parts.netloc.lower() + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def test_targets_resolve_as_urljoin_does(spark):
    link = '<link href="{}" rel=canonical>'
    refreshes = ['<meta content="0; url={}" http-equiv="refresh">', '<META HTTP-EQUIV=refresh CONTENT="5;URL={}">']
    for page in (PAGE, "http://alias.org"):
        for form in (link, *refreshes):
            pages = spark.createDataFrame([(i, page, form.format(t)) for i, t in enumerate(TARGETS)], "page_id long, url string, html string")
            found = sorted(r["v"] for r in url_filters.alias_edges(pages).collect())
            assert found == sorted(named(urljoin(page, t)) for t in TARGETS)


def test_other_places_do_not_count(spark):
    html = "".join(f'<link rel="canonical" href="{t}">' for t in ("mailto:a@b.org", "javascript:void(0)", "data:,x", ""))
    html += '<meta name="refresh" content="0; url=/x"><link rel="next" href="y">'
    pages = spark.createDataFrame([(1, PAGE, html), (2, "no url", '<link rel="canonical" href="x">')], "page_id long, url string, html string")
    assert url_filters.alias_edges(pages).count() == 0


def test_aliases_of_blocked_pages(spark):
    pages = spark.createDataFrame([
        (1, "http://alias.org/p/1", '<meta content="0; url=2.html" http-equiv="refresh">'),
        (2, "http://alias.org/p/2.html", '<link rel="canonical" href="http://a.net/fr/9">'),
        (3, "http://alias.org/q/3?z", '<link rel="canonical" href="../p/1">'),
        (4, "http://alias.org/q/4", '<base href="../p/"><link rel="canonical" href="1">'),
        (5, "http://alias.org/q/5", '<link rel="canonical" href="1">'),
    ], "page_id long, url string, html string")
    verdicts = url_filters.judge(pages).select("page_id", "verdict", F.lit(1)).collect()
    assert {r["page_id"]: r["verdict"] for r in verdicts} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def test_references_comments_and_scripts(spark):
    html = [
        '<link rel="canonical" href="http://a.net/x?a=1&amp;b=2&copy=3">', "<link href='http://a.net/&#x66;&#114;/' rel='canonical'>",
        '<meta http-equiv="refresh" content="0; url=/p;v=1?x=2;y">', """<meta http-equiv=refresh content="3;URL='/q;r'">""",
        '<!-- <link rel="canonical" href="http://a.net/c"> -->', '<script>x = \'<link rel="canonical" href="http://a.net/s">\'</script>',
        '<!-- <link rel="canonical" href="http://a.net/open">', '<link data-href="/no" rel="alternate canonical" href=" /yes ">',
        '<link rel="canonically" href="/no">', '<meta http-equiv="refresh" content="30">',
    ]
    pages = spark.createDataFrame([(i, f"http://b.org/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    found = {(r["u"].rpartition("/")[2], r["v"]) for r in url_filters.alias_edges(pages).collect()}
    assert found == {
        ("0", "a.net/x?a=1&b=2&copy=3"), ("1", "a.net/fr/"), ("2", "b.org/p;v=1?x=2;y"), ("3", "b.org/q;r"), ("7", "b.org/yes"),
    }
