"""The JVM path for plain pages against the page parser, on assembled and damaged pages."""

import random

from pyspark.sql import functions as F

from linkloom.functions import plain_html as H
from linkloom.operators import links as K

BASES = ["https://a.com/x/y?q", "http://h.com/", "https://H.com:80/a/b/c#f", "http://h.com", "http://h.com/a//b",
         "http://h.com/a/../b", "http://h.com/x;p", "ftp://h.com/"]
HREFS = ["/a", "/a/b?c=1&amp;d=2", "b", "b/c.html", "?k=1", "#t", "", "../up", "./x", "//n.com/z", "http://n.com",
         "https://n.com/p#f", "HTTP://n.com/", "mailto:a@b", "javascript:x()", "data:,", "/a#1", "/a;p", "a:b",
         "/sp ace", "/é", "/a&copy=1", "/a&lt;", "http://n.com//q", "/p/..", "tel:1", " /lead", "ftp://n.com/x",
         "/x/", "c/?q", "https:/odd", "http:foo"]
ATTRS = ["", " class=x", ' id="a>b"', " title='it<s'", " hreflang=en", " disabled", ' data-x="1"', " HREF=/dup",
         ' x = "y"', ' a"b', " data-q=a/b/", "\n class='c'", ' title="&eacute;"']
OTHER = ["text", "a < b", "&amp;", "<p>", "</p>", "<br/>", "<BR />", "<!-- c -->", "<!-- <a href=/no> -->", "<!-->",
         "<!---->", "<!-- a -- b -->", "<script>var x='<a href=/s>';</script>", "<script>a<b</SCRIPT>",
         "<script><!-- x --></script>", "<script>x</script >", "<script src=/a/b.js></script>", "<style>p{}</style>",
         "<style>p>a{}</style>", "<title>t &amp; u</title>", "<title>a<b>c</title>", "<textarea><a href=/t></textarea>",
         "<iframe src='/f'></iframe>", "<!DOCTYPE html>", "<!doctype html PUBLIC \"x\">", "<?php x ?>", "<![CDATA[ x ]]>",
         "</ p>", "<p", "<script>", "<a", "</a>", "<abbr>", "<svg><a href='/svg'></svg>", "\x00", "<p\x0bq>", "é ü",
         "<img src=x alt=\"a 'q' b\">", "<div class = 'x'>", "<script/>", "<noscript><a href='/ns'></noscript>",
         "<plaintext>", "</script>", "<!bogus>", "<a name=q>", "<p a=1 a=2>", "<li><ul>", "&#60;a href=/e&#62;"]


def anchor(rng):
    quote = rng.choice(['"', '"', '"', "'", ""])
    name = rng.choice(["a", "a", "a", "A"])
    href = f" {rng.choice(['href', 'href', 'HREF'])}={quote}{rng.choice(HREFS)}{quote}"
    before, after = (rng.choice(ATTRS) if rng.random() < 0.3 else "" for _ in "ab")
    return f"<{name}{before}{href}{after}{rng.choice(['', '', ' ', '/', ' /'])}>x</a>"


def documents(n, seed):
    rng = random.Random(seed)
    calm = HREFS[:4] + HREFS[10:12] + HREFS[13:17]
    for i in range(n):
        if i % 2:
            parts = [anchor(rng) if rng.random() < 0.5 else rng.choice(OTHER) for _ in range(rng.randint(1, 6))]
        else:
            pool = ["<p>", "</p>", "text", "<!-- c -->", "<title>t</title>", "<script>if(a<b){}</script>", "<br/>"]
            parts = [
                f'<a href="{rng.choice(calm)}">' if rng.random() < 0.5 else rng.choice(pool) for _ in range(8)
            ]
        text = "".join(parts)
        if i % 3 == 0:
            text = text[: rng.randint(0, len(text))]
        yield i, rng.choice(BASES[:3] if i % 2 == 0 else BASES), text


def test_plain_pages_give_the_parsers_links(spark):
    docs = list(documents(6000, 11))
    df = spark.createDataFrame(docs, "i int, url string, html string").repartition(8)
    html, base = F.col("html"), F.col("url")
    df = df.withColumn("hrefs", H.written_hrefs(html))
    df = df.withColumn("plain", H.is_plain(html, base, F.col("hrefs")))
    rows = df.filter("plain").select("i", H.plain_links(H.resolved_hrefs(base, F.col("hrefs"))).alias("links")).collect()
    assert len(rows) > 1500
    for r in rows:
        _, url, text = docs[r.i]
        assert r.links == K._fast(text, url).links, (url, text)
        assert r.links == K._robust(text, url).links, (url, text)


def test_both_ways_together_equal_the_parser(spark):
    docs = list(documents(2000, 12))
    df = spark.createDataFrame(docs, "page_id int, url string, html string")
    for mode, parse in (("fast", K._fast), ("robust", K._robust)):
        for r in K.with_links(df, mode).collect():
            assert r.links == parse(r.html, r.url).links, (mode, r.url, r.html)


def test_odd_pages_do_not_exhaust_the_matcher(spark):
    big = [
        "<p " + "x " * 100_000 + ">",
        "<" * 200_000,
        "<script>" + "<" * 200_000 + "</script>",
        "<!--" + "-" * 200_000 + "-->",
        '<a href="' + "&amp;" * 50_000 + '">',
        "<p>" * 100_000,
        '<a href="/' + "a/" * 100_000 + '">',
        "<a" + ' b="c"' * 30_000 + ' href="/x">',
    ]
    df = spark.createDataFrame([(i, "http://h.com/", h[:262000]) for i, h in enumerate(big)], "page_id int, url string, html string")
    got = {r.page_id: len(r.links) for r in K.with_links(df).collect()}
    want = {i: len(K._fast(h[:262000], "http://h.com/").links) for i, h in enumerate(big)}
    assert got == want
