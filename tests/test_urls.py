"""URL expressions against hand-written cases and the standard library."""

from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import urls as U

CASES = [
    ("HTTPS://Shop.Garden.Test:443/a/./B/?q=%20a&r#top",
     "https://shop.garden.test/a/./B/?q=%20a&r", "shop.garden.test", "garden.test"),
    ("https://h.com:80/x", "https://h.com:80/x", "h.com", "h.com"),
    ("http://h.com:080/x", "http://h.com/x", "h.com", "h.com"),
    ("http://h.com:08080/x", "http://h.com:8080/x", "h.com", "h.com"),
    ("http://h.com:0/", "http://h.com/", "h.com", "h.com"),
    ("http://H.com:/x", "http://h.com/x", "h.com", "h.com"),
    ("http://h.com", "http://h.com/", "h.com", "h.com"),
    ("http://h.com?", "http://h.com/", "h.com", "h.com"),
    ("http://h.com?q=1", "http://h.com/?q=1", "h.com", "h.com"),
    ("http://u:p@H.com/a;b=1?x=1", "http://h.com/a?x=1", "h.com", "h.com"),
    ("http://h.com/x;p=1/y;q=2?z=1", "http://h.com/x;p=1/y?z=1", "h.com", "h.com"),
    ("http://a_b.com/x", "http://a_b.com/x", "a_b.com", "a_b.com"),
    ("http://a.b.co.uk/", "http://a.b.co.uk/", "a.b.co.uk", "co.uk"),
    ("http://10.0.0.1/", "http://10.0.0.1/", "10.0.0.1", "0.1"),
    ("http://localhost/", "http://localhost/", "localhost", "localhost"),
    ("http://h.com:99999/#f", "http://h.com:99999/", "h.com", "h.com"),
    ("example.com", "://example.com", "", ""),
    (" \thttp://h.com/a\tb", "http://h.com/ab", "h.com", "h.com"),
    ("http://h.com/x  # note", "http://h.com/x  ", "h.com", "h.com"),
    ("http://[::1]:8080/x", "http://::1:8080/x", "", ""),
    ("mailto:a@b.c", "mailto://a@b.c", "b.c", "b.c"),
]

PIECES = ["http://", "HTTPS://", "https:", "//", "h.com", "A_b.Com", "u:p@", "@", ":80", ":443", ":0",
          ":080", ":99999", ":x", "/", "a", "b/", "../", "..", ";p=1", "?", "?q=1", "#f", "#", " ",
          "\t", "é", ".PDF", "x", "&amp;", "ftp://", "mailto:x"]


def normal_form(url):
    """The expected identity of a URL, from its standard-library parts."""
    try:
        bare = urldefrag(url).url
    except ValueError:
        return url
    try:
        parts = urlparse(bare)
        port = parts.port
    except ValueError:
        return bare
    shown = "" if port in (None, 0, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    query = "?" + parts.query if parts.query else ""
    return f"{parts.scheme}://{(parts.hostname or '').lower()}{shown}{parts.path or '/'}{query}"


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_hand_written_cases(spark):
    got = column(spark, [c[0] for c in CASES], U.canonical_url)
    assert got == [c[1] for c in CASES]
    hosts = column(spark, got, U.url_domain)
    assert [h for h, c in zip(hosts, CASES) if c[2]] == [c[2] for c in CASES if c[2]]
    supers = column(spark, hosts, U.superdomain)
    assert [s for s, c in zip(supers, CASES) if c[2]] == [c[3] for c in CASES if c[2]]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=7).map("".join),
                min_size=300, max_size=300))
def test_canonical_equals_library_parts(spark, urls):
    assert column(spark, urls, U.canonical_url) == [normal_form(u) for u in urls]


def test_canonical_is_idempotent_on_web_urls(spark):
    urls = [c[0] for c in CASES if c[0].strip().lower().startswith("http") and "[" not in c[0]]
    once = column(spark, urls, U.canonical_url)
    assert column(spark, once, U.canonical_url) == once


def test_domain_of_web_urls(spark):
    urls = ["https://A.b.C:8/x", "http://u@h.com?x", "http://h.com#f", "//h.com/x", "x", "", "http://"]
    assert column(spark, urls, U.url_domain) == [urlparse(u).hostname or "" for u in urls]


@pytest.mark.parametrize("base", ["https://a.com/x/y?q", "http://h.com", "http://H.com:80/a/b/;p?x#f"])
def test_resolve_equals_urljoin(spark, base):
    hrefs = ["z", "/z", "../z", "../../../z", "./z/", "?k=1", "#t", "", "  ", "//B.com/z", "/a/./b/../c",
             "http:foo", "HTTPS://B.com/z", "mailto:a@b", "a//b", "..", ".", "/", "z?q#f", "https://c.d/e/../f",
             "/x;p=1", "a/b/../../c", "?", "//", "///x"]
    got = column(spark, hrefs, lambda h: U.resolve_url(F.lit(base), h))
    assert got == [urldefrag(urljoin(base, h)).url for h in hrefs]


def test_navigable(spark):
    hrefs = ["/a", "", "#t", "   ", "JavaScript:x", "  mailto:a", "\ttel:1", "data:x", "datax:", "http:foo"]
    want = [h != "" and not h.strip().lower().startswith(("javascript:", "mailto:", "tel:", "data:"))
            for h in hrefs]
    assert column(spark, hrefs, U.is_navigable) == want


def test_web_filters(spark):
    urls = ["http://a", "HTTP://a", "https:foo", "ftp://a", "httpx://a", "//a"]
    assert column(spark, urls, U.is_web) == [True, True, True, False, False, False]
    assert column(spark, urls, U.is_web_literal) == [True, False, False, False, False, False]


def test_extensions(spark):
    urls = ["http://h/a.JPG", "http://h/a.jpg?x=1", "http://h/a?x=.jpg", "http://h/a.html", "http://h/a.jpg/",
            "http://h.zip/", "http://h/x.tar.gz", "http://h/a.pdf ", "http://h/index.html"]
    want = [True, True, False, False, False, False, True, False, False]
    assert column(spark, urls, U.has_disallowed_extension) == want
    assert len(U.DISALLOWED_EXTENSIONS) == 40


def test_defragment(spark):
    urls = ["http://h/a#b", "http://h/a?#b", "HTTP://h/a#b", "HTTP://h/a", "http://h/a?q#"]
    assert column(spark, urls, U.defragment) == [urldefrag(u).url for u in urls]
