"""Link extraction on hand-written pages."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import bodies as B
from linkloom.operators import links as K
from linkloom.sources import pages as P

BASE = "https://a.com/x/y?q"
MENU = (
    "<ul><li><a class=m href='/herbs?page=3#mint'>mint</a><li><A HREF=//seeds.test/list>list</A>"
    '<li><a href="tel:+4900">call</a><li><a href="data:,x">d</a><li><a href="gopher://old.test/1">g</a></ul>'
)
# (base, html, robust, fast); None = same as robust
CASES = [
    ("http://garden.test/index", MENU,
     ["http://garden.test/herbs?page=3", "http://seeds.test/list"], None),
    (BASE, '<a href="z">', ["https://a.com/x/z"], None),
    (BASE, '<a href="?k=1">', ["https://a.com/x/y?k=1"], None),
    (BASE, '<a href="#t">', ["https://a.com/x/y?q"], None),
    (BASE, '<a href="   ">', ["https://a.com/x/y?q"], None),
    (BASE, '<a href=""><a href><a name=q>', [], None),
    (BASE, '<a href="//B.com/z">', ["https://B.com/z"], None),
    (BASE, '<a href="HTTP://B.com/z">', ["HTTP://B.com/z"], []),
    (BASE, '<a href="HTTPS://B.com/z">', ["https://B.com/z"], None),
    (BASE, '<a href="../../../z">', ["https://a.com/z"], None),
    (BASE, '<a href="http:foo">', ["http:foo"], []),
    (BASE, "<A HREF=/x HREF=/y>", ["https://a.com/y"], ["https://a.com/x"]),
    (BASE, '<!-- <a href="/c"> --><a href="/d&amp;e">', ["https://a.com/d&e"], None),
    (BASE, '<script>var x="<a href=/s>"</script><a href=/ok>', ["https://a.com/ok"], None),
    (BASE, '<a href="/p#1"><a href="/p#2"><a href="/q"><a href="/p">',
     ["https://a.com/p", "https://a.com/q"], None),
    (BASE, '<a href="/x"', [], None),
    (BASE, '<a href=" javascript:void(0)"><a href="TEL:1"><a href="data:x">', [], None),
    (BASE, '<a href="http://[bad/">x</a><a href="/fine">', ["https://a.com/fine"], None),
    (BASE, "", [], None),
]


def pages(spark):
    rows = [(i, c[0], c[1]) for i, c in enumerate(CASES)]
    return spark.createDataFrame(rows, "page_id int, url string, html string")


@pytest.mark.parametrize("mode", ["robust", "fast", "auto"])
def test_cases(spark, mode):
    got = {r.page_id: r.links for r in K.with_links(pages(spark), mode).collect()}
    for i, (_, html, robust, fast) in enumerate(CASES):
        want = fast if mode == "fast" and fast is not None else robust
        assert got[i] == want, html


def test_auto_names_its_parser(spark):
    assert {r.parser_used for r in K.with_links(pages(spark), "auto").collect()} == {"robust"}


def test_auto_falls_back(monkeypatch):
    monkeypatch.setattr(K, "_robust", lambda text, base: K._Parsed([], True, "robust", []))
    found = K._auto('<a href="/x">', BASE)
    assert (found.links, found.parse_error, found.parser_used) == (["https://a.com/x"], False, "fast")


HREFS = [
    # html, hrefs as written, their links; plain pages first
    ('<a href="/a#f">x</a><a href="mailto:m@a#b"><a href=b?c=1&amp;d=2>', ["/a#f", "mailto:m@a#b", "b?c=1&d=2"],
     ["https://a.com/a", "mailto:m@a", "https://a.com/x/b?c=1&d=2"]),
    ('<a href="#top">x</a><a href="">e</a><a>n</a><a href="http://b.com">', ["#top", "http://b.com"],
     ["https://a.com/x/y?q", "http://b.com"]),
    ('<a href = "/a">x</a><A @click="go()" HREF=\'../b\'>y</A>', ["/a", "../b"], ["https://a.com/a", "https://a.com/b"]),
    ('<a href="/one" href="/two">x</a><a href="/a?b&#61;1">', ["/two", "/a?b=1"], ["https://a.com/two", "https://a.com/a?b=1"]),
    ('<!-- <a href="/no"> --><a href=" http://[bad/x">x</a><a  href="/a"' + " b=c" * 60 + ">", [" http://[bad/x", "/a"],
     [None, "https://a.com/a"]),
    ('<a href="/a">x</a><![odd[ <a href="/lost">', ["/a"], ["https://a.com/a"]),
    ('<a href="/a">x</a><a href = "/cut', ["/a"], ["https://a.com/a"]),
    ("", [], []),
    (None, [], []),
]


def test_hrefs_of_the_parse(spark):
    df = spark.createDataFrame([(i, BASE, h[0]) for i, h in enumerate(HREFS)], "page_id int, url string, html string")
    rows = K.page_hrefs(df).orderBy("page_id", "pos").collect()
    for i, (html, hrefs, links) in enumerate(HREFS):
        assert [(r.pos, r.href, r.dst) for r in rows if r.page_id == i] == [
            (k, h, x) for k, (h, x) in enumerate(zip(hrefs, links))
        ], html
    # Both parsers read plain pages alike; they differ where a page gives an anchor two hrefs.
    fast = {(r.page_id, r.pos): r.href for r in K.page_hrefs(df, mode="fast").collect()}
    assert fast[(3, 0)] == "/one" and fast[(0, 2)] == "b?c=1&d=2"
    both = K.with_links(df, "robust", hrefs=True).collect()
    alone = {r.page_id: r.links for r in K.with_links(df, "robust").collect()}
    assert all(r.links == alone[r.page_id] for r in both)


def test_damaged_pages_reach_the_parser(spark, small):
    from linkloom.functions import plain_html as H
    from linkloom.workload import derive as D

    df = D.damaged_pages(spark, small)
    plain = H.is_plain(F.col("html"), F.col("url"), H.written_hrefs(F.col("html")))
    kinds = {r.k: r.plain for r in df.groupBy((F.col("page_id") % 8).alias("k")).agg(F.bool_and(plain).alias("plain")).collect()}
    assert sum(not p for p in kinds.values()) >= 4
    used = {r.parser_used for r in K.with_links(df, "auto").select("parser_used").collect()}
    assert used == {"robust", "fast"}


def test_links_before_broken_markup_are_kept(spark):
    html = '<a href="/1">x</a><![foo bar]><a href="/2">y</a>'
    df = spark.createDataFrame([(0, BASE, html), (1, BASE, "<a href=/3>")], "page_id int, url string, html string")
    for mode in ("fast", "robust", "auto"):
        got = {r.page_id: r for r in K.with_links(df, mode, errors=True).collect()}
        assert got[0].links[0] == "https://a.com/1" and got[0].parse_error == (len(got[0].links) == 1)
        assert got[1].links == ["https://a.com/3"] and not got[1].parse_error


def test_links_beyond_any_cap_are_found(spark):
    html = "<p>" + "x" * 400_000 + '<a href="/far">'
    df = spark.createDataFrame([(0, BASE, html), (1, BASE, html + "<a href='../up'>")], "page_id int, url string, html string")
    for mode in ("fast", "robust"):
        assert [r.dst for r in K.extract_links(df, mode=mode).filter("pos = 0").collect()] == ["https://a.com/far"] * 2
        assert K.extract_links(df, mode=mode, cap=1000).count() == 0


def test_positions_follow_the_page(spark):
    rows = K.extract_links(pages(spark).filter("page_id = 14")).orderBy("pos").collect()
    assert [(r.pos, r.dst) for r in rows] == [(0, "https://a.com/p"), (1, "https://a.com/q")]


def test_page_is_parsed_once(spark):
    plan = K.extract_links(pages(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_binary_body_and_cap(spark):
    body = b'\xff<a href="/a">\xc3<a href="/b">' + b" " * 50 + b'<a href="/late">'
    df = spark.createDataFrame([(1, BASE, bytearray(body))], "page_id int, url string, html binary")
    whole = K.with_links(df).first().links
    assert whole == ["https://a.com/a", "https://a.com/b", "https://a.com/late"]
    assert K.with_links(df, cap=40).first().links == whole[:2]


def test_truncation_flag_includes_the_exact_cap(spark):
    df = spark.createDataFrame([("abcd",), ("abc",), ("abcde",)], "html string")
    got = [r[0] for r in df.select(B.is_truncated(F.col("html"), 4)).collect()]
    assert got == [True, False, True]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.lists(st.sampled_from([0xFF, 0xC3, 0x28, 0x61, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xEF,
                              0xBF, 0xBD, 0xEE, 0x30, 0x31, 0xED, 0xA0]), max_size=12).map(bytes),
    min_size=200, max_size=200))
def test_lenient_decoding_equals_python(spark, bodies):
    rows = [(i, bytearray(b)) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "i int, b binary")
    got = df.select("i", B.decode_lenient(F.col("b")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [b.decode("utf-8", "ignore") for b in bodies]


def test_lookup_of_copies_and_missing(spark):
    pages_df = spark.createDataFrame(
        [(2, "u", "long body"), (1, "u", "abc")], "page_id int, url string, html string"
    )
    cands = spark.createDataFrame([("u",), ("v",)], "url string")
    got = {r.url: (r.status, r.bytes, r.ct) for r in P.lookup(cands, P.snapshot(pages_df)).collect()}
    assert got == {"u": (200, 3, "text/html"), "v": (0, 0, "")}


def test_edges_and_counts(spark):
    edges = K.link_edges(pages(spark).filter("page_id IN (0, 14)"))
    marked = edges.withColumn("accepted", ~F.col("dst").contains("list"))
    got = {r.src: (r.links_found, r.links_enqueued) for r in K.page_link_counts(marked).collect()}
    assert got == {"http://garden.test/index": (2, 1), "https://a.com/x/y?q": (2, 2)}
