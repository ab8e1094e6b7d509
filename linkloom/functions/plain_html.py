"""Links of plainly written pages by regular expression, in the JVM.

A page is plain when every ``<`` of it opens a construct whose extent all HTML parsers agree on (so that
none is left when the constructs are taken away), and every href is of a kind whose resolution is a concatenation. On such pages the result is provably
that of the page parser; every other page goes to the parser. Loops are possessive, lazy or bounded,
so no page, however odd, makes the matcher recurse deeply.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[ \t\n\r\f]"
_NAME = r"[a-z][a-z0-9_:.\-]*+"
# No bracket in quotes: a page that has one is not plain, so no anchor hides in an attribute.
_VALUE = r"""(?:"[^"<]*+"|'[^'<]*+'|[^\s"'=<>`]++)"""
_ATTR = rf"{_WS}++(?!{_WS}){_NAME}(?:={_VALUE})?+(?=[ \t\n\r\f/>])"
# Attributes beside href, and any attributes.
_OTHER = rf"(?:(?!{_WS}++href[ \t\n\r\f=/>]){_ATTR}){{0,50}}+"
_ATTRS = rf"(?:{_ATTR}){{0,50}}+"
_END = rf"{_WS}*+/?>"

# Elements whose content parsers treat as text, or did not in older versions.
_TEXT_ONLY = "title|textarea|iframe|xmp|noembed|noframes"
_SPECIAL = rf"script|style|plaintext|{_TEXT_ONLY}|a"

_CONSTRUCTS = (
    rf"a{_OTHER}{_WS}++href=({_VALUE}){_OTHER}{_END}",
    rf"a{_OTHER}{_END}",
    rf"(?!(?:{_SPECIAL})[ \t\n\r\f/>]){_NAME}{_ATTRS}{_END}",
    rf"/{_NAME}{_WS}*+>",
    rf"script{_ATTRS}{_WS}*+>(?>.*?(?:<!--|</{_WS}|</script))(?<=script)>",
    rf"style{_ATTRS}{_WS}*+>(?>.*?(?:<!--|</{_WS}|</style))(?<=style)>",
    rf"({_TEXT_ONLY}){_ATTRS}{_WS}*+>[^<]*+</\2>",
    r"!--(?!-?>)(?>.*?--)>",
    r"!doctype[^<>]*+>",
    # A page cut off inside its last tag: no parser takes that for a link.
    r"[^<>]*+\z",
)
SCAN = "(?is)<(?:" + "|".join(_CONSTRUCTS) + ")"
# Anchors with an href, and what may hold text that looks like one.
ANCHORS = "(?is)<(?:" + "|".join(_CONSTRUCTS[:1] + _CONSTRUCTS[4:8]) + ")"

_PATH = r"/(?!/)[^\s?#;&]*+(?:\?[^\s#;&]++)?+"
_HREF = (
    rf"^(?:{_PATH}(?:#[^\s&]*+)?+"
    r"|https?://[A-Za-z0-9.\-]++(?:/[^\s?#;&]*+(?:\?[^\s#;&]++)?+)?+(?:#[^\s&]*+)?+"
    r"|[^\s?#;&/:][^\s?#;&:]*+(?:\?[^\s#;&]++)?+(?:#[^\s&]*+)?+"
    r"|#[^\s&]*+"
    r"|(?:javascript|mailto|tel|data):[^&]*+)\z"
)
# Paths whose resolution takes more than a concatenation.
_UNEVEN = r"(?:^|/)\.{1,2}(?:[/?#]|\z)|(?<!^https?:)//"
_BASE = r"^https?://[A-Za-z0-9.\-]++(?::[0-9]++)?+/[^\s?#;]*+(?:\?[^\s#;]++)?+(?:#\S*+)?+\z"
# Stands for a decoded ampersand; a page that has the character itself is not plain.
_AMP = "\x00"


def written_hrefs(text: Column) -> Column:
    """hrefs of a plain page's anchors in page order, quotes off and ``&amp;`` decoded.

    One scan that stops at anchors, comments and text-only elements; the latter two give no href.
    """
    hrefs = F.regexp_extract_all(text, F.lit(ANCHORS), 1)
    bare = F.transform(
        F.filter(hrefs, lambda h: h != ""),
        lambda h: F.when(h.rlike("^[\"']"), F.substr(h, F.lit(2), F.length(h) - 2)).otherwise(h),
    )
    return F.transform(
        F.filter(bare, lambda h: h != ""), lambda h: F.replace(h, F.lit("&amp;"), F.lit(_AMP))
    )


def _as_written(href: Column) -> Column:
    """The href with its ampersands back."""
    return F.replace(href, F.lit(_AMP), F.lit("&"))


def is_plain(text: Column, base: Column, hrefs: Column) -> Column:
    """True when the expressions here give exactly what the page parser would."""
    whole = ~F.regexp_replace(text, SCAN, "").contains("<")
    odd = F.exists(hrefs, lambda h: ~h.rlike(_HREF) | h.rlike(_UNEVEN))
    return base.rlike(_BASE) & ~base.rlike(_UNEVEN) & ~text.contains(_AMP) & whole & ~odd


def resolved_hrefs(base: Column, hrefs: Column) -> Column:
    """``href, dst`` of the hrefs of a plain page: as written, and absolute without the fragment."""
    origin = F.regexp_extract(base, r"^(https?://[^/]*)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^/]*/(?:[^?#]*/)?)", 1)
    page = F.regexp_replace(base, r"#.*\z", "")

    def absolute(h: Column) -> Column:
        whole = (
            F.when(h.startswith("/"), F.concat(origin, h))
            .when(h.startswith("#"), page)
            .when(h.rlike("^(?:https?|javascript|mailto|tel|data):"), h)
            .otherwise(F.concat(folder, h))
        )
        return F.substring_index(_as_written(whole), "#", 1)

    return F.transform(hrefs, lambda h: F.struct(_as_written(h).alias("href"), absolute(h).alias("dst")))


def plain_links(resolved: Column) -> Column:
    """Distinct absolute web links among the resolved hrefs of a plain page."""
    web = F.filter(resolved, lambda r: ~r["href"].rlike("^(?:javascript|mailto|tel|data):"))
    return F.array_distinct(F.transform(web, lambda r: r["dst"]))
