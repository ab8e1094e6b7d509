"""Link extraction, resolution and the link edge table.

Tokenising free-form HTML is the one step built-in expressions cannot do, so it is one Arrow-batched
Pandas UDF that sees only the page text and its URL; every other column stays in the JVM. All
filters on pages belong before it, because predicates do not cross a Python boundary.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import plain_html as H
from linkloom.functions import urls as U
from linkloom.functions.bodies import capped, decode_lenient, is_truncated

# Ship the page parser with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NO_PAGE = tuple(f"{name}:" for name in U.NON_PAGE_SCHEMES)


class _Anchors(HTMLParser):
    """href values of the anchors of one page; ``pick`` is 0 or -1 for first or last attribute."""

    def __init__(self, pick: int, convert_charrefs: bool):
        super().__init__(convert_charrefs=convert_charrefs)
        self.pick = pick
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            values = [value for name, value in attrs if name == "href"]
            if values and values[self.pick]:
                self.hrefs.append(values[self.pick])


def _resolved(hrefs: list[str], base: str) -> list[tuple[str, str | None]]:
    """Each href with its absolute link, fragment dropped; None if it cannot be resolved."""
    out = []
    for href in hrefs:
        try:
            out.append((href, urldefrag(urljoin(base, href)).url))
        except ValueError:
            out.append((href, None))
    return out


def _accepted(resolved: list[tuple[str, str | None]], accept) -> list[str]:
    """Distinct accepted links in page order."""
    found: dict[str, None] = {}
    for href, target in resolved:
        try:
            if target is not None and accept(href, target):
                found.setdefault(target)
        except ValueError:
            continue
    return list(found)


# What the page parser raises on markup it cannot read.
PARSE_ERRORS = (AssertionError, ValueError, IndexError, RecursionError)


def _fed(page: _Anchors, text: str, close: bool) -> bool:
    """Feeds a page; True when the parser gave up on it. The hrefs met until then are kept."""
    try:
        page.feed(text)
        if close:
            page.close()
    except PARSE_ERRORS:
        return True
    return False


@dataclass
class _Parsed:
    """What one mode makes of one page."""

    links: list[str]
    parse_error: bool
    parser_used: str
    hrefs: list[tuple[str, str | None]]


def _literal(href: str, target: str) -> bool:
    return target.startswith(("http://", "https://"))


def _navigable(href: str, target: str) -> bool:
    return not href.strip().lower().startswith(_NO_PAGE) and urlsplit(target).scheme in ("http", "https")


def _fast(text: str, base: str) -> _Parsed:
    page = _Anchors(pick=0, convert_charrefs=True)
    broken = _fed(page, text, close=False)
    hrefs = _resolved(page.hrefs, base)
    return _Parsed(_accepted(hrefs, _literal), broken, "fast", hrefs)


def _robust(text: str, base: str) -> _Parsed:
    page = _Anchors(pick=-1, convert_charrefs=False)
    broken = _fed(page, text, close=True)
    hrefs = _resolved(page.hrefs, base)
    return _Parsed(_accepted(hrefs, _navigable), broken, "robust", hrefs)


def _auto(text: str, base: str) -> _Parsed:
    found = _robust(text, base)
    return _fast(text, base) if found.parse_error else found


# Types of what a parse gives, by name.
_FOUND = {
    "links": "array<string>",
    "parse_error": "boolean",
    "parser_used": "string",
    "hrefs": "array<struct<href:string,dst:string>>",
}
_MODES = {"fast": _fast, "robust": _robust, "auto": _auto}


def _batch(mode: str, columns: list[str]):
    """The parse of ``mode`` as a Pandas UDF that returns ``columns``."""
    parse = _MODES[mode]

    def value(page: _Parsed, name: str):
        found = getattr(page, name)
        return [{"href": h, "dst": d} for h, d in found] if name == "hrefs" else found

    def run(text: pd.Series, base: pd.Series) -> pd.DataFrame:
        rows = [parse(t or "", b or "") for t, b in zip(text, base)]
        return pd.DataFrame({c: pd.Series([value(r, c) for r in rows], dtype=object) for c in columns})

    # Pandas UDFs are told apart by their hints.
    run.__annotations__ = {"text": pd.Series, "base": pd.Series, "return": pd.DataFrame}
    # Declared nondeterministic so that the optimizer keeps one copy: it would otherwise repeat the
    # parse in the filter it derives from an explode.
    return F.pandas_udf(run, ", ".join(f"{c} {_FOUND[c]}" for c in columns)).asNondeterministic()


def page_text(body: Column, cap: int | None = None) -> Column:
    """Text that is parsed: the body, or its first ``cap`` bytes, undecodable bytes left out."""
    text = body.cast("string")
    whole = F.when(F.is_valid_utf8(text), text).otherwise(decode_lenient(body))
    if cap is None:
        return whole
    return F.when(is_truncated(body, cap), decode_lenient(capped(body, cap))).otherwise(whole)


def with_links(
    pages: DataFrame,
    mode: str = "fast",
    url: str = "url",
    body: str = "html",
    cap: int | None = None,
    errors: bool = False,
    hrefs: bool = False,
) -> DataFrame:
    """Add ``links``: the distinct absolute web links of each page in first-seen order.

    ``mode`` is ``fast`` (first href attribute, literal http/https), ``robust`` (last href
    attribute, scheme test ignores case) or ``auto`` (robust, falling back to fast on a page the
    robust parser rejects; adds ``parser_used``). A page the parser gives up on keeps the links met
    until then; ``errors`` adds ``parse_error``, true for such pages. ``hrefs`` adds the same pass's
    ``hrefs``: every href of an anchor that is not empty, in page order, as ``href`` (entities decoded)
    and ``dst`` (absolute, fragment dropped, of any scheme; NULL if it cannot be resolved). Bodies are
    read whole unless ``cap`` names a number of bytes.
    """
    extra = ["parser_used"] * (mode == "auto") + ["parse_error"] * errors + ["hrefs"] * hrefs
    parse = _batch(mode, ["links", *extra])
    base = F.col(url)
    read = pages.withColumn("_text", page_text(F.col(body), cap))
    read = read.withColumn("_hrefs", H.written_hrefs(F.col("_text")))
    plain = F.coalesce(H.is_plain(F.col("_text"), base, F.col("_hrefs")), F.lit(False))
    read = read.withColumn("_plain", plain)
    # Only what the parser must read goes on to it: rows of plain pages stay small.
    rest = F.when(~F.col("_plain"), F.coalesce("_text", F.lit("")))
    read = read.withColumn("_rest", rest).drop("_text", "_plain")
    parsed = read.withColumn("_parsed", parse(F.col("_rest"), base))
    parsed = parsed.withColumn("_plain", F.col("_rest").isNull())
    easy = F.when(F.col("_plain"), H.resolved_hrefs(base, F.col("_hrefs")))
    parsed = parsed.withColumn("_easy", easy)
    known = {
        "links": H.plain_links(F.col("_easy")),
        "parser_used": F.lit("robust"),
        "parse_error": F.lit(False),
        "hrefs": F.col("_easy"),
    }
    out = [
        F.when(F.col("_plain"), known[c]).otherwise(F.col(f"_parsed.{c}")).alias(c)
        for c in ("links", *extra)
    ]
    return parsed.select(*pages.columns, *out)


def extract_links(
    pages: DataFrame,
    key: str = "page_id",
    mode: str = "fast",
    url: str = "url",
    body: str = "html",
    cap: int | None = None,
) -> DataFrame:
    """One row per link: ``key``, ``pos`` (from 0, page order) and ``dst``; ``auto`` adds its parser."""
    parsed = with_links(pages.select(key, url, body), mode, url, body, cap)
    extra = ["parser_used"] if mode == "auto" else []
    return listed(parsed, [key, *extra], "dst").withColumn("pos", F.col("pos").cast("bigint"))


def listed(parsed: DataFrame, keep: list[str | Column], name: str) -> DataFrame:
    """One row per link with its position.

    The outer form plus a filter, because the plain form derives a filter that computes the links
    again.
    """
    rows = parsed.select(*keep, F.posexplode_outer("links").alias("pos", name))
    return rows.filter(F.col("pos").isNotNull())


def page_hrefs(
    pages: DataFrame,
    key: str = "page_id",
    mode: str = "robust",
    url: str = "url",
    body: str = "html",
    cap: int | None = None,
) -> DataFrame:
    """One row per href of an anchor: ``key``, ``pos`` (page order), ``href`` as written, ``dst`` resolved.

    The hrefs of the extraction pass (``with_links``), so of any page the parser can read; of a page it
    gives up on, those met until then. Anchors in comments and scripts are none.
    """
    parsed = with_links(pages.select(key, url, body), mode, url, body, cap, hrefs=True)
    rows = parsed.select(key, F.posexplode_outer("hrefs").alias("pos", "h")).filter(F.col("pos").isNotNull())
    return rows.select(key, F.col("pos").cast("bigint").alias("pos"), "h.href", "h.dst")


def distinct_in_order(links: Column) -> Column:
    """Duplicates dropped, first-seen order kept."""
    return F.array_distinct(links)


def link_edges(
    pages: DataFrame,
    mode: str = "fast",
    url: str = "url",
    body: str = "html",
    cap: int | None = None,
    depth: str | None = None,
) -> DataFrame:
    """Edge table ``src, pos, dst`` with canonical ends; ``depth`` names a column to carry plus one.

    ``src`` is the canonical page URL, but links resolve against the URL as given. No shuffle: each
    page's edges come out of the task that read it.
    """
    keep = [depth] if depth else []
    parsed = with_links(pages.select(url, body, *keep), mode, url, body, cap)
    ends = [U.canonical_url(F.col(url)).alias("src")]
    out = listed(parsed, ends + ([(F.col(depth) + 1).alias("depth")] if depth else []), "link")
    return out.withColumn("dst", U.canonical_url(F.col("link"))).drop("link")


def page_link_counts(edges: DataFrame, src: str = "src", accepted: str = "accepted") -> DataFrame:
    """Links found and links accepted per page; ``accepted`` is a boolean column of the edges."""
    return edges.groupBy(src).agg(
        F.count("*").alias("links_found"), F.count_if(F.col(accepted)).alias("links_enqueued")
    )
