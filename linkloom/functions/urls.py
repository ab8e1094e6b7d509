"""URL parts, normalisation and URL predicates as Column expressions (JVM side only).

Splitting follows the rules of Python's ``urllib.parse``: leading blanks and control characters and
any tab, CR or LF are ignored, a scheme needs a leading letter, the authority ends at ``/ ? #``.
``parse_url`` is not used because it yields NULL for underscores in hosts and blanks in paths.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions that are never crawled.
DISALLOWED_EXTENSIONS = (
    "jpg", "jpeg", "png", "gif", "bmp", "svg", "webp", "ico",
    "pdf", "ps", "eps",
    "mp3", "wav", "ogg", "flac",
    "mp4", "mkv", "avi", "mov", "wmv", "webm",
    "css", "js", "mjs", "ts",
    "zip", "tar", "gz", "tgz", "rar", "7z",
    "apk", "dmg", "exe", "bin", "iso",
    "rss", "json", "txt", "csv",
)

# Link schemes that lead to no page.
NON_PAGE_SCHEMES = ("javascript", "mailto", "tel", "data")

# Schemes whose last path segment may carry ;params (urllib's table).
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "imap", "itms-services",
    "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_HEAD = rf"^(?:{_SCHEME}:)?"
# A URL that is canonical already: nothing below would change it.
_CANONICAL = r"^https?://[a-z0-9._\-]+/[^?#;\t\r\n]*(?:\?[^#\t\r\n]+)?\z"


# Last "@" ends the user info; brackets hold an IPv6 host.
_HOST = rf"{_HEAD}//(?:[^/?#]*@)?(?:[^/?#\[]*\[)?((?<=\[)[^\]/?#]*|[^/?#:\[\]]*)"
_PORT = rf"{_HEAD}//(?:[^/?#]*@)?(?:[^/?#\[]*\[[^\]/?#]*\][^/?#:]*|[^/?#:\[\]]*)(?::([^/?#]*))?"


def clean(url: Column) -> Column:
    """Drop what URL parsers ignore: leading blanks/controls, and tab, CR, LF anywhere."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, rf"^({_SCHEME}):", 1))


def authority_of(url: Column) -> Column:
    return F.regexp_extract(url, rf"{_HEAD}//([^/?#]*)", 1)


def raw_path_of(url: Column) -> Column:
    """Path with its ;params."""
    return F.regexp_extract(url, rf"{_HEAD}(?://[^/?#]*)?([^?#]*)", 1)


def path_of(url: Column) -> Column:
    """Path without the ;params of the last segment."""
    path = raw_path_of(url)
    strip = url.contains(";") & scheme_of(url).isin(*PARAM_SCHEMES)
    return F.when(strip, F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def url_parts(url: Column) -> Column:
    """Struct of scheme, host, port, path and query."""
    u = clean(url)
    port = F.regexp_extract(u, _PORT, 1)
    number = F.when(port.rlike(r"^[0-9]+\z"), port.try_cast("int"))
    return F.struct(
        scheme_of(u).alias("scheme"),
        F.lower(F.regexp_extract(u, _HOST, 1)).alias("host"),
        F.when(number <= 65535, number).alias("port"),
        path_of(u).alias("path"),
        query_of(u).alias("query"),
    )


def defragment(url: Column) -> Column:
    """URL without its fragment.

    Only a URL that has a fragment is rewritten; rewriting also lowers the scheme and drops an
    empty query, as ``urllib.parse.urldefrag`` does.
    """
    head = F.regexp_replace(clean(url), r"(?s)#.*\z", "")
    bare = F.regexp_replace(head, r"^([^?]*)\?\z", "$1")
    scheme = F.regexp_extract(bare, rf"^({_SCHEME}):", 1)
    lowered = F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1))
    return F.when(url.contains("#"), lowered).otherwise(url)


def canonical_url(url: Column) -> Column:
    """Normalised URL used as the identity of a page.

    Fragment, user info, default or zero port and ;params go; scheme and host are lowered; an empty
    path becomes ``/``; path and query are otherwise untouched. A URL whose port is no number below
    65536, or whose brackets do not pair, comes back defragmented only. URLs in canonical form
    already take a single regular-expression test.
    """
    u = F.regexp_replace(url, r"(?s)^[\x00-\x20]+|[\t\r\n]|#.*", "")
    scheme = scheme_of(u)
    port = F.regexp_extract(u, _PORT, 1)
    digits = F.regexp_replace(port, "^0+", "")
    authority = authority_of(u)
    broken = (
        ~port.rlike(r"^[0-9]*\z")
        | (F.length(digits) > 5)
        | F.coalesce(digits.try_cast("int") > 65535, F.lit(False))
        | (authority.contains("[") != authority.contains("]"))
    )
    implied = F.concat(scheme, F.lit(":"), digits).isin("http:80", "https:443") | (digits == "")
    path = path_of(u)
    query = query_of(u)
    rebuilt = F.concat(
        scheme,
        F.lit("://"),
        F.lower(F.regexp_extract(u, _HOST, 1)),
        F.when(implied, "").otherwise(F.concat(F.lit(":"), digits)),
        F.when(path == "", "/").otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )
    return F.when(url.rlike(_CANONICAL), url).when(broken, defragment(url)).otherwise(rebuilt)


def url_domain(url: Column) -> Column:
    """Lower-case host name without port, empty when there is none."""
    return F.lower(F.regexp_extract(clean(url), _HOST, 1))


def superdomain(host: Column) -> Column:
    """Last two labels of a host; a single label stays as it is."""
    return F.substring_index(host, ".", -2)


def has_disallowed_extension(
    url: Column, extensions: Iterable[str] = DISALLOWED_EXTENSIONS
) -> Column:
    """True when the path, without query and ;params, ends in one of ``extensions``, any case."""
    names = "|".join(extensions)
    last = rf"(?:[^?#]*/)?[^/;?#]*\.(?:{names})(?:;[^/?#]*)?(?=[?#]|\z)"
    return url.rlike(rf"(?i){_HEAD}(?://[^/?#]*)?{last}")


def is_navigable(href: Column) -> Column:
    """False for an empty href and for schemes that lead to no page."""
    names = "|".join(NON_PAGE_SCHEMES)
    return (href != "") & ~href.rlike(rf"(?iU)^[\s\x1c-\x1f]*(?:{names}):")


def is_web(url: Column) -> Column:
    """http or https by parsed scheme, whatever its case."""
    return scheme_of(clean(url)).isin("http", "https")


def is_web_literal(url: Column) -> Column:
    """Starts with ``http://`` or ``https://`` exactly."""
    return url.startswith("http://") | url.startswith("https://")


def _merged_path(base_path: Column, path: Column) -> Column:
    """Path of a relative reference against ``base_path``, dot segments removed."""
    base_dir = F.when(base_path == "", "/").otherwise(F.regexp_replace(base_path, r"[^/]*\z", ""))
    parts = F.split(F.concat(base_dir, path), "/", -1)
    inner = F.filter(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), lambda s: s != ""
    )
    relative = F.concat(F.slice(parts, 1, 1), inner, F.slice(parts, -1, 1))
    segments = F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(relative)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on a page at ``base`` (an http or https URL), fragment dropped.

    Root-relative hrefs without dot segments, the usual case, are a plain concatenation.
    """
    page_scheme = scheme_of(base)
    origin = F.concat(page_scheme, F.lit("://"), authority_of(base))
    base_path = raw_path_of(base)
    written = F.regexp_replace(clean(href), r"(?s)#.*\z", "")
    scheme = scheme_of(written)
    rest = F.when(scheme == page_scheme, F.substr(written, F.length(scheme) + 2)).otherwise(written)
    local = F.regexp_replace(rest, r"^//(?=[/?]|\z)", "")
    path = F.regexp_extract(local, r"(?s)^([^?]*)", 1)
    tail = F.regexp_extract(local, r"(?s)^[^?]*(\?.+)\z", 1)
    simple = rest.rlike(r"^/(?:[^/?][^?]*)?\z") & ~rest.rlike(r"/\.{1,2}(?:/|\z)")
    return (
        F.when(simple, F.concat(origin, rest))
        .when((scheme != "") & (scheme != page_scheme), defragment(href))
        .when(rest.rlike("^//[^/?]"), F.concat(page_scheme, F.lit(":"), path, tail))
        .when((path == "") & (tail == ""), defragment(base))
        .when(path == "", F.concat(origin, base_path, tail))
        .otherwise(F.concat(origin, _merged_path(base_path, path), tail))
    )
