"""Page bodies: byte cap, body policy and lenient UTF-8 decoding (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.metrics import HTML_PREFIX, is_html

# Byte caps of an HTML body and of any other body.
MAX_HTML_BYTES = 262144
SNIFF_BYTES = 4096

_REPLACEMENT = "�"
_ESCAPE = ""


def as_bytes(body: Column) -> Column:
    return body.cast("binary")


def capped(body: Column, cap: int = MAX_HTML_BYTES) -> Column:
    """First ``cap`` bytes of a body."""
    return F.substring(as_bytes(body), 1, cap)


def is_truncated(body: Column, cap: int | None = MAX_HTML_BYTES) -> Column:
    """True when the body reaches the cap, also when it is exactly that long; never without a cap."""
    if cap is None:
        return F.lit(False)
    return F.octet_length(as_bytes(body)) >= cap


def kept_body(body: Column, content_type: Column, cap: int = MAX_HTML_BYTES) -> Column:
    """Bytes kept of a body: up to the cap for HTML, a short sniff for everything else."""
    html = is_html(content_type, HTML_PREFIX)
    return F.when(html, capped(body, cap)).otherwise(F.substring(as_bytes(body), 1, SNIFF_BYTES))


def decode_lenient(body: Column) -> Column:
    """UTF-8 text of a body with undecodable bytes left out.

    ``make_valid_utf8`` marks such bytes with U+FFFD; marks written in the text itself are escaped
    first so that only the decoder's own marks are removed.
    """
    text = body.cast("string")
    escaped = F.replace(
        F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")),
        F.lit(_REPLACEMENT),
        F.lit(_ESCAPE + "1"),
    )
    cleaned = F.replace(F.make_valid_utf8(escaped), F.lit(_REPLACEMENT), F.lit(""))
    restored = F.replace(
        F.replace(cleaned, F.lit(_ESCAPE + "1"), F.lit(_REPLACEMENT)),
        F.lit(_ESCAPE + "0"),
        F.lit(_ESCAPE),
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(restored)
