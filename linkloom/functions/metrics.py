"""Scalar expressions of the crawl statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of a byte count, 1024 apart.
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB")

# Statuses that count against a domain (0 = no answer at all).
BACKOFF_STATUSES = (429, 417, 403, 401, 500, 0)

HTML_PREFIX = "text/html"


def at_least_zero(x: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), x)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 when there is no whole."""
    return F.coalesce(F.try_divide(100.0 * part.cast("double"), whole.cast("double")), F.lit(0.0))


def ratio(x: Column, y: Column) -> Column:
    return F.coalesce(F.try_divide(x.cast("double"), y.cast("double")), F.lit(0.0))


def human_bytes(n: Column) -> Column:
    """Byte count with one decimal and the largest unit that keeps it below 1024.

    Tenths are rounded half to even in integer arithmetic, which is exact; a formatted double is not.
    """

    def text(power: int, unit: str) -> Column:
        step = F.lit(1024**power).cast("bigint")
        tenths = n.cast("bigint") * 10
        low = F.shiftright(tenths, 10 * power)
        twice = (tenths - low * step) * 2
        up = (twice > step) | ((twice == step) & (low % 2 == 1))
        q = (low + up.cast("bigint")).cast("bigint")
        whole = F.floor(q / 10).cast("string")
        return F.concat(whole, F.lit("."), (q % 10).cast("string"), F.lit(f" {unit}"))

    out = None
    for power, unit in enumerate(BYTE_UNITS[:-1]):
        fits = n < F.lit(1024 ** (power + 1))
        out = F.when(fits, text(power, unit)) if out is None else out.when(fits, text(power, unit))
    return out.otherwise(text(len(BYTE_UNITS) - 1, BYTE_UNITS[-1]))


def novelty_priority(
    depth: Column,
    domain_seen: Column,
    super_seen: Column,
    w_domain: float = 1.0,
    w_super: float = 0.3,
    scale: float = 0.001,
) -> Column:
    """Depth less a small bonus that shrinks as the domain and superdomain have been seen more."""
    bonus = F.lit(w_domain) / F.log2(domain_seen + 2) + F.lit(w_super) / F.log2(super_seen + 2)
    return depth - F.lit(scale) * bonus


def is_html(content_type: Column, prefix: str = HTML_PREFIX) -> Column:
    return content_type.startswith(prefix)


def is_backoff_status(status: Column) -> Column:
    return status.isin(*BACKOFF_STATUSES)


def log_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
