"""IPv4 string tests as native column expressions (no UDFs).

The traffic logs carry addresses as free text, often malformed. The default
"dotted quad" test is the loose one the original jobs apply: splitting on a
literal dot, with trailing empty parts dropped, must give four parts. So
``1.2.3.4.`` and ``...4`` and ``999.a.b.c`` pass, ``1.2.3.`` does not, and
NULL never passes. ``strict=True`` asks for four decimal octets 0-255.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: four decimal octets 0-255, nothing else.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
STRICT_QUAD = rf"^{_OCTET}(\.{_OCTET}){{3}}$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_quad(ip: Column | str, strict: bool = False) -> Column:
    """TRUE when ``ip`` looks like a dotted quad; FALSE (never NULL) otherwise."""
    c = _c(ip)
    if strict:
        test = c.rlike(STRICT_QUAD)
    else:
        # Dropping trailing dots mirrors "trailing empty parts are dropped";
        # then exactly three dots means exactly four parts.
        stripped = F.rtrim(c, F.lit("."))
        test = (F.length(stripped) - F.length(F.translate(stripped, ".", ""))) == 3
    return F.coalesce(test, F.lit(False))


def subnet24(ip: Column | str) -> Column:
    """First three dot-separated parts: the /24 network of a dotted quad."""
    return F.substring_index(_c(ip), ".", 3)


def matches_target(ip: Column | str, target: str, match: str = "contains", strict: bool = False) -> Column:
    """Target test on a quad address (loose quad test unless ``strict``).

    ``contains`` (the default) is a substring test, so ``6.2.230`` also hits
    ``106.2.230.7``; ``prefix`` anchors the target at the start.
    """
    c = _c(ip)
    if match == "contains":
        hit = c.contains(target)
    elif match == "prefix":
        hit = c.startswith(target)
    else:
        raise ValueError(f"match must be 'contains' or 'prefix', not {match!r}")
    return is_quad(c, strict=strict) & F.coalesce(hit, F.lit(False))


def same_subnet24(a: Column, b: Column) -> Column:
    """Both non-empty dotted quads in the same /24 (octets compared with separators)."""
    return (
        F.coalesce(a != F.lit(""), F.lit(False))
        & F.coalesce(b != F.lit(""), F.lit(False))
        & is_quad(a)
        & is_quad(b)
        & (subnet24(a) == subnet24(b))
    )
