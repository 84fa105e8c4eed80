"""IPv4 text -> number, and address syntax checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}$"
# Loose IPv6 shape: hex groups and colons, at least two colons, optional dotted tail.
IPV6_PATTERN = r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ipv4(c) -> Column:
    """True for dotted-quad text with every octet in 0..255 (no spaces, no sign)."""
    return F.coalesce(_c(c).rlike(IPV4_PATTERN), F.lit(False))


def is_ipv6(c) -> Column:
    return F.coalesce(_c(c).rlike(IPV6_PATTERN), F.lit(False))


def ipv4_to_long(c) -> Column:
    """Numeric value of a valid IPv4 address, null otherwise."""
    col = _c(c)
    parts = [F.split_part(col, F.lit("."), F.lit(i)).cast("bigint") for i in (1, 2, 3, 4)]
    value = parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3]
    return F.when(is_ipv4(col), value)
