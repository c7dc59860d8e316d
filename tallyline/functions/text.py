"""Text columns: trimming with the whitespace sets of the two clients, and byte decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters trimmed by the browser client and by the server.
_SHARED_SPACE = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BROWSER_SPACE = _SHARED_SPACE + "\ufeff"
SERVER_SPACE = _SHARED_SPACE + "\x1c\x1d\x1e\x1f\x85"


def trim_all(value: Column, space: str = SERVER_SPACE) -> Column:
    """Drop every kind of leading and trailing whitespace (plain `trim` only drops spaces)."""
    return F.btrim(value, F.lit(space))


def decode_lenient(value: Column) -> Column:
    """Bytes to text; invalid UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(value.cast("string"))
