"""Random draws that depend on a row's key, not on where the row is stored.

``rand()`` changes when a table is repartitioned or a lost task is retried on
other input order. These draws are a hash of (seed, key, ...), so every retry
and every partitioning gives the same value, and plain SQL can repeat them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits are 52 bits, which a double holds exactly.
_DIGITS = 13
_SPAN = float(16 ** _DIGITS)


def _digest(seed, parts) -> Column:
    pieces = [F.lit(str(seed))]
    for part in parts:
        part = F.lit(part) if isinstance(part, (str, int)) else part
        pieces += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*pieces).cast("binary"))


def _unit(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, _DIGITS), 16, 10).cast("double") / F.lit(_SPAN)


def uniform(seed, *parts) -> Column:
    """Uniform double in [0, 1) for the given seed and key parts.

    Column parts are taken by value, plain strings and integers as literals.
    A null part gives null.
    """
    return _unit(_digest(seed, parts), 1)


def normal(seed, *parts) -> Column:
    """Standard normal draw (Box-Muller) from one hash of seed and key parts."""
    digest = _digest(seed, parts)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _unit(digest, 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _unit(digest, 1 + _DIGITS))
