"""Path and zone-name column expressions.

Paths are ``array<bigint>`` of zone ids inside the library; text
(``"1,2,3"``) only at sinks and in query outputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_text(path, sep: str = ",") -> Column:
    """``[1, 2, 3]`` -> ``"1,2,3"``."""
    return F.array_join(_c(path), sep)


def parse_path(text, sep: str = ",") -> Column:
    """``"1,2,3"`` -> ``[1, 2, 3]`` (bad tokens become NULL elements)."""
    return F.transform(F.split(_c(text), sep), lambda t: F.trim(t).try_cast("bigint"))


def is_subsequence(child, parent) -> Column:
    """Ordered subsequence test with gaps allowed (two-pointer as a fold):
    walk ``parent`` and advance a cursor into ``child`` on each match."""
    child, parent = _c(child), _c(parent)
    matched = F.aggregate(
        parent, F.lit(0),
        lambda i, x: F.when(F.get(child, i) == x, i + 1).otherwise(i))
    return matched == F.size(child)


def is_contiguous(child, parent, sep: str = ",") -> Column:
    """Contiguous sub-path test on delimited text; the delimiters around both
    sides keep id 1 from matching inside 11."""
    child, parent = _c(child), _c(parent)
    return F.contains(F.concat(F.lit(sep), F.array_join(parent, sep), F.lit(sep)),
                      F.concat(F.lit(sep), F.array_join(child, sep), F.lit(sep)))


# Four moduli below 2**31 (products stay within a long) and a base for each.
_MODULI = (2147483629, 2147483587, 2147483579, 2147483563)
_BASES = (1103515245, 1566083941, 1812433253, 1664525)


def prefix_hashes(path: str, lanes: int = 2) -> Column:
    """Rolling hashes of all beginnings of a path (column name), the empty one
    first: per lane an array of size + 1 longs, with the powers of its base.

    ``slice_hash`` takes from it the hash of any slice in constant time."""
    out = []
    for k in range(lanes):
        m, base = _MODULI[k], _BASES[k]
        h = (f"aggregate({path}, array(0L), (a, x) -> array_append(a, (element_at(a, -1) * {base}L + pmod(xxhash64(x), {m}L)) % {m}L))")
        p = f"aggregate({path}, array(1L), (a, x) -> array_append(a, element_at(a, -1) * {base}L % {m}L))"
        out += [F.expr(h).alias(f"h{k}"), F.expr(p).alias(f"p{k}")]
    return F.struct(*out)


def slice_hash(hashes: str, start: str, size: str, lane: int = 0) -> str:
    """SQL of the hash, of two lanes as one long, of ``size`` elements from ``start`` (0-based)."""
    def one(k: int) -> str:
        return f"pmod({hashes}.h{k}[{start} + {size}] - {hashes}.h{k}[{start}] * {hashes}.p{k}[{size}] % {_MODULI[k]}L, {_MODULI[k]}L)"
    return f"(shiftleft({one(2 * lane)}, 32) | {one(2 * lane + 1)})"


def short_zone_name(zone) -> Column:
    """First segment of an ``"A/B/C"`` zone name."""
    return F.substring_index(_c(zone), "/", 1)


def undirected_pair(a, b) -> Column:
    """Unordered pair key, smaller id first."""
    a, b = _c(a), _c(b)
    return F.when(a < b, F.array(a, b)).otherwise(F.array(b, a))
