"""Match predicates on plain columns.

Every function returns a ``Column`` so Catalyst can push it into the Parquet scan,
combine it with other filters and reorder it. NULL compares as false (two-valued logic).
"""

from __future__ import annotations

import datetime as dt
import ipaddress
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from searchlake.functions import datemath
from searchlake.operators.util import as_col, fold, null_false




def term(c, value, multi_valued: bool = False) -> Column:
    """Exact term on an untokenized field (F01); multi-valued → any element equals."""
    x = as_col(c)
    return null_false(F.array_contains(x, value) if multi_valued else x == F.lit(value))


def terms(c, values, multi_valued: bool = False) -> Column:
    """Any of a list of terms."""
    x = as_col(c)
    vals = list(values)
    if multi_valued:
        return null_false(F.arrays_overlap(x, F.array(*[F.lit(v) for v in vals])))
    return null_false(x.isin(vals))


def prefix(c, p: str) -> Column:
    """Prefix (F04)."""
    return null_false(as_col(c).startswith(p))


def wildcard_to_like(pattern: str, escape: str = "\\") -> str:
    """``*``/``?`` wildcard with backslash escapes → SQL LIKE pattern (escape char ``\\``)."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == escape and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            out.append("\\" + nxt if nxt in "%_\\" else nxt)
            i += 2
            continue
        if ch == "*":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in "%_":
            out.append("\\" + ch)
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def wildcard(c, pattern: str) -> Column:
    """Wildcard ``*`` (any run) and ``?`` (one char) over the whole value."""
    return null_false(as_col(c).like(wildcard_to_like(pattern)))


def regexp(c, pattern: str) -> Column:
    """Regular expression anchored to the whole term."""
    return null_false(as_col(c).rlike(f"^(?:{pattern})$"))


def _bound(x: Column, lo, hi, incl_lo: bool, incl_hi: bool) -> Column:
    parts = []
    if lo is not None:
        parts.append(x >= F.lit(lo) if incl_lo else x > F.lit(lo))
    if hi is not None:
        parts.append(x <= F.lit(hi) if incl_hi else x < F.lit(hi))
    if not parts:
        return x.isNotNull()
    return null_false(fold(lambda a, b: a & b, parts))


def term_range(c, lo=None, hi=None, incl_lo: bool = True, incl_hi: bool = True) -> Column:
    """Lexicographic range (F08); ``None`` = open end (``*``). Binary (UTF-8) order."""
    return _bound(as_col(c), lo, hi, incl_lo, incl_hi)


def num_range(c, lo=None, hi=None, incl_lo: bool = True, incl_hi: bool = True) -> Column:
    """Numeric range ``[lo TO hi]`` / ``{lo TO hi}`` (F09); pushed down to Parquet row-group stats."""
    return _bound(as_col(c), lo, hi, incl_lo, incl_hi)


def any_in_range(c, lo=None, hi=None, incl_lo: bool = True, incl_hi: bool = True) -> Column:
    """Multi-valued range: any element in range."""
    return null_false(F.exists(as_col(c), lambda x: _bound(x, lo, hi, incl_lo, incl_hi)))


def date_range(c, lo=None, hi=None, incl_lo: bool = True, incl_hi: bool = True,
               now: dt.datetime | None = None, tz: str = "UTC") -> Column:
    """Date range with date-math ends such as ``NOW/DAY-7DAYS`` (F12); folded to literals on the driver."""
    lo_v = datemath.resolve(lo, now=now, tz=tz) if lo is not None else None
    hi_v = datemath.resolve(hi, now=now, tz=tz) if hi is not None else None
    return _bound(as_col(c), lo_v, hi_v, incl_lo, incl_hi)


def has_value(c) -> Column:
    """Field present (F13); an empty multi-value counts as missing."""
    x = as_col(c)
    return null_false(x.isNotNull())


def has_values(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, ArrayType):
        return null_false(F.size(F.col(c)) > 0)
    return has_value(c)


def missing(c) -> Column:
    return ~has_value(c)


def bool_query(must=(), should=(), must_not=(), min_should_match: int | None = None) -> Column:
    """MUST / SHOULD / MUST_NOT with an optional minimum of SHOULD matches.

    Without MUST clauses at least one SHOULD must match; a pure-negative query matches
    all docs minus the negatives (the implicit ``*:*``).
    """
    must = [null_false(p) for p in must]
    should = [null_false(p) for p in should]
    must_not = [null_false(p) for p in must_not]
    parts = list(must)
    if should:
        k = min_should_match if min_should_match is not None else (0 if must else 1)
        if k > 0:
            n = fold(lambda a, b: a + b, [F.when(p, 1).otherwise(0) for p in should])
            parts.append(n >= k)
    for p in must_not:
        parts.append(~p)
    if not parts:
        return F.lit(True)
    return fold(lambda a, b: a & b, parts)


def min_should_match(n_optional: int, spec: str | int | None) -> int:
    """Resolve a minimum-should-match spec against the number of optional clauses.

    Forms: ``3``, ``-2``, ``75%``, ``-25%`` and conditional ``2<75% 9<-3`` (for more than 2
    clauses use 75%, for more than 9 use n−3). Percentages truncate toward zero; negative
    forms subtract from ``n``; the result is clamped to ``[0, n]``.
    """
    if spec is None:
        return 0
    s = str(spec).strip()
    if "<" in s:
        result = n_optional
        for part in s.split():
            upper, _, value = part.partition("<")
            if n_optional > int(upper.strip()):
                result = min_should_match(n_optional, value)
            else:
                break
        return max(0, min(result, n_optional))
    if s.endswith("%"):
        import numpy as np

        pct = int(s[:-1])
        # the reference multiplies in float32 and truncates toward zero
        calc = float(np.float32(n_optional * pct) * np.float32(np.float32(1) / np.float32(100)))
        r = n_optional + int(calc) if calc < 0 else int(calc)
    else:
        v = int(s)
        r = n_optional + v if v < 0 else v
    return max(0, min(r, n_optional))


def frange(expr: Column, lo=None, hi=None, incl_lo: bool = True, incl_hi: bool = True) -> Column:
    """Function range ``{!frange l= u=}`` (F22); use ``functions.field`` so missing numerics are 0."""
    return _bound(expr, lo, hi, incl_lo, incl_hi)


def chain(preds: list[Column], ops: list[str]) -> Column:
    """Fold predicates left to right with AND / OR / ANDNOT / XOR."""
    acc = null_false(preds[0])
    for p, op in zip(preds[1:], ops):
        p = null_false(p)
        op = op.upper()
        if op == "AND":
            acc = acc & p
        elif op == "OR":
            acc = acc | p
        elif op == "ANDNOT":
            acc = acc & ~p
        elif op == "XOR":
            acc = (acc & ~p) | (~acc & p)
        else:
            raise ValueError(op)
    return acc


# ------------------------------------------------------------------ geo

EARTH_MEAN_RADIUS_KM = 6371.0087714


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_MEAN_RADIUS_KM) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    la1, lo1 = F.radians(as_col(lat1)), F.radians(as_col(lon1))
    la2 = F.radians(lat2 if isinstance(lat2, Column) else F.lit(float(lat2)))
    lo2 = F.radians(lon2 if isinstance(lon2, Column) else F.lit(float(lon2)))
    h = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def bbox_ranges(lat: float, lon: float, d_km: float, radius: float = EARTH_MEAN_RADIUS_KM):
    """Lat range and one or two lon ranges of the box around a circle (date-line and poles aware)."""
    ang = math.degrees(d_km / radius)
    lat_lo, lat_hi = lat - ang, lat + ang
    if lat_hi >= 90 or lat_lo <= -90:
        # the circle covers a pole: full longitude band
        return max(lat_lo, -90.0), min(lat_hi, 90.0), [(-180.0, 180.0)]
    dlon = math.degrees(math.asin(min(1.0, math.sin(math.radians(ang)) / math.cos(math.radians(lat)))))
    lo_lo, lo_hi = lon - dlon, lon + dlon
    if lo_lo < -180:
        return lat_lo, lat_hi, [(lo_lo + 360, 180.0), (-180.0, lo_hi)]
    if lo_hi > 180:
        return lat_lo, lat_hi, [(lo_lo, 180.0), (-180.0, lo_hi - 360)]
    return lat_lo, lat_hi, [(lo_lo, lo_hi)]


def bbox(lat_c, lon_c, lat: float, lon: float, d_km: float) -> Column:
    """Bounding box of a circle (F36): range predicates only (Parquet min/max can prune)."""
    la_lo, la_hi, lons = bbox_ranges(lat, lon, d_km)
    la, lo = as_col(lat_c), as_col(lon_c)
    lon_pred = fold(lambda a, b: a | b, [(lo >= a) & (lo <= b) for a, b in lons])
    return null_false((la >= la_lo) & (la <= la_hi) & lon_pred)


def geofilt(lat_c, lon_c, lat: float, lon: float, d_km: float) -> Column:
    """Circle filter (F35): box pre-filter AND exact haversine distance ≤ d."""
    return bbox(lat_c, lon_c, lat, lon, d_km) & null_false(haversine_km(lat_c, lon_c, lat, lon) <= d_km)


def point_range(cols: list, lo: list, hi: list) -> Column:
    """n-dimensional (or lat/lon rectangle) range: every dimension within its bounds."""
    return fold(lambda a, b: a & b, [num_range(c, l, h) for c, l, h in zip(cols, lo, hi)])


def geohash_filter(c, cells: list[str]) -> Column:
    """Geohash cell filter: the value lies in any of the given cells (prefix match)."""
    x = as_col(c)
    return null_false(fold(lambda a, b: a | b, [x.startswith(cell) for cell in cells]))


# ------------------------------------------------------------------ log helpers

def ip_to_long(c) -> Column:
    """Dotted IPv4 → integer (NULL if malformed)."""
    parts = F.split(as_col(c), r"\.")
    octets = [F.try_element_at(parts, F.lit(i + 1)).try_cast("long") for i in range(4)]
    v = octets[0] * (1 << 24) + octets[1] * (1 << 16) + octets[2] * (1 << 8) + octets[3]
    ok = F.size(parts) == 4
    return F.when(ok, v)


def in_subnet(c, cidr: str) -> Column:
    """IPv4 address inside a CIDR block (F41), e.g. to drop the server's own /24 from a log."""
    net = ipaddress.ip_network(cidr, strict=False)
    lo, hi = int(net.network_address), int(net.broadcast_address)
    v = ip_to_long(c)
    return null_false((v >= lo) & (v <= hi))
