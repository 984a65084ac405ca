"""Function-query language as Column builders.

Bare numeric field references read missing values as 0 (``field``), the one value rule the
reference applies everywhere; ``exists``/``def_`` see the raw column. Arithmetic is double
(the reference uses float32, D1). Everything is a built-in expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchlake.operators.util import fold


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return field(x)
    return F.lit(x)


def literal(v) -> Column:
    """X01."""
    return F.lit(v)


def field(name: str) -> Column:
    """Numeric field, missing → 0."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def linear(x, m: float, c: float) -> Column:
    """m·x + c (X06)."""
    return F.lit(float(m)) * _c(x) + F.lit(float(c))


def recip(x, m: float, a: float, b: float) -> Column:
    """a / (m·x + b)."""
    return div(F.lit(float(a)), F.lit(float(m)) * _c(x) + F.lit(float(b)))


def scale(df: DataFrame, x, lo: float, hi: float, name: str = "scaled") -> DataFrame:
    """Rescale ``x`` linearly so the global min maps to ``lo`` and max to ``hi``.

    Global min/max is a one-row aggregate joined back by broadcast (size 1, proven)."""
    v = _c(x)
    mm = df.agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    j = df.crossJoin(F.broadcast(mm))
    span = F.col("_mx") - F.col("_mn")
    scaled = F.when(span == 0, F.lit(float(lo))).otherwise(
        (v - F.col("_mn")) * F.lit(float(hi - lo)) / span + F.lit(float(lo)))
    return j.withColumn(name, scaled).drop("_mn", "_mx")


def div(a, b) -> Column:
    """Double division with IEEE results for zero divisors (x/0 = ±Inf, 0/0 = NaN)."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    inf = F.lit(float("inf"))
    return (F.when(b != 0, a / b)
            .when(a > 0, inf).when(a < 0, -inf).otherwise(F.lit(float("nan"))))


def mod(a, b) -> Column:
    """Remainder with the dividend's sign (X09/X10); NaN for a zero divisor."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return F.when(b != 0, a % b).otherwise(F.lit(float("nan")))


def map_range(x, lo: float, hi: float, target, default=None) -> Column:
    """``map(x,min,max,target[,default])``: target when lo ≤ x ≤ hi, else default or x (X11)."""
    v = _c(x)
    other = _c(default) if default is not None else v
    return F.when((v >= F.lit(float(lo))) & (v <= F.lit(float(hi))), _c(target)).otherwise(other)


def abs_(x) -> Column:
    return F.abs(_c(x))


def sum_(*xs) -> Column:
    """X13."""
    return fold(lambda a, b: a + b, [_c(x) for x in xs])


def product(*xs) -> Column:
    """X14."""
    return fold(lambda a, b: a * b, [_c(x) for x in xs])


def sub(a, b) -> Column:
    """X15."""
    return _c(a) - _c(b)


def vector(*xs) -> Column:
    """X16."""
    return F.array(*[_c(x) for x in xs])


def max_(*xs) -> Column:
    """X19."""
    return F.greatest(*[_c(x) for x in xs]) if len(xs) > 1 else _c(xs[0])


def min_(*xs) -> Column:
    return F.least(*[_c(x) for x in xs]) if len(xs) > 1 else _c(xs[0])


def pow_(a, b) -> Column:
    return F.pow(_c(a), _c(b))


def log(x) -> Column:
    """Base-10 logarithm (X25): -Infinity at 0, NaN below."""
    return _log_or_limit(F.log10, _c(x))


def ln(x) -> Column:
    return _log_or_limit(F.ln, _c(x))


def _log_or_limit(f, x: Column) -> Column:
    return F.when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan"))).otherwise(f(x))


def rint(x) -> Column:
    """Round half to even."""
    return F.rint(_c(x))


def exists(name: str) -> Column:
    """The raw value is present."""
    return F.col(name).isNotNull()


def _truthy(x) -> Column:
    c = x if isinstance(x, Column) else F.col(x)
    return F.coalesce(c.cast("boolean"), F.lit(False))


def not_(x) -> Column:
    return ~_truthy(x)


def and_(*xs) -> Column:
    return fold(lambda a, b: a & b, [_truthy(x) for x in xs])


def or_(*xs) -> Column:
    return fold(lambda a, b: a | b, [_truthy(x) for x in xs])


def xor(*xs) -> Column:
    """At least one true and at least one false."""
    ts = [_truthy(x) for x in xs]
    return fold(lambda a, b: a | b, ts) & ~fold(lambda a, b: a & b, ts)


def if_(cond, a, b) -> Column:
    """X34."""
    return F.when(_truthy(cond), _c(a)).otherwise(_c(b))


def def_(*names) -> Column:
    """First existing value."""
    return F.coalesce(*[F.col(n) if isinstance(n, str) else n for n in names])


def ms(a=None, b=None) -> Column:
    """Epoch milliseconds of a date, or the difference of two (X36); ``ms()`` = now."""
    def m(x):
        if x is None:
            return F.unix_millis(F.current_timestamp())
        return F.unix_millis(F.col(x) if isinstance(x, str) else x)
    if a is None:
        return m(None)
    if b is None:
        return m(a)
    return m(a) - m(b)


# ------------------------------------------------------------------ vector distances

def dist(p: float, a: Column, b: Column) -> Column:
    """p-norm distance of two equal-length numeric arrays (X37): p=0 counts differing dims,
    p=∞ is the max abs difference, otherwise (Σ|a−b|^p)^(1/p)."""
    diffs = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    if p == 0:
        return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + F.when(d != 0, 1.0).otherwise(0.0))
    if math.isinf(p):
        return F.aggregate(diffs, F.lit(0.0), lambda acc, d: F.greatest(acc, d))
    if p == 1:
        return F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d)
    if p == 2:
        return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + d * d))
    s = F.aggregate(diffs, F.lit(0.0), lambda acc, d: acc + F.pow(d, F.lit(float(p))))
    return F.pow(s, F.lit(1.0 / p))


def sqedist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")),
                       F.lit(0.0), lambda acc, d: acc + d * d)


def hsin(radius: float, lat1, lon1, lat2, lon2, convert: bool = True) -> Column:
    """Haversine distance (X39); ``convert`` = inputs in degrees."""
    cv = (lambda x: F.radians(_c(x))) if convert else _c
    la1, lo1, la2, lo2 = cv(lat1), cv(lon1), cv(lat2), cv(lon2)
    h = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


EARTH_MEAN_RADIUS_KM = 6371.0087714


def geodist(lat, lon, pt_lat: float, pt_lon: float) -> Column:
    """Distance in km from a fixed point."""
    return hsin(EARTH_MEAN_RADIUS_KM, lat, lon, F.lit(float(pt_lat)), F.lit(float(pt_lon)))


# ------------------------------------------------------------------ geohash

# Fixed value: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lat, lon, length: int = 12) -> Column:
    """Encode lat/lon to a geohash string (X41), JVM-side.

    The 5·length interleaved bits alternate longitude/latitude bisection; each coordinate's
    bisection bits are the binary digits of its cell index at full depth, so every character is
    a fixed arithmetic expression of the two indexes (no loop over rows, no UDF)."""
    la, lo = _c(lat), _c(lon)
    nbits = 5 * length
    lon_bits = (nbits + 1) // 2
    lat_bits = nbits // 2
    lon_idx = F.least(F.greatest(F.floor((lo + 180.0) / 360.0 * F.lit(float(1 << lon_bits))), F.lit(0))
                      .cast("long"), F.lit((1 << lon_bits) - 1))
    lat_idx = F.least(F.greatest(F.floor((la + 90.0) / 180.0 * F.lit(float(1 << lat_bits))), F.lit(0))
                      .cast("long"), F.lit((1 << lat_bits) - 1))

    def bit(i: int) -> Column:
        if i % 2 == 0:
            return F.shiftright(lon_idx, lon_bits - 1 - i // 2).bitwiseAND(F.lit(1))
        return F.shiftright(lat_idx, lat_bits - 1 - (i - 1) // 2).bitwiseAND(F.lit(1))

    chars = []
    for k in range(length):
        v = fold(lambda a, b: a + b, [bit(5 * k + j) * (1 << (4 - j)) for j in range(5)])
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (v + 1).cast("int"), 1))
    return F.concat(*chars)


def geohash_decode(gh: Column) -> tuple[Column, Column]:
    """Geohash → (lat, lon) of the cell centre, JVM-side (used by X42)."""
    chars = F.filter(F.split(gh, ""), lambda ch: ch != "")
    idx = F.transform(chars, lambda ch: F.position(ch, F.lit(GEOHASH_ALPHABET)) - 1)
    bits = F.flatten(F.transform(idx, lambda v: F.array(*[F.shiftright(v, 4 - j).bitwiseAND(F.lit(1))
                                                         for j in range(5)])))
    init = F.struct(F.lit(-90.0).alias("a"), F.lit(90.0).alias("b"), F.lit(-180.0).alias("c"),
                    F.lit(180.0).alias("d"), F.lit(0).alias("i"))

    def step(acc, b):
        is_lon = (acc["i"] % 2) == 0
        mid_lon = (acc["c"] + acc["d"]) / 2
        mid_lat = (acc["a"] + acc["b"]) / 2
        return F.struct(
            F.when(~is_lon & (b == 1), mid_lat).otherwise(acc["a"]).alias("a"),
            F.when(~is_lon & (b == 0), mid_lat).otherwise(acc["b"]).alias("b"),
            F.when(is_lon & (b == 1), mid_lon).otherwise(acc["c"]).alias("c"),
            F.when(is_lon & (b == 0), mid_lon).otherwise(acc["d"]).alias("d"),
            (acc["i"] + 1).alias("i"))

    box = F.aggregate(bits, init, step)
    return (box["a"] + box["b"]) / 2, (box["c"] + box["d"]) / 2


def ghhsin(radius: float, gh1: Column, gh2: Column) -> Column:
    """Haversine distance between two geohash cell centres."""
    la1, lo1 = geohash_decode(gh1)
    la2, lo2 = geohash_decode(gh2)
    return hsin(radius, la1, lo1, la2, lo2, convert=True)


# ------------------------------------------------------------------ strings

def strdist_edit(a: Column, b: Column) -> Column:
    """1 − levenshtein/max(len) (X43); 1.0 for two empty strings."""
    mx = F.greatest(F.length(a), F.length(b))
    return F.when(mx == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / mx)


def _jaro_winkler(s1: str, s2: str) -> float:
    if s1 is None or s2 is None:
        return None
    if s1 == s2:
        return 1.0
    l1, l2 = len(s1), len(s2)
    if l1 == 0 or l2 == 0:
        return 0.0
    rng = max(0, max(l1, l2) // 2 - 1)
    m1 = [False] * l1
    m2 = [False] * l2
    matches = 0
    for i, ch in enumerate(s1):
        for j in range(max(0, i - rng), min(l2, i + rng + 1)):
            if not m2[j] and s2[j] == ch:
                m1[i] = m2[j] = True
                matches += 1
                break
    if matches == 0:
        return 0.0
    t = 0
    j = 0
    for i in range(l1):
        if m1[i]:
            while not m2[j]:
                j += 1
            if s1[i] != s2[j]:
                t += 1
            j += 1
    t //= 2
    jaro = (matches / l1 + matches / l2 + (matches - t) / matches) / 3.0
    p = 0
    for a, b in zip(s1[:4], s2[:4]):
        if a != b:
            break
        p += 1
    return jaro + p * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _ngram_distance(source: str, target: str, n: int = 2) -> float:
    """N-gram similarity after Kondrak (2005), in [0, 1]: an alignment in which every character stands for the
    n-gram that ends with it (n-1 pad characters before the first). Replacing one n-gram by another costs the
    share of its places that differ, places padded in both left out; insertion and deletion cost 1."""
    if source is None or target is None:
        return None
    if not source or not target:
        return float(source == target)
    longest = max(len(source), len(target))
    if min(len(source), len(target)) < n:
        return sum(a == b for a, b in zip(source, target, strict=False)) / longest
    pad = [None] * (n - 1)
    grams = [[tuple((pad + list(w))[i:i + n]) for i in range(len(w))] for w in (source, target)]

    def change(a, b):
        real = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
        return sum(x != y for x, y in real) / len(real)

    row = list(range(len(grams[0]) + 1))
    for j, b in enumerate(grams[1], 1):
        above, row = row, [j]
        for i, a in enumerate(grams[0], 1):
            row.append(min(row[i - 1] + 1, above[i] + 1, above[i - 1] + change(a, b)))
    return 1.0 - row[-1] / longest


def strdist_jw(a: Column, b: Column) -> Column:
    """Jaro–Winkler similarity (X44), Arrow-batched pandas UDF (run it on distinct pairs)."""
    @F.pandas_udf("double")
    def jw(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_jaro_winkler(p, q) for p, q in zip(x, y)], dtype="float64")

    return jw(a, b)


def strdist_ngram(a: Column, b: Column, n: int = 2) -> Column:
    """N-gram distance similarity (X45), Arrow-batched pandas UDF (distinct pairs)."""
    @F.pandas_udf("double")
    def ng(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_ngram_distance(p, q, n) for p, q in zip(x, y)], dtype="float64")

    return ng(a, b)


# ------------------------------------------------------------------ ordinals

def ord_(df: DataFrame, col: str, name: str = "ord", reverse: bool = False) -> DataFrame:
    """1-based rank of each row's value among the sorted distinct values; 0 for missing.

    The distinct values are numbered with a distributed row number (range partitioning, no
    single-partition window) and joined back on the value (shuffle join; AQE may broadcast it
    when the vocabulary is small)."""
    from searchlake.operators.util import global_row_number

    vocab = df.select(col).filter(F.col(col).isNotNull()).distinct()
    order = [F.col(col).desc()] if reverse else [F.col(col).asc()]
    numbered = global_row_number(vocab, order, name)
    return df.join(numbered, col, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))


# ------------------------------------------------------------------ currency

def currency_range(df: DataFrame, amount: str, code: str, rates: DataFrame, unit: str, low: float | None = None,
                   high: float | None = None) -> DataFrame:
    """Currency equality and range (F39): rows whose amount, converted to ``unit``, lies in [low, high]; an open end is
    None, equality has both ends equal. Rows whose currency has no rate to ``unit`` do not match."""
    name = "_in_unit"
    value = F.col(name)
    test = value.isNotNull()
    if low is not None:
        test &= value >= low
    if high is not None:
        test &= value <= high
    return convert_currency(df, amount, code, unit, rates, name).where(test).drop(name)


def currency_rates_closure(rates: DataFrame) -> DataFrame:
    """Rate table (from,to,rate) plus inverse rates (1/rate) and identity; direct rates win."""
    direct = rates.select("from", "to", F.col("rate").cast("double").alias("rate"), F.lit(0).alias("_p"))
    inverse = rates.select(F.col("to").alias("from"), F.col("from").alias("to"),
                           (F.lit(1.0) / F.col("rate")).alias("rate"), F.lit(1).alias("_p"))
    both = direct.unionByName(inverse)
    w = Window.partitionBy("from", "to").orderBy("_p")
    return both.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r", "_p")


def convert_currency(df: DataFrame, amount: str, code: str, target: str, rates: DataFrame,
                     name: str = "converted") -> DataFrame:
    """Convert ``amount`` in currency ``code`` to ``target`` (X46): same code → 1.0, else direct
    rate, else 1/reverse rate, else NULL (no triangulation). Rates are a small user table,
    broadcast after a size check."""
    from searchlake.operators.util import bounded_broadcast

    r = currency_rates_closure(rates).filter(F.col("to") == F.lit(target))
    r = bounded_broadcast(r.select(F.col("from").alias("_from"), F.col("rate").alias("_rate")))
    j = df.join(r, F.col(code) == F.col("_from"), "left")
    rate = F.when(F.col(code) == F.lit(target), F.lit(1.0)).otherwise(F.col("_rate"))
    return j.withColumn(name, F.col(amount) * rate).drop("_from", "_rate")
