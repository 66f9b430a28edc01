"""Deterministic hash draws as pure column expressions.

Every "random" choice of the engine is a function of a key and a salt:
``bucket(s) = int(md5(s), 16) mod 10**6`` (the source system's assignment
hash), ``u = bucket / 10**6``.  Draws are therefore partition-independent,
reproducible across reruns and executor loss, and expressible in SQL.

The 128-bit modulo is computed without a wide integer:
``(hi mod M) * (2**64 mod M) + lo mod M`` with hi/lo the two 64-bit halves.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1_000_000
_TWO64_MOD = (1 << 64) % BUCKETS  # 551616


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def md5_hex(*parts, sep: str | None = None) -> Column:
    """md5 of the string concatenation of ``parts`` (strings are literals
    when wrapped in F.lit; bare strings are column names)."""
    cols = [_c(p).cast("string") for p in parts]
    if sep is not None:
        return F.md5(F.concat_ws(sep, *cols))
    return F.md5(F.concat(*cols))


def bucket_of_hex(h: Column) -> Column:
    """int(h, 16) mod 10**6 for a 32-hex-digit md5 string, as bigint."""
    hi = F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.substring(h, 17, 16), 16, 10).cast("decimal(20,0)")
    hi_m = (hi % F.lit(BUCKETS)).cast("bigint")
    lo_m = (lo % F.lit(BUCKETS)).cast("bigint")
    return ((hi_m * F.lit(_TWO64_MOD) + lo_m) % F.lit(BUCKETS)).cast("bigint")


def bucket(*parts, sep: str | None = None) -> Column:
    return bucket_of_hex(md5_hex(*parts, sep=sep))


def hash60(h: Column) -> Column:
    """First 15 hex digits of an md5 as a non-negative bigint (ordering key)."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def md5_prefix_id(*parts, n: int = 16, sep: str = "_") -> Column:
    """hexdigest()[:n] of ``'_'.join(parts)``."""
    return F.substring(md5_hex(*parts, sep=sep), 1, n)


# ---------------------------------------------------------------------------
# Threshold tables: u <= c  <=>  bucket <= T(c), with T computed in Python
# float semantics once on the driver, so SQL engines compare integers only.
# ---------------------------------------------------------------------------

def inclusive_threshold(c: float) -> int:
    """Largest b in [-1, 10**6 - 1] with b / 10**6 <= c (Python floats)."""
    b = int(c * BUCKETS) + 2
    b = min(b, BUCKETS - 1)
    while b >= 0 and not (b / BUCKETS <= c):
        b -= 1
    return b


def cumulative_thresholds(weights: Sequence[float]) -> list[int]:
    """Integer cut points of a running float sum of ``weights``."""
    out, acc = [], 0.0
    for w in weights:
        acc += w
        out.append(inclusive_threshold(acc))
    return out


def choice(b: Column, values: Sequence, weights: Sequence[float] | None = None) -> Column:
    """Weighted choice: first value whose running weight reaches u = b/10**6;
    the first value when none does (the source system's fallback)."""
    if weights is None:
        weights = [1.0 / len(values)] * len(values)
    cuts = cumulative_thresholds(weights)
    expr = None
    for v, t in zip(values, cuts):
        cond = b <= F.lit(t)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(values[0]))


def choice_sql(b: str, values: Sequence, weights: Sequence[float] | None = None) -> str:
    """SQL text of :func:`choice` (for the oracle and for spark.sql users)."""
    if weights is None:
        weights = [1.0 / len(values)] * len(values)
    cuts = cumulative_thresholds(weights)
    parts = [f"WHEN {b} <= {t} THEN {sql_lit(v)}" for v, t in zip(values, cuts)]
    return f"(CASE {' '.join(parts)} ELSE {sql_lit(values[0])} END)"


def count_below(b: Column, cuts: Sequence[int]) -> Column:
    """Number of (non-decreasing) cut points strictly below b, i.e. the index
    of the first cut with b <= cut (inverse-CDF sampling).

    A balanced CASE tree: log2(len(cuts)) comparisons per row, and ``b``
    stays a plain common subexpression (inside a higher-order-function
    lambda the hash would be recomputed for every array element)."""
    cuts = [int(t) for t in cuts]

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(b <= F.lit(cuts[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(cuts)).cast("int")


def count_below_sql(b: str, cuts: Sequence[int]) -> str:
    arr = ", ".join(str(int(t)) for t in cuts)
    return f"CAST(len(list_filter([{arr}], lambda t: t < {b})) AS INTEGER)"


def uniform_decimal(b: Column, lo: str, hi: str, scale: int = 6) -> Column:
    """lo + (hi - lo) * b / 10**6 in exact decimal arithmetic."""
    step = (Decimal(hi) - Decimal(lo)) * Decimal("0.000001")
    return (F.lit(Decimal(lo)) + b.cast("decimal(20,0)") * F.lit(step)).cast(f"decimal(20,{scale})")


def uniform_decimal_sql(b: str, lo: str, hi: str, scale: int = 6) -> str:
    step = (Decimal(hi) - Decimal(lo)) * Decimal("0.000001")
    return f"CAST({Decimal(lo)} + CAST({b} AS DECIMAL(20,0)) * {step} AS DECIMAL(20,{scale}))"


def randint(b: Column, lo: int, hi: int) -> Column:
    """Inclusive integer draw lo..hi."""
    return (F.lit(lo) + (b % F.lit(hi - lo + 1))).cast("int")


def sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)
