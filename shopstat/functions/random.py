"""Counter-based random columns.

``rand(seed)`` depends on how rows are split into partitions; these columns do
not: every value is a pure function of (seed, salt, key), 53 bits of the MD5
digest of their text. Any engine with MD5 gives the same value, which is what lets
the generated tables be checked against an independent SQL statement. Keys of any
size and sign, and seeds of any size, have streams of their own. One digest serves
two salts (``2 n`` and ``2 n + 1``).

``with_hashes(df, key, seed, {name: salt})`` adds one hash column per salt;
``unit(h)`` turns a hash into a uniform double in (0, 1), from which the
distributions below are built. Use a different salt for every column drawn
from the same key. A null key gives null.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 53
HEX_DIGITS = 14  # 56 bits of the digest; the last three are dropped
TWO_PI = 6.283185307179586


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _digest(key: Column, seed: int, pair: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{pair}:"), key.cast("long").cast("string")))


def _bits(digest: Column, salt: int) -> Column:
    part = F.substring(digest, 1 + salt % 2 * HEX_DIGITS, HEX_DIGITS)
    return F.shiftright(F.conv(part, 16, 10).cast("long"), 4 * HEX_DIGITS - BITS)


def hash53(key, seed: int, salt: int) -> Column:
    """Integer in [0, 2^53) from an integer key, as one expression."""
    return _bits(_digest(_c(key), seed, salt // 2), salt)


def with_hashes(df: DataFrame, key: str, seed: int, salts: dict[str, int]) -> DataFrame:
    """Add one integer hash column (same values as ``hash53``) per entry of ``salts``; a
    digest that two salts share is computed once."""
    pairs = sorted({s // 2 for s in salts.values()})
    digests = df.select("*", *[_digest(F.col(key), seed, p).alias(f"_digest{p}") for p in pairs])
    return digests.select(*df.columns, *[_bits(F.col(f"_digest{s // 2}"), s).alias(n) for n, s in salts.items()])


def unit(h) -> Column:
    """Hash column -> uniform double in (0, 1)."""
    return F.least((_c(h).cast("double") + F.lit(0.5)) / F.lit(2.0**BITS), F.lit(1.0 - 2.0**-BITS))


def uniform(key, seed: int, salt: int) -> Column:
    """G2 base: uniform double in (0, 1) from a key."""
    return unit(hash53(key, seed, salt))


# The distributions below take a uniform (0, 1) column: ``unit(hash_col)`` or
# ``uniform(key, seed, salt)``.

# G2 — uniform real in [a, b)
def uniform_real(u: Column, a: float, b: float) -> Column:
    return F.lit(float(a)) + u * F.lit(float(b - a))


# G3 — uniform integer in [a, b) (b may be a column)
def uniform_int(u: Column, a: int, b) -> Column:
    span = (_c(b) if not isinstance(b, int) else F.lit(b)) - F.lit(a)
    return F.lit(a) + F.floor(u * span)


# G4 — uniform integer in [0, upper] with a per-row upper bound
def uniform_upto(u: Column, upper) -> Column:
    return F.floor(u * (_c(upper) + F.lit(1)))


# G5 — normal(mean, sd) by Box-Muller from two independent uniforms
def normal(u1: Column, u2: Column, mean: float, sd: float) -> Column:
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)
    return F.lit(float(mean)) + F.lit(float(sd)) * z


def poisson_cdf(lam: float) -> list[float]:
    """Cumulative probabilities P(X <= k) for k = 0, 1, ... until they reach 1."""
    out, p, acc, k = [], math.exp(-lam), 0.0, 0
    while True:
        acc += p
        if acc >= 1.0 or (k > lam and p < 1e-17):
            break
        out.append(acc)
        k += 1
        p *= lam / k
    return out


def array_literal(values: list) -> Column:
    """A literal array built by one SQL expression (one call into the JVM instead of
    one per element). Doubles are written with 17 significant digits, so they parse
    back to exactly the same values."""
    def text(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(v, float):
            return format(v, ".17e")
        return str(int(v))
    return F.expr("array(" + ", ".join(text(v) for v in values) + ")")


# G6 — Poisson(lam) by inverse CDF: the number of cumulative probabilities below u
def poisson(u: Column, lam: float = 50.0) -> Column:
    cdf = array_literal(poisson_cdf(lam))
    return F.size(F.filter(cdf, lambda c: c < u)).cast("long")


# G7 — Pareto(alpha) weights by inverse CDF: (1 - u)^(-1/alpha) - 1 + offset
# (offset 1.0 = classic Pareto with scale 1; a tiny offset keeps weights positive)
def pareto(u: Column, alpha: float = 1.5, offset: float = 1.0) -> Column:
    return F.pow(F.lit(1.0) - u, F.lit(-1.0 / alpha)) - F.lit(1.0) + F.lit(float(offset))


# G8 — categorical choice among literal values
def choice(u: Column, values: list) -> Column:
    return F.element_at(array_literal(values), (F.lit(1) + F.floor(u * F.lit(len(values)))).cast("int"))
