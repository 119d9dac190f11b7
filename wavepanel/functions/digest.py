"""Digests of line sequences that depend on the order of the lines and can be
computed in parts.

A sequence of line hashes h(0), h(1), ... has the digest ``sum h(i) * B^i``
modulo the prime 2^61 - 1.  The digest of two parts joined is the first one
plus the second times ``B^(lines of the first)``, so each split of a file is
digested where it is read, and only one row per split travels.  Two different
sequences of n lines share a digest with a probability of about n / 2^61.

Everything is 64-bit integer arithmetic in Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 61) - 1
# Any number above 256 does; it must never change, or stored digests are void.
BASE = 1_236_347_781_126_549_031
# Bits of a place that one table of powers looks up, and tables.
TABLE_BITS, TABLES = 9, 4


def mulmod(a: Column, b: Column) -> Column:
    """a * b modulo 2^61 - 1, for a and b below it, without overflow.

    With 31-bit halves the partial products fit a long; 2^61 counts as 1.
    """
    low = F.lit((1 << 31) - 1)
    a1, a0 = F.shiftright(a, 31), a.bitwiseAND(low)
    b1, b0 = F.shiftright(b, 31), b.bitwiseAND(low)
    middle = a1 * b0 + a0 * b1
    folded = (a1 * b1 * 2 + F.shiftright(middle, 30)
              + F.shiftleft(middle.bitwiseAND(F.lit((1 << 30) - 1)), 31))
    return (folded % PRIME + (a0 * b0) % PRIME) % PRIME


def _table(step: int) -> Column:
    """B^(0 * step), B^(1 * step), ... as a constant array."""
    base, powers = pow(BASE, step, PRIME), [1]
    for _ in range((1 << TABLE_BITS) - 1):
        powers.append(powers[-1] * base % PRIME)
    return F.split(F.lit(",".join(map(str, powers))), ",").cast("array<bigint>")


def with_power_times(df: DataFrame, place: str, factor: str, out: str) -> DataFrame:
    """Adds ``out``: factor * B^place for places below 2^36.

    One look-up and one product for each nine bits; each product is a
    projection of its own, so that it is not computed again wherever the next
    one names it.
    """
    mask = F.lit((1 << TABLE_BITS) - 1)
    parts = {f"_wp_p{k}": F.get(_table(1 << (TABLE_BITS * k)),
                                F.shiftright(place, TABLE_BITS * k).bitwiseAND(mask).cast("int"))
             for k in range(TABLES)}
    df = df.withColumns(parts).withColumn("_wp_q", F.col(factor))
    for name in parts:
        df = df.withColumn("_wp_q", mulmod(F.col("_wp_q"), F.col(name)))
    return df.withColumnRenamed("_wp_q", out).drop(*parts)


def power_of_any(place: Column) -> Column:
    """B^place for any whole number, negative ones too, bit by bit (for tables
    of few rows)."""
    e = F.pmod(place, F.lit(PRIME - 1))
    squares = [BASE]
    for _ in range(60):
        squares.append(squares[-1] * squares[-1] % PRIME)
    bits = F.transform(F.split(F.lit(",".join(map(str, squares))), ",").cast("array<bigint>"),
                       lambda s, i: F.when(F.expr("0L") + F.call_function("shiftright", e, i) % 2 == 1, s)
                       .otherwise(F.lit(1).cast("long")))
    return F.aggregate(bits, F.lit(1).cast("long"), mulmod)


def line_hash(line: Column) -> Column:
    """60 bits of a line's MD5, plus one: no line counts as nothing."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long") + 1


def digest_in_order(hashes: list[int]) -> int:
    """The digest of a whole sequence, in plain Python (for small ones)."""
    out = 0
    for h in reversed(hashes):
        out = (out * BASE + h) % PRIME
    return out
