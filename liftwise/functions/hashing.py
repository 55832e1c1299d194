"""Keyed hashes: the only source of randomness, equal on every engine and rerun."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _leading_hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends only on the key and the seed."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return _leading_hex(text, 13) / F.lit(float(2**52))


def bucket(key: Column, n: int) -> Column:
    """A stable bucket in [0, n) for a key; any engine with md5 can recompute it."""
    return (_leading_hex(key.cast("string"), 8) % F.lit(n)).cast("int")


ROUNDS = 32
PRIME = 2**31 - 1
HALF = 2**30


def bijection(index: Column, n: int, seed: int) -> Column:
    """A keyed permutation of the numbers 0 to n - 1, for any n, row by row.

    A swap-or-not shuffle: each round pairs x with shift - x (mod n) and swaps the two if a
    keyed bit of the larger says so. Both partners see the same bit, so every round, and
    with it the whole, is one to one, and nothing has to be sorted to shuffle.
    """
    rounds = []
    for r in range(1, ROUNDS + 1):
        digits = md5(f"{seed}:{r}".encode()).hexdigest()
        parts = (int(digits[:13], 16) % n, int(digits[13:21], 16) % PRIME, int(digits[21:29], 16))
        rounds.append(F.array(*[F.lit(part).cast("bigint") for part in parts]))

    def swap(x: Column, key: Column) -> Column:
        partner = F.pmod(key[0] - x, F.lit(n))
        mixed = F.greatest(x, partner) % F.lit(PRIME) * key[1] + key[2]
        return F.when(mixed % F.lit(PRIME) < F.lit(HALF), partner).otherwise(x)

    return F.aggregate(F.array(*rounds), index.cast("bigint"), swap)


def row_digest(columns: list[str]) -> Column:
    """md5 of a row's values, each with its length so that values cannot run together."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("null")))
    return F.md5(F.concat_ws("|", *parts))


def digest_number(digest: Column, start: int) -> Column:
    """Fifteen hex digits of a digest, from the 1-based position, as a decimal to sum."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")
