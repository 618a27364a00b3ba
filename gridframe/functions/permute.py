"""Keyed permutations of the numbers 0..n-1 by arithmetic alone.

A number is cut into two digits that a network of rounds mixes: each round adds a hash of one digit to the other,
modulo that digit's size, and changes their places. Every round can be undone, so the network permutes its square of
digits; a number that leaves 0..n-1 goes through it again until it is back. No row is sorted, ranked or moved.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridframe.functions.arrays import _col, int_div

ROUNDS = 6
#: Odd factor of the hash; small enough that 32-bit digits never leave a bigint.
FACTOR = 73244475
_LOW = (1 << 32) - 1
#: Further passes a number may need. The square has less than one row of digits too many, so a pass is needed again
#: with a chance of at most one in the root of n, and beyond the bound the job fails rather than give a wrong number.
PASSES = 64


def digits(n: int) -> tuple[int, int]:
    """Sizes of the two digits: the least square, or nearly, that holds n numbers."""
    wide = isqrt(max(n - 1, 0)) + 1
    return -(-max(n, 1) // wide), wide


def round_keys(*key) -> list[int]:
    """One number of 32 bits per round from the key (seed, epoch, ...)."""
    name = "-".join(map(str, key))
    return [int(hashlib.md5(f"{name}-{r}".encode()).hexdigest()[:8], 16) for r in range(ROUNDS)]


def _mixed(digit: Column, key: Column) -> Column:
    h = (digit + key).bitwiseAND(F.lit(_LOW))
    h = (h * F.lit(FACTOR)).bitwiseAND(F.lit(_LOW))
    h = (h.bitwiseXOR(F.shiftright(h, 16)) * F.lit(FACTOR)).bitwiseAND(F.lit(_LOW))
    return h.bitwiseXOR(F.shiftright(h, 16))


def _pass(number: Column, n: int, keys: list[int], back: bool) -> Column:
    """The network once, forwards or backwards."""
    tall, wide = digits(n)
    start = F.struct(int_div(number, wide).alias("x"), (number % wide).alias("y"), F.lit(tall).cast("long").alias("a"), F.lit(wide).cast("long").alias("b"))
    order = F.array(*[F.lit(k).cast("long") for k in (reversed(keys) if back else keys)])

    def forward(s: Column, key: Column) -> Column:
        moved = (s["x"] + _mixed(s["y"], key)) % s["a"]
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    def backward(s: Column, key: Column) -> Column:
        moved = F.pmod(s["y"] - _mixed(s["x"], key), s["b"])
        return F.struct(moved.alias("x"), s["x"].alias("y"), s["b"].alias("a"), s["a"].alias("b"))

    return F.aggregate(order, start, backward if back else forward, lambda s: s["x"] * wide + s["y"])


def _walked(number: Column, n: int, key: tuple, back: bool) -> Column:
    keys = round_keys(*key)
    lost = F.raise_error(F.lit(f"no place below {n} after {PASSES} passes")).cast("long")
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(PASSES)),
        _pass(number, n, keys, back),
        lambda at, _: F.when(at < n, at).otherwise(_pass(at, n, keys, back)),
        lambda at: F.when(at < n, at).otherwise(lost),
    )
    beyond = F.raise_error(F.concat(F.lit(f"not one of {n} positions: "), number.cast("string"))).cast("long")
    return F.when(number.isNull(), F.lit(None).cast("long")).when((number < 0) | (number >= n), beyond).otherwise(again)


def permuted(position: str | Column, n: int, *key) -> Column:
    """The place of each of the positions 0..n-1 in the random order of the key; null stays null, others fail."""
    return _walked(_col(position).cast("long"), n, key, False)


def unpermuted(place: str | Column, n: int, *key) -> Column:
    """The position that has a place in the random order of the key."""
    return _walked(_col(place).cast("long"), n, key, True)
