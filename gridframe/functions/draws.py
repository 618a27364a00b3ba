"""Reproducible random keys and draws from a hash of (seed, id)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridframe.functions.arrays import _col


def hash_key(row_id, seed) -> Column:
    """A uniformly spread sort key; the order by it is a random permutation fixed by the seed."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), _col(row_id).cast("string")))


def uniform_draw(row_id, seed, name: str) -> Column:
    """A number in [0, 1): the first eight hex digits of the hash over 2**32."""
    text = F.md5(F.concat_ws("-", F.lit(str(seed)), F.lit(name), _col(row_id).cast("string")))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def normal_draw(row_id, seed, name: str) -> Column:
    """A standard normal number from two uniform draws (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform_draw(row_id, seed, name)))
    return radius * F.cos(F.lit(6.283185307179586) * uniform_draw(row_id, seed, name + "'"))
