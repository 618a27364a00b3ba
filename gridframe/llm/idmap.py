"""A bit map of bounded size that tells for sure which ids are not in a table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per id, and at most (32 MB).
BITS_PER_ID, MOST_BITS = 16, 1 << 28
_CHUNK = 1 << 15


@dataclass(frozen=True)
class IdMap:
    """One bit per place; ids have the place of their hash. An id whose bit is off is not in the table."""

    bits: int
    packed: np.ndarray

    def place(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.bits))

    def holds(self, places: np.ndarray) -> np.ndarray:
        return ((self.packed[places >> 3] >> (places & 7).astype("uint8")) & 1).astype(bool)

    def may_hold(self, column: str) -> Column:
        """False where the id is not in the table; true for its ids and, by chance, a few others. Ids are not null."""

        @F.pandas_udf("boolean")
        def lookup(places: pd.Series) -> pd.Series:
            return pd.Series(self.holds(places.to_numpy()))

        return lookup(self.place(column))


def id_map(ids: DataFrame, column: str = "doc_id") -> IdMap:
    """The map of a table's ids, built in parts of 4 KB by an aggregate.

    Its size follows the number of ids up to a fixed bound, where it tells less; what it says stays true.
    """
    wish = BITS_PER_ID * max(ids.count(), 1)
    bits = min(MOST_BITS, max(_CHUNK, 1 << (wish - 1).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    parts = ids.groupBy(F.bitmap_bucket_number(place).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("part"))
    packed = np.zeros(bits // 8, dtype="uint8")
    for row in parts.collect():
        start = (row["n"] - 1) * (_CHUNK // 8)
        packed[start : start + _CHUNK // 8] = np.frombuffer(row["part"], dtype="uint8")
    return IdMap(bits, packed)
