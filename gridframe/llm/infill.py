"""Fill-in-middle transformation: lines of a text dealt into prefix, middle and suffix around sentinels.

One ``fullmatch`` of a repeated group keeps every repetition, so the ends of its captures are the ends of all units:
their number is the number of units, and the two cuts are looked up in them.
"""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A line with its end, or the rest of the text. Units tile any text in one way.
UNITS = regex.compile(r"([^\n]*\n|[^\n]+)*")

#: Code points of one match: the captures of some more million units would pass the memory the library allows a match.
MOST_CHARS = 2_000_000

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")])


def unit_ends(text: str) -> list[int]:
    """Where each unit ends, in code points. A longer text than a match may hold is matched in parts of whole units."""
    if len(text) <= MOST_CHARS:
        return UNITS.fullmatch(text).ends(1)
    ends, start = [], 0
    while start < len(text):
        stop = text.rfind("\n", start, start + MOST_CHARS) + 1 or text.find("\n", start) + 1 or len(text)
        ends += UNITS.fullmatch(text, start, stop).ends(1)
        start = stop
    return ends


def cuts(text: str, one: int, other: int) -> tuple[int, int, int]:
    """Number of units, and the offsets in code points after ``one % (n + 1)`` and ``other % (n + 1)`` units, in order."""
    ends = unit_ends(text)
    n = len(ends)
    low, high = sorted((one % (n + 1), other % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


@F.pandas_udf(_CUTS)
def _cuts(text: pd.Series, one: pd.Series, other: pd.Series) -> pd.DataFrame:
    rows = [cuts(*row) for row in zip(text, one, other)]
    return pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")


def draw(doc_id: str, seed: int, group: int) -> Column:
    """The ``group``-th 8-digit group of the hex SHA-256 of ``seed:doc_id`` as an unsigned number; a null id is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``docs`` (with ``doc_id, text``) and ``n, form, prefix_chars, middle_chars, output``.

    The units of a text are its lines with their ends. The prefix ends after the smaller of two drawn numbers of units,
    the middle after the larger, and the suffix is the rest; any of them may be empty. ``form`` is ``plain`` for an empty
    or null text, for one that holds a sentinel, and for ``100 - percent`` of a hundred; of the others ``spm_percent`` of
    a hundred are ``spm``, the rest ``psm``. ``prefix_chars`` and ``middle_chars`` are code points, null in the plain
    form. All draws depend on seed and id alone, so rows that repeat come out equal; a null id is drawn as an empty one.
    Columns of the five names are replaced. No row moves between tasks.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = docs.drop(*made)
    text = F.coalesce(F.col("text"), F.lit(""))
    units = kept.withColumn("_cut", _cuts(text, draw("doc_id", seed, 1), draw("doc_id", seed, 2)))
    marked = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(sentinel))
    plain = (text == "") | marked | (draw("doc_id", seed, 3) % 100 >= percent)
    form = F.when(plain, "plain").when(draw("doc_id", seed, 4) % 100 < spm_percent, "spm").otherwise("psm")
    formed = units.withColumn("_form", form)
    first, second = F.col("_cut.first").cast("int"), F.col("_cut.second").cast("int")
    prefix = F.substring(text, F.lit(1), first)
    middle = F.substring(text, first + 1, second - first)
    suffix = F.substring(text, second + 1, F.length(text))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    cut = F.col("_form") != "plain"
    return formed.select(
        *[F.col(f"`{c}`") for c in kept.columns], F.col("_cut.n").alias("n"), F.col("_form").alias("form"),
        F.when(cut, F.col("_cut.first")).alias("prefix_chars"),
        F.when(cut, F.col("_cut.second") - F.col("_cut.first")).alias("middle_chars"),
        F.when(F.col("_form") == "psm", psm).when(F.col("_form") == "spm", spm).otherwise(text).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed one came from. Sentinels cannot overlap each other, and no cut text holds one, so the
    first sentinel of each kind is the one that was put in."""
    last = F.substring_index(output, MIDDLE, -1)
    before = F.substring_index(output, MIDDLE, 1)
    # In both forms the first part lies between the sentinel at the start and the second sentinel.
    head = lambda second: F.substring(F.substring_index(before, second, 1), F.lit(len(PREFIX) + 1), F.length(before))
    psm = F.concat(head(SUFFIX), last, F.substring_index(before, SUFFIX, -1))
    spm = F.concat(F.substring_index(before, PREFIX, -1), last, head(PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
