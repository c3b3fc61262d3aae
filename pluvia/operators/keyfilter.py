"""A Bloom filter of keys in DataFrame functions: rows that cannot have one of the keys leave where they are scanned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.session import materialise

#: Keys to one 64-bit word of the filter, each setting three of its bits: about one row in fifty passes by chance.
KEYS_PER_WORD = 4
#: The filter is broadcast, so beyond this many words none is used. A word is a row of 16 bytes.
MAX_WORDS = 1 << 20


def _word(on: Sequence[str], words: int) -> Column:
    return F.xxhash64(*on).bitwiseAND(F.lit(words - 1))


def _bits(on: Sequence[str]) -> Column:
    """Three bits of a word, from parts of the hash that its place does not use."""
    h = f"xxhash64({', '.join(f'`{c}`' for c in on)})"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned({h}, {shift}) & 63 as int))" for shift in (58, 52, 46)))


def passing(rows: DataFrame, keys: DataFrame, on: Sequence[str], max_words: int = MAX_WORDS) -> DataFrame:
    """The rows that may have one of ``keys``: all that have, and few others. Key columns must have the same types on both sides.

    ``keys`` may repeat; how many there are is estimated, for the size of the filter. It is made by one aggregation of the keys and met by a broadcast join on the word, so the rows are not shuffled. With too many keys
    for the filter to be broadcast, all rows pass; what follows must test the keys themselves in any case.
    """
    on = list(on)
    n = keys.agg(F.approx_count_distinct(F.xxhash64(*on)).alias("n")).first()["n"]
    words = 1 << max(6, (n // KEYS_PER_WORD).bit_length())
    if words > max_words:
        return rows
    filled = keys.groupBy(_word(on, words).alias("_word")).agg(F.bit_or(_bits(on)).alias("_bits"))
    met = rows.withColumns({"_word": _word(on, words), "_own": _bits(on)}).join(F.broadcast(materialise(filled, "filter")), "_word")
    return met.where(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own")).drop("_word", "_own", "_bits")
