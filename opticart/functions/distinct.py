"""Exact distinct counts of integer ids as mergeable bitmaps.

``COUNT(DISTINCT id)`` shuffles every (group, id). Ids that lie close together fill
64-bit words: per (group, id div 64) one word holds them, ``bit_or`` merges words of
all tasks, and the count is the sum of their bits. A word is never more than a pair
of group and id was, and up to 64 times less. Unlike a bitmap of fixed size per
group and task, sparse ids cost no more than themselves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_of(id_col: str) -> Column:
    """The word an id falls into; NULL for NULL."""
    return F.shiftright(id_col, 6)


def bits_of(id_col: str) -> Column:
    """Aggregate: the ids of one word as bits."""
    return F.bit_or(F.expr(f"shiftleft(1L, cast({id_col} & 63 AS int))"))


def count_bits(bits: str) -> Column:
    """Aggregate over words: the number of different ids."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("bigint")
