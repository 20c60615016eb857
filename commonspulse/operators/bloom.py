"""Bloom filter over many target ids, tested on rows before they are shuffled.

With millions of targets Spark can no longer send the ids themselves to every
task.  The filter is an array of 64-bit words of a size the caller bounds; it
may let strangers pass, never a target, so an exact semi-join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions each id sets.
HASHES = 4


def _positions(value: Column, words: int) -> list[Column]:
    bits = words * 64
    return [F.pmod(F.xxhash64(F.lit(seed), value), F.lit(bits)) for seed in range(HASHES)]


def bloom_words(ids: DataFrame, column: str, megabytes: float) -> DataFrame:
    """One row, ``words``: the filter of the non-null ids, ``megabytes`` large whatever their number.

    Ten bits an id let about one stranger in a hundred pass, so 8 MB serve some
    six million ids; more ids make the filter weaker, not wrong.
    """
    words = max(1, int(megabytes * 1024 * 1024) // 8)
    places = ids.where(F.col(column).isNotNull()).select(F.explode(F.array(*_positions(F.col(column), words))).alias("bit"))
    filled = places.groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    whole = ids.sparkSession.range(words).withColumnRenamed("id", "word").join(filled, "word", "left")
    entry = F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return whole.agg(F.array_sort(F.collect_list(entry))["bits"].alias("words"))


def might_hold(words: DataFrame, value: Column, megabytes: float) -> Column:
    """False only where the filter of ``megabytes`` does not hold ``value``; null values are not held."""
    count = max(1, int(megabytes * 1024 * 1024) // 8)
    held = words.scalar()
    hit = F.lit(True)
    for place in _positions(value, count):
        word = F.get(held, F.floor(place / 64).cast("int"))
        hit = hit & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
    return F.coalesce(hit & value.isNotNull(), F.lit(False))
