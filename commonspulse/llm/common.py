"""Helpers shared by the operators on texts: tables, scratch tables, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.session import scratch_dir

PIECE_BYTES = 2 << 20  # text handled at once in a task
HOT_SHARE = 1 << 10  # a key with one in so many rows is hot; there are no more hot keys than that
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(frame: DataFrame, purpose: str) -> DataFrame:
    """Write below the shared scratch folder and read again: cuts the lineage, survives lost executors."""
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def looked_up(frame: DataFrame, table: DataFrame, key: str, narrow: Column | None = None) -> DataFrame:
    """Inner join of ``frame`` (read three times, so saved) with ``table``, which has one row a key.

    Hot keys, at most ``HOT_SHARE`` of them whatever the size of either side, meet their row by broadcast, so their rows
    stay where they are; all others are shuffled.  ``narrow`` tells rows of ``table`` that are small enough to be sent.
    """
    total = frame.count()
    counts = frame.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") * HOT_SHARE >= total).select(key)
    hot = (table if narrow is None else table.filter(narrow)).join(F.broadcast(counts), key, "left_semi")
    rest = frame.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key)
    return frame.join(F.broadcast(hot), key).unionByName(rest)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``frame`` does not have yet."""
    taken = {c.lower() for c in frame.columns}
    return [next(name for k in range(len(taken) + 1) if (name := f"{wanted}_{k}" if k else wanted) not in taken) for wanted in names]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            pa.default_memory_pool().release_unused()
            start = stop


def tokens(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between white space (blank and 09-0D) of all texts, and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    words, bounds = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), kept[bounds]


def hash_strings(words: pa.Array) -> np.ndarray:
    """64-bit hashes; each distinct string is hashed once."""
    coded = words.dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return known[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; texts are not told apart here."""
    count = max(0, len(hashes) - width + 1)
    out = np.full(count, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mixed(out * _ODD + hashes[i:i + count])
    return out


def inside(bounds: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` words lie in one text."""
    sizes = np.diff(bounds)
    counts = np.maximum(sizes - width + 1, 0)
    total = int(counts.sum())
    first = np.repeat(bounds[:-1], counts)
    return first + (np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts))


def owners(bounds: np.ndarray, width: int = 1) -> np.ndarray:
    """Number of the text that each place of ``inside`` belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.maximum(np.diff(bounds) - width + 1, 0))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists_of(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
