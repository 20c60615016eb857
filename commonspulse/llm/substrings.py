"""Repeated passages by relative Lempel-Ziv parsing against an index of every reference block.

All documents, dealt into blocks of bounded text, are reference.  Each block indexes the windows of ``WIDTH`` words of its
documents: their distinct hashes in order, each with the smallest ``doc_id`` that has it.  The index of all blocks is
parted by hash; a part merges what every block sent and tells each block, for its own windows, the first document
anywhere that has them.  Each document is then parsed greedily from left to right: a factor goes on as long as its
windows stand in the same earlier document; where it ends, the windows across its boundary are checked against the
index again, so a passage that goes on in another document starts the next factor without a gap.  The words of factors
are the duplicate spans.

A block sends a window once however often its documents repeat it, so a passage in many documents is one entry a block.

Defined cases: a null text has no words; a document of fewer words than a window keeps all; documents with equal
``doc_id`` do not count against each other; null ``doc_id`` comes first; further columns are left out; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import hash_strings, inside, owners, read, tokens, window_hashes

WIDTH = 13
BLOCK_CHARS = 4 << 20  # of a block's text, about
_FIRST = -(1 << 63)
_RESULT = "doc_id long, n_words long, n_removed long, kept string, factors array<struct<start:int,length:int,reference:long>>"


def _pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def _indexed(table: pa.Table, width: int) -> tuple[pa.Table, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows in order of document, their words and bounds, and hash and document of each window."""
    table = table.sort_by([("doc", "ascending"), ("text", "ascending")]).combine_chunks()
    words, bounds = tokens(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
    hashes = window_hashes(hash_strings(words), width)[inside(bounds, width)]
    return table, words, bounds, hashes, table["doc"].to_numpy()[owners(bounds, width)]


def _smallest(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, each with its smallest document."""
    order = np.lexsort((docs, hashes))
    hashes, docs = hashes[order], docs[order]
    new = np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]])
    return hashes[new], docs[new]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _send(width: int, buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """A block's index, one row for each part of the hashes."""
    def send(key: tuple, table: pa.Table) -> pa.Table:
        *_, hashes, docs = _indexed(table, width)
        hashes, docs = _smallest(hashes, docs)
        part = _bucket(hashes, buckets)
        rows = [(b, at) for b in np.unique(part) if len(at := np.flatnonzero(part == b))]
        return pa.table({
            "block": pa.array([key[0].as_py()] * len(rows), pa.int32()), "part": pa.array([int(b) for b, _ in rows], pa.int32()),
            "hashes": pa.array([_pack(_steps(hashes[at])) for _, at in rows], pa.binary()),
            "docs": pa.array([_pack(docs[at]) for _, at in rows], pa.binary()),
        })

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For each block's windows of a part: which stand in an earlier document elsewhere, and in which first."""
    rows = table.to_pylist()
    hashes = [np.cumsum(_unpack(r["hashes"]).astype(np.uint64), dtype=np.uint64) for r in rows]
    docs = [_unpack(r["docs"]) for r in rows]
    known, first = _smallest(np.concatenate(hashes), np.concatenate(docs))
    marks, refs = [], []
    for h, d in zip(hashes, docs, strict=True):
        found = first[np.searchsorted(known, h)]
        marks.append(zstandard.compress(np.packbits(found < d).tobytes(), 1))
        refs.append(_pack(found[found < d]))
    return pa.table({"block": table["block"], "part": table["part"], "marks": pa.array(marks, pa.binary()), "refs": pa.array(refs, pa.binary())})


def factors(reference: np.ndarray, found: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy factors (start, length, reference) of a text from what the index says of each of its windows."""
    places = np.flatnonzero(found)
    if not len(places):
        return []
    go_on = (np.diff(places) == 1) & (reference[places][1:] == reference[places][:-1])
    starts = np.flatnonzero(np.concatenate([[True], ~go_on]))
    ends = np.append(starts[1:], len(places)) - 1
    return [(int(places[a]), int(places[b] - places[a] + width), int(reference[places[a]])) for a, b in zip(starts, ends, strict=True)]


def _parse(width: int, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Parse a block's documents with the answers of all parts."""
    def parse(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, words, bounds, hashes, docs = _indexed(table, width)
        known, first = _smallest(hashes, docs)
        part, order = _bucket(known, buckets), []
        for row in answers.to_pylist():
            at = np.flatnonzero(part == row["part"])
            earlier = np.unpackbits(np.frombuffer(zstandard.decompress(row["marks"]), np.uint8))[:len(at)].astype(bool)
            order.append((at[earlier], _unpack(row["refs"])))
        for at, refs in order:
            first[at] = refs
        reference = first[np.searchsorted(known, hashes)]
        found = reference < docs
        counts = np.maximum(np.diff(bounds) - width + 1, 0)
        edges = np.concatenate([[0], np.cumsum(counts)])
        texts, removed, spans = [], [], []
        for row in range(table.num_rows):
            own = slice(edges[row], edges[row + 1])
            parts = factors(reference[own], found[own], width)
            keep = np.ones(bounds[row + 1] - bounds[row], bool)
            for start, length, _ in parts:
                keep[start:start + length] = False
            removed.append(int((~keep).sum()))
            kept = words.slice(bounds[row], len(keep))
            texts.append(" ".join((kept.filter(pa.array(keep)) if removed[-1] else kept).to_pylist()))
            spans.append([{"start": s, "length": n, "reference": None if r == _FIRST else r} for s, n, r in parts])
        return pa.table({
            "doc_id": table["doc_id"], "n_words": pa.array(np.diff(bounds), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(texts, pa.string()),
            "factors": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("reference", pa.int64())])))})

    return parse


def remove_repeats(docs: DataFrame, width: int = WIDTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document its words, how many are removed, the kept text, and the factors that were found elsewhere."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-chars // block_chars))
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("doc"),
        F.col("text").cast("string").alias("text"))
    sent = dealt.groupBy("block").applyInArrow(_send(width, parts), "block int, part int, hashes binary, docs binary")
    answers = sent.groupBy("part").applyInArrow(_answer, "block int, part int, marks binary, refs binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_parse(width, parts), _RESULT)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("factors").alias("n_factors"))


OP8_SQL = f"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + {WIDTH - 1}], ' ') as k
            from (select doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) as i from d)),
firsts as (select k, min(doc_id) as f from windows group by k),
found as (select doc_id, i, f from windows join firsts using (k) where f < doc_id),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + {WIDTH})) as p from found)),
runs as (select doc_id, count(*) as n from (select doc_id, i, f, lag(i) over o as pi, lag(f) over o as pf from found window o as (partition by doc_id order by i))
         where pi is null or pi <> i - 1 or pf <> f group by 1),
kept as (select doc_id, string_agg(x, ' ' order by p) as t, count(*) as n
         from (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d) anti join gone using (doc_id, p) group by 1)
select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256,
       cast(coalesce(runs.n, 0) as integer) as n_factors
from d left join kept using (doc_id) left join runs using (doc_id)
"""

QUERIES = {"op8_substrings": op8_substrings}
ORACLES = {"op8_substrings": OP8_SQL}
