"""Byte-level BPE by public ranks: each distinct word of the corpus is encoded once, ids are joined back by position.

Words are cut in the tasks that read the texts and numbered within blocks of bounded size.  A block's positions stay in
one packed row; its distinct words go, packed by word hash, to the bucket that owns the hash.  A task goes through its
buckets one after the other, all blocks' words of a bucket in a row, and encodes every distinct word of the corpus once; the
ids return to the blocks, and each block puts its texts together by position.  Decoding joins the table of token bytes.

What a task remembers are the distinct words of one bucket.  Distinct words grow about as the root of a text does, and so
does the number of buckets (``BUCKET_CHARS``); a block sends one row a bucket.

Defined cases: a null text counts as empty; an empty text has no ids; repeated rows and null or repeated ``doc_id`` are
encoded each for itself; further columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from commonspulse.llm.common import lists_of, pieces, read, saved

BLOCK_WORDS = 2 << 20  # words of a block; more only if one text has more
BUCKET_CHARS = 1 << 9  # the root of all characters over this is the number of buckets, if more than the shuffle's partitions
NARROW = 192  # packed numbers below take one byte
WIDE = NARROW + ((255 - NARROW) << 8)  # and below this one two
_LISTS = pa.list_(pa.int32())


def ranks(path: str) -> dict[bytes, int]:
    """Rank file: base64 of a token's bytes and its id on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 9)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_places(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, most of them small: first bytes, second bytes and what is beyond two bytes, each compressed."""
    two, wide = (numbers >= NARROW) & (numbers < WIDE), numbers >= WIDE
    first = np.where(numbers < NARROW, numbers, np.where(two, NARROW + ((numbers - NARROW) >> 8), 255)).astype(np.uint8)
    parts = [zstandard.compress(x.tobytes(), 12) for x in (first, ((numbers[two] - NARROW) & 255).astype(np.uint8))]
    return b"".join([*(len(x).to_bytes(4, "little") for x in parts), *parts, _pack(numbers[wide] - WIDE)])


def _unpack_places(packed: bytes) -> np.ndarray:
    a = 8 + int.from_bytes(packed[:4], "little")
    b = a + int.from_bytes(packed[4:8], "little")
    first, second = (np.frombuffer(zstandard.decompress(x), np.uint8).astype(np.int64) for x in (packed[8:a], packed[a:b]))
    numbers, two = first.copy(), (first >= NARROW) & (first < 255)
    numbers[two] = NARROW + ((first[two] - NARROW) << 8) + second
    numbers[first == 255] = WIDE + _unpack(packed[b:]).astype(np.int64)
    return numbers


def _pack_words(words: list[str]) -> bytes:
    raw = [w.encode() for w in words]
    sizes = _pack(np.fromiter(map(len, raw), np.uint32, len(raw)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(raw), 15)


def _unpack_words(packed: bytes) -> list[str]:
    split = 4 + int.from_bytes(packed[:4], "little")
    sizes, raw = _unpack(packed[4:split]), zstandard.decompress(packed[split:])
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [raw[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]


def _cut(pattern: str, buckets: int, block_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row a block with its documents and places (bucket null), one a bucket with the block's words of that hash.

    Words are numbered by falling frequency, so that places pack well, and words that occur once in the order of their
    places, where 0 stands for the next of them; ``buckets`` has each number's bucket.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, task = regex.compile(pattern, regex.V1).findall, TaskContext.get().partitionId()
        number, known, docs, counts, places = task << 24, {}, [], [], []

        def block() -> pa.RecordBatch:
            at = np.concatenate([*places, np.zeros(0, np.uint32)])
            times = np.bincount(at, minlength=len(known))
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(known), np.int64)
            place[order] = np.where(times[order] > 1, np.arange(1, len(known) + 1), 0)
            words = list(known)
            owned: dict[int, list[str]] = {}
            bucket = np.empty(len(known), np.uint32)
            for k, i in enumerate(order.tolist()):
                bucket[k] = b = xxhash.xxh3_64_intdigest(words[i]) % buckets
                owned.setdefault(b, []).append(words[i])
            size, full = len(owned), sorted(owned)
            return pa.RecordBatch.from_arrays([
                pa.array([number] * (size + 1), pa.int64()), pa.array([None, *full], pa.int32()),
                pa.array([docs, *[None] * size], pa.list_(pa.int64())), pa.array([counts, *[None] * size], pa.list_(pa.int32())),
                pa.array([_pack(bucket), *[None] * size], pa.binary()),
                pa.array([_pack_places(place[at]), *(_pack_words(owned[b]) for b in full)], pa.binary()),
            ], ["block", "bucket", "docs", "counts", "buckets", "data"])

        words = 0
        for batch in pieces(batches, most=2 << 20):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = find(text or "")
                places.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.uint32, len(found)))
                docs.append(doc)
                counts.append(len(found))
                words += len(found)
                if words >= block_words:
                    yield block()
                    number, known, docs, counts, places, words = number + 1, {}, [], [], [], 0
        if docs:
            yield block()

    return blocks


def _encode_words(path: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number of ids and ids of each word of a (block, bucket), rows in order of bucket: a bucket's words are encoded once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        known: dict[str, tuple[int, ...]] = {}
        current = None
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column("bucket")[row].as_py()
                if bucket != current:
                    current, known = bucket, {}
                found = []
                for word in _unpack_words(batch.column("data")[row].as_py()):
                    ids = known.get(word)
                    if ids is None:
                        single = table.get(word.encode())
                        ids = known[word] = (single,) if single is not None else tuple(coder.encode_ordinary(word))
                    found.append(ids)
                sizes = np.fromiter(map(len, found), np.uint32, len(found))
                flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
                yield pa.RecordBatch.from_arrays([
                    batch.column("block").slice(row, 1), batch.column("bucket").slice(row, 1),
                    pa.array([_pack(sizes)], pa.binary()), pa.array([_pack(flat)], pa.binary()),
                ], ["block", "bucket", "sizes", "ids"])

    return encode


def _assemble(block: pa.Table, coded: pa.Table) -> pa.Table:
    """Ids of a block's documents, by position."""
    coded = coded.sort_by("bucket")
    sizes = [_unpack(x) for x in coded["sizes"].to_pylist()]
    ids = [_unpack(x) for x in coded["ids"].to_pylist()]
    none = np.zeros(0, np.uint32)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes or [none]), dtype=np.int64)])
    words = lists_of(pa.array(np.concatenate(ids or [none]).astype(np.int32)), bounds)
    docs, parts = [], []
    for row in block.to_pylist():
        moved = np.empty(len(words), np.uint32)  # word numbers to places among the buckets' words
        moved[np.argsort(_unpack(row["buckets"]), kind="stable")] = np.arange(len(words))
        numbers = _unpack_places(row["data"])
        once = np.flatnonzero(numbers == 0)  # each stands for the next word that occurs once
        numbers[once] = len(words) - len(once) + 1 + np.arange(len(once))
        at = moved[numbers - 1]
        ends = np.concatenate([[0], np.cumsum(row["counts"], dtype=np.int64)])
        start = 0
        while start < len(row["docs"]):  # a few documents at a time: 32-bit offsets of lists hold
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + (1 << 20), side="right")) - 1)
            chosen = words.take(pa.array(at[ends[start]:ends[stop]]))
            parts.append(lists_of(chosen.flatten(), chosen.offsets.to_numpy()[ends[start:stop + 1] - ends[start]]))
            docs.append(pa.array(row["docs"][start:stop], pa.int64()))
            start = stop
    return pa.table({"doc_id": pa.chunked_array(docs, pa.int64()), "ids": pa.chunked_array(parts, _LISTS)})


def _cut_and_coded(docs: DataFrame, path: str, pattern: str, block_words: int) -> PandasCogroupedOps:
    """The blocks, each with the ids of its words."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string"))).alias("n")).first()["n"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.isqrt(chars) // BUCKET_CHARS)
    cut = saved(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _cut(pattern, buckets, block_words),
        "block long, bucket int, docs array<long>, counts array<int>, buckets binary, data binary"), "bpe-blocks")
    coded = (cut.filter("bucket is not null").select("block", "bucket", "data")
             .repartition(buckets, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_encode_words(path, pattern), "block long, bucket int, sizes binary, ids binary"))
    return (cut.filter("bucket is null").select("block", "docs", "counts", "buckets", "data").groupBy("block")
            .cogroup(coded.groupBy("block")))


def encode(docs: DataFrame, path: str, pattern: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, as the rank file's library gives them without special tokens."""
    return _cut_and_coded(docs, path, pattern, block_words).applyInArrow(_assemble, "doc_id long, ids array<int>")


def _decoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        tokens: list[bytes | None] = [None] * (max(table.values(), default=-1) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        known = pa.array(tokens, pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lists = part.column("ids")
                chosen = known.take(lists.flatten())
                ends = np.frombuffer(chosen.buffers()[1], np.int32, len(chosen) + 1)
                bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
                whole = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(np.ascontiguousarray(bounds)), chosen.buffers()[2]])
                yield pa.RecordBatch.from_arrays([*part.columns, whole], [*part.schema.names, "bytes"])

    return decoded


def decode(coded: DataFrame, path: str) -> DataFrame:
    """Adds ``bytes``: the token bytes of ``ids``, joined."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(_decoded(path), f"{schema}, bytes binary")


def encode_and_decode(docs: DataFrame, path: str, pattern: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``decode`` of ``encode`` in one Python step: two in a row are two Python workers a core, which the executor keeps."""
    decoded = _decoded(path)

    def both(block: pa.Table, coded: pa.Table) -> pa.Table:
        return pa.Table.from_batches(decoded(_assemble(block, coded).to_batches()),
                                     pa.schema([("doc_id", pa.int64()), ("ids", _LISTS), ("bytes", pa.binary())]))

    return _cut_and_coded(docs, path, pattern, block_words).applyInArrow(both, "doc_id long, ids array<int>, bytes binary")


def _public() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number and digest of its ids and the digest of the bytes they decode to."""
    path, pattern = _public()
    return encode_and_decode(docs, path, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
ORACLES: dict[str, str] = {}
