"""Token ids of all texts in a canonical, length-limited Huffman code, in blocks that decode by themselves.

Format (a table of blocks, written and read by Spark): a block holds the ids of consecutive documents of ascending
``doc_id``; ``start`` counts the ids of all blocks before it; ``bits`` are the codes, most significant bit first; every
``STRIDE`` ids a checkpoint gives the bit where decoding can begin.  The code book lies beside the blocks as (id,
length); codes follow from the lengths in canonical order.

The tokenizer is given parts of words, each once as long as a Python worker remembers it.  The code is made from counts
over the whole corpus, at most one row per id of the vocabulary.  Decoding looks up
``LIMIT`` bits at once in one table and steps through all checkpoints of a block together.

Defined cases: a null text counts as empty and has the end id only; documents with equal or null ``doc_id`` are each
written (nulls first, ties by text); further columns are left out; an empty table gives an empty file.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import lists_of, pieces, read, saved
from commonspulse.session import scratch_dir

LIMIT = 16  # longest code in bits
STRIDE = 256  # ids between checkpoints
BLOCK_IDS = 1 << 18  # ids after which a block ends, at the end of a document
AT_ONCE = 4096  # words given to the tokenizer at once
MEMO_PARTS = 1 << 19  # parts of words a Python worker remembers at most; beyond, a part is encoded again
TOGETHER = 256  # parts of letters that are one text for the tokenizer
TEXT_BYTES = 4 << 20  # of a piece whose distinct words are encoded together
END_ID = 1
_UNCOMBINED = r"^[\x00-\x7F\x{80}-\x{12F}\x{131}-\x{2FF}]*$"  # without U+0130, which becomes two characters
_LETTER, _MARK = r"[a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]", r"[!-&(-/:-@\[-`{-~]"
_CODED = ["doc_id", "part", "before", "ids", "id", "n"]
_BLOCK = "start long, docs array<long>, sizes array<int>, n_ids int, checkpoints array<int>, bits binary"


class Book(NamedTuple):
    """Ids in canonical order (length, id) with their code lengths."""

    ids: np.ndarray
    lengths: np.ndarray


def code_book(ids: np.ndarray, counts: np.ndarray, limit: int = LIMIT) -> Book:
    """Optimal prefix code with lengths up to ``limit``, by pairing packages of equal cost from the deepest level up."""
    if len(ids) == 0:
        return Book(np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(ids) == 1:
        return Book(np.asarray(ids, np.int64), np.ones(1, np.int64))
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids do not fit into codes of {limit} bits")
    order = np.lexsort((ids, counts))
    weights, n = np.asarray(counts, np.int64)[order], len(ids)
    # Each level's list is the merge of single ids and of pairs of the level below; what counts is, for each
    # level, which entries are pairs: taking the first k entries takes twice as many entries one level below.
    pair_weights, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([weights, pair_weights])
        place = np.argsort(both, kind="stable")
        levels.append(place >= n)
        merged = both[place]
        pair_weights = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_pair in reversed(levels):
        pairs = int(is_pair[:take].sum())
        lengths[:take - pairs] += 1
        take = 2 * pairs
    out_ids = np.asarray(ids, np.int64)[order]
    canonical = np.lexsort((out_ids, lengths))
    return Book(out_ids[canonical], lengths[canonical])


def codes(book: Book) -> np.ndarray:
    """Canonical codes: counted up within a length, shifted at each longer length."""
    steps = np.left_shift(1, LIMIT - book.lengths)
    return (np.cumsum(steps) - steps) >> (LIMIT - book.lengths)


def encode_block(values: np.ndarray, code: np.ndarray, length: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """Bits of ``values`` by tables over ids, and the bit offset of every ``stride``-th of them."""
    sizes = length[values]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return b"", begins[::stride]
    # Four codes of up to 16 bits are one number of up to 64, which lies in one or two words of 64 bits.
    fours = np.zeros((2, (len(values) + 3) // 4, 4), np.uint64)
    fours[0].ravel()[:len(values)], fours[1].ravel()[:len(values)] = code[values], sizes
    joined = fours[0, :, 0]
    for k in range(1, 4):
        joined = (joined << fours[1, :, k]) | fours[0, :, k]
    aligned = joined << (64 - fours[1].sum(axis=1))
    word, shift = begins[::4] >> 6, (begins[::4] & 63).astype(np.uint64)
    out = np.zeros((total >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    last = np.append(first[1:], len(word)) - 1  # no other number that begins in a word goes on in the next
    out[word[first]] = np.bitwise_or.reduceat(aligned >> shift, first)
    out[word[last] + 1] |= (aligned[last] << (63 - shift[last])) << np.uint64(1)
    return out.byteswap().tobytes()[:(total + 7) // 8], begins[::stride]


def decode_table(book: Book) -> np.ndarray:
    """Id (times 32) and code length for every value of the next ``LIMIT`` bits."""
    spans = np.left_shift(1, LIMIT - book.lengths)
    return np.concatenate([np.repeat(book.ids * 32 + book.lengths, spans), np.ones((1 << LIMIT) - int(spans.sum()), np.int64)])


def decode_block(bits: bytes, checkpoints: np.ndarray, n_ids: int, table: np.ndarray, stride: int = STRIDE) -> np.ndarray:
    """All ids of a block; every step reads one id at each checkpoint."""
    # The last checkpoint may have fewer ids than steps: what it reads beyond is left out.
    raw = np.concatenate([np.frombuffer(bits, np.uint8), np.zeros(stride * LIMIT // 8 + 4, np.uint8)]).astype(np.int64)
    words = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    at, out = np.array(checkpoints, np.int64), np.empty((stride, len(checkpoints)), np.int64)
    for k in range(stride):
        out[k] = found = table[(words[at >> 3] >> (24 - LIMIT - (at & 7))) & ((1 << LIMIT) - 1)]
        at += found & 31
    return (out >> 5).astype(np.uint32).T.ravel()[:n_ids]


def encode_words(coder, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, and where each word's begin and end."""
    flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for start in range(0, len(words), AT_ONCE):
        ids = [x.ids for x in coder.encode_batch_fast(words[start:start + AT_ONCE], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
    return np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def ends_of_words(coder, added: list[str]) -> np.ndarray | None:
    """Of each id, whether a word ends with it; None where ids do not tell."""
    from tokenizers.pre_tokenizers import ByteLevel

    suffix, vocabulary = getattr(coder.model, "end_of_word_suffix", None), coder.get_vocab()
    if not suffix or any(byte + suffix not in vocabulary for byte in ByteLevel.alphabet()):  # such a byte would leave no id
        return None
    if any(re.fullmatch(r"[\w\s]*", token) for token in added):  # may stand in a word of letters
        return None
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def encode_parts(coder, ends: np.ndarray | None, parts: pa.Array) -> pa.ListArray:
    """Ids of each part.

    A part of letters is one match of the tokenizer's pattern, so many with blanks between are one text for the library,
    cut again by the ids that end words.  Where a text has more of these than parts, some part was more than one match
    (a letter that becomes letter and mark): its parts are encoded one by one, as all others are that are not of letters.
    """
    letters = np.zeros(len(parts), bool) if ends is None else pc.match_substring_regex(parts, r"^\pL+$").to_numpy(zero_copy_only=False)
    chosen, places, flat, sizes = np.flatnonzero(letters), [], [], []
    bounds = np.append(np.arange(0, len(chosen), TOGETHER), len(chosen))
    texts = pc.binary_join(lists_of(parts.take(pa.array(chosen)), bounds), " ").to_pylist()
    for start in range(0, len(texts), TOGETHER):
        for k, coded in enumerate(coder.encode_batch_fast(texts[start:start + TOGETHER], add_special_tokens=False), start):
            ids = np.array(coded.ids, np.uint32)
            stops = np.flatnonzero(ends[ids]) + 1
            if len(stops) == bounds[k + 1] - bounds[k]:
                places.append(chosen[bounds[k]:bounds[k + 1]])
                flat.append(ids)
                sizes.append(np.diff(stops, prepend=0))
    left = np.ones(len(parts), bool)
    left[np.concatenate([*places, chosen[:0]])] = False
    places.append(np.flatnonzero(left))
    ids, stops = encode_words(coder, parts.take(pa.array(places[-1])).to_pylist())
    found = lists_of(pa.array(np.concatenate([*flat, ids]), pa.uint32()), np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.diff(stops)]))]))
    return found.take(pa.array(np.argsort(np.concatenate(places))))


def parts_of(words: pa.Array) -> pa.ListArray:
    """Each word cut where the tokenizer cuts it anyway: between a plain letter and a mark next to it, but for apostrophes.

    Both sides begin and end a match of the tokenizer's pattern and neither changes the other's normal form.  ASCII
    letters become lower case if all of the word is below U+0300, so that it has no marks to combine with.
    """
    cut = pc.if_else(pc.match_substring_regex(words, _UNCOMBINED), pc.ascii_lower(words), words)
    for before, after in ((_LETTER, _MARK), (_MARK, _LETTER)):
        cut = pc.replace_substring_regex(cut, pattern=f"({before})({after})", replacement=r"\1 \2")
    return pc.ascii_split_whitespace(cut)


def split_words(words: pa.Array, added: list[str]) -> pa.ListArray:
    """``parts_of`` each word; a word that may hold one of the tokenizer's ``added`` tokens stays whole, for the library to find them."""
    split = parts_of(words)
    if not added:
        return split
    whole = pc.match_substring_regex(words, "|".join(map(re.escape, added)), ignore_case=True)
    if not pc.any(whole).as_py():
        return split
    return pa.array([[word] if keep else parts for word, keep, parts in zip(words.to_pylist(), whole.to_pylist(), split.to_pylist(), strict=True)],
                    pa.list_(pa.string()))


class _Parts:
    """The tokenizer, and the ids of up to ``MEMO_PARTS`` parts that it was given."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.added = [token.content for token in self.coder.get_added_tokens_decoder().values()]
        self.ends = ends_of_words(self.coder, self.added)
        self.names, self.table = pa.array([], pa.string()), lists_of(pa.array([], pa.uint32()), np.zeros(1, np.int64))

    def ids(self, parts: pa.DictionaryArray) -> pa.ListArray:
        """Ids of every part; the new ones are encoded."""
        names = parts.dictionary
        where = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(where < 0)
        where[new] = len(self.names) + np.arange(len(new))
        fresh = names.take(pa.array(new))
        coded = encode_parts(self.coder, self.ends, fresh)
        self.names, self.table = pa.concat_arrays([self.names, fresh]), pa.concat_arrays([self.table, coded])
        found = self.table.take(pa.array(where[parts.indices.to_numpy()]))
        if len(self.names) > MEMO_PARTS:  # what stands in several words of this piece stays
            again = np.flatnonzero(np.bincount(parts.indices.to_numpy(), minlength=len(names)) > 1)
            self.names, self.table = names.take(pa.array(again)), self.table.take(pa.array(where[again]))
        return found


@functools.lru_cache(maxsize=1)
def _parts(path: str) -> _Parts:
    """Kept by a Python worker from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    return _Parts(path)


def _tokenize(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ids of each text with the end id, and how many ids of the partition stand before it; last, how often each id occurs.

    The tokenizer drops white space and joins nothing across it, so each distinct word of a piece is put together once
    from its parts; a part is encoded once and remembered for the next pieces.
    """
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, total = _parts(path), TaskContext.get().partitionId(), np.zeros(0, np.int64)
        for batch in pieces(batches, most=TEXT_BYTES):
            lists = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
            coded = lists.flatten().dictionary_encode()
            split = split_words(coded.dictionary, known.added)
            of_parts = known.ids(split.flatten().dictionary_encode())
            of_words = lists_of(of_parts.flatten(), of_parts.offsets.to_numpy()[split.offsets.to_numpy()])
            chosen = of_words.take(coded.indices)
            ends = chosen.offsets.to_numpy()[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            values = np.insert(chosen.flatten().to_numpy(), ends[1:], end_id).astype("<u4")
            bounds = ends.astype(np.int64) + np.arange(len(ends))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([task] * batch.num_rows, pa.int32()), pa.array(int(total.sum()) + bounds[:-1], pa.int64()),
                pa.array([values[a:b].tobytes() for a, b in itertools.pairwise(bounds)], pa.binary()),
                pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.int64()),
            ], _CODED)
            found = np.bincount(values, minlength=len(total))
            found[:len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(seen), pa.int64()), pa.array([task] * len(seen), pa.int32()), pa.nulls(len(seen), pa.int64()),
            pa.nulls(len(seen), pa.binary()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64()),
        ], _CODED)

    return tokenize


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``ids`` with the end id (unsigned 32-bit, little-endian), ``part`` and ``before``: parts ascend with ``doc_id``.

    Rows without ``ids`` tell how often (``n``) an ``id`` occurs in a part.
    """
    return saved(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
        .mapInArrow(_tokenize(path, end_id), "doc_id long, part int, before long, ids binary, id int, n long"), "token-ids")


def write(ids: DataFrame, path: str, limit: int = LIMIT, block_ids: int = BLOCK_IDS) -> None:
    """Write the blocks of ``tokenized`` documents and their code book below ``path``.

    What comes to the driver: one count per id of the vocabulary and one total per partition.
    """
    spark = ids.sparkSession
    known = ids.filter("id is not null")
    counts = known.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    book = code_book(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), limit)
    spark.createDataFrame(pa.table({"id": book.ids, "length": book.lengths})).coalesce(1).write.parquet(f"{path}/book")
    totals = known.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").toPandas()
    base = dict(zip(totals["part"], np.cumsum(totals["n"]) - totals["n"], strict=True)) if len(totals) else {}
    top = int(book.ids.max()) + 1 if len(book.ids) else 0
    code, length = np.zeros(top, np.int64), np.zeros(top, np.int64)
    code[book.ids], length[book.ids] = codes(book), book.lengths

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, parts, start, after, held = [], [], 0, None, 0

        def block() -> pa.RecordBatch:
            values = np.concatenate(parts)
            bits, checkpoints = encode_block(values, code, length)
            return pa.RecordBatch.from_arrays([
                pa.array([start], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                pa.array([[len(p) for p in parts]], pa.list_(pa.int32())), pa.array([len(values)], pa.int32()),
                pa.array([checkpoints], pa.list_(pa.int32())), pa.array([bits], pa.binary()),
            ], ["start", "docs", "sizes", "n_ids", "checkpoints", "bits"])

        for batch in batches:
            for doc, part, before, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "before")), batch.column("ids"), strict=True):
                first = int(base[part]) + before
                if docs and (first != after or held >= block_ids):  # a file ends, or the block is full
                    yield block()
                    docs, parts, held = [], [], 0
                if not docs:
                    start = first
                docs.append(doc)
                parts.append(np.frombuffer(packed.as_buffer(), "<u4"))
                held += len(parts[-1])
                after = first + len(parts[-1])
        if docs:
            yield block()

    ids.filter("ids is not null").select("doc_id", "part", "before", "ids").mapInArrow(blocks, _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _stored_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]:
    """The written blocks, and what makes ``doc_id``, ``start`` and ``ids`` of every document from them."""
    rows = spark.read.parquet(f"{path}/book").toPandas()  # one row per id of the vocabulary
    order = np.lexsort((rows["id"], rows["length"]))
    book = Book(rows["id"].to_numpy(np.int64)[order], rows["length"].to_numpy(np.int64)[order])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(book)
        for batch in batches:
            for row in range(batch.num_rows):  # a block at a time
                start, docs, sizes, n_ids, checkpoints, bits = (batch.column(c)[row] for c in ("start", "docs", "sizes", "n_ids", "checkpoints", "bits"))
                values = decode_block(bits.as_buffer(), checkpoints.values.to_numpy(), n_ids.as_py(), table)
                bounds = np.concatenate([[0], np.cumsum(sizes.values.to_numpy(), dtype=np.int64)])
                yield pa.RecordBatch.from_arrays([
                    docs.values, pa.array(start.as_py() + bounds[:-1], pa.int64()), lists_of(pa.array(values.astype(np.int32)), bounds),
                ], ["doc_id", "start", "ids"])

    return spark.read.schema(_BLOCK).parquet(f"{path}/blocks"), decoded


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of every document, decoded block by block."""
    blocks, decoded = _stored_blocks(spark, path)
    return blocks.mapInArrow(decoded, "doc_id long, start long, ids array<int>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """Write all documents' ids to ``path``, read them back, and give place, number and checksum of each."""
    write(tokenized(docs, tokenizer), path)
    blocks, decoded = _stored_blocks(docs.sparkSession, path)
    # One Python step: two in a row are two Python workers a core, which the executor keeps.
    return blocks.mapInArrow(lambda batches: _digest(decoded(batches)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "huffman"))


QUERIES = {"op2_huffman_ids": op2_huffman_ids}
ORACLES: dict[str, str] = {}
