"""Phrases whose words stand together more often than their parts would by chance, counted in quotient filters.

Texts are lower-cased (A-Z), cut into pieces at marks and line breaks and into words at blanks and tabs; everything is
per language.  All words are counted; a phrase of ``LEAST`` occurrences can only hold words and shorter phrases of as
many, so sizes are counted one after the other, each over the places that the size before left.

1. A word's id is a hash of language and word.  It is checked on the table of all words that no two share one; if two
   do, the job takes another seed.  So n-grams of ids stand for n-grams of words exactly.
   Up to ``MOST_WORDS`` frequent words are then numbered by rank, which packs n-grams tighter; more keep their ids.
2. Tasks count packed n-grams: an invertible permutation spreads their bits, the leading bits (the quotient) say where
   an entry stands and the rest (the full remainder) is kept, so a filter is lossless.  An entry costs its remainder,
   two bits of place and one byte of count (more for larger counts).
3. A filter is cut by the first bits of the quotient into shards.  Each shard's sorted filters meet and are merged as
   they come in; a task has its shards one after the other and holds one.  Equal n-grams are one entry of a task's filter
   before they are sent, so a frequent phrase is no heavier than a rare one, and permuted keys deal the rest evenly.
4. Frequent n-grams of a size set bits of a table of bounded size, which is sent to the tasks of the next size.  It only
   keeps hopeless places out; where it lets one through, the exact count drops it.

Scores are whole numbers of up to 38 digits (decimals).  A phrase goes if a longer one holds it with as many
occurrences; as counts never grow with length, it is enough to ask the phrases longer by one word.

Defined cases: a null text is empty, a null language ``und``; repeated rows count each; a very long text is counted as
any other; a text without words gives nothing; ties of score and count go by the phrase in byte order; further columns
are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commonspulse.llm.common import looked_up, mixed, pieces, read, saved, window_hashes
from commonspulse.session import large_rows

LEAST, LONGEST, TOP = 100, 5, 2000
HELD = 1 << 20  # entries that a task gathers before it sends them
SHARD = 1 << 21  # n-grams of the corpus for each shard
TASK_SHARDS = 2  # shards for each task that merges one after the other; it writes a file for each size
BITS_EACH, MOST_BITS = 16, 1 << 28  # of the table of frequent n-grams: per entry, and at most
MOST_WORDS = 1 << 22  # whose ids are sent to the tasks, 8 bytes each
LONG_WORD = 1 << 12  # characters; longer words are never broadcast
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_UNMIX = tuple(np.uint64(pow(int(m), -1, 1 << 64)) for m in _MIX)
_START = np.uint64(0x9E3779B97F4A7C15)

_KIND = np.zeros(256, np.uint8)  # of a byte: 0 of a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


# --- words and blocks of codes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a few texts: distinct (language, word), how often each occurs, and the words in order as codes, -1 between pieces."""
    for batch in pieces(batches):
        text = pa.concat_arrays([pc.ascii_lower(pc.fill_null(batch.column("text"), "")), pa.array([""], pa.string())])
        _, raw_bounds, raw = text.buffers()
        bounds = np.frombuffer(raw_bounds, np.int32)[text.offset:text.offset + batch.num_rows + 1]
        data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        kind = _KIND[data]
        of_word = kind == 0
        first = of_word.copy()
        first[1:] &= ~of_word[:-1]
        begins = bounds[:-1][np.diff(bounds) > 0]
        first[begins] = of_word[begins]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        content = data[of_word]
        before = np.cumsum(of_word)[starts] - 1
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(before, len(content)).astype(np.int32)), pa.py_buffer(content.tobytes())).dictionary_encode()
        owner = np.searchsorted(bounds, starts, "right") - 1
        langs = batch.column("lang").dictionary_encode()
        pairs = pa.array(langs.indices.to_numpy()[owner].astype(np.int64) * len(words.dictionary) + words.indices.to_numpy()).dictionary_encode()
        known, codes = pairs.dictionary.to_numpy(), pairs.indices.to_numpy()
        piece = np.cumsum(kind == 2)[starts] + owner
        fresh = np.concatenate([[False], (np.diff(piece) != 0) | (np.diff(owner) != 0)])
        stream = np.full(len(codes) + int(fresh.sum()), -1, np.int32)
        stream[np.arange(len(codes)) + np.cumsum(fresh)] = codes
        lists = [langs.dictionary.take(pa.array(known // len(words.dictionary))), words.dictionary.take(pa.array(known % len(words.dictionary))),
                 pa.array(np.bincount(codes, minlength=len(known)))]
        yield pa.RecordBatch.from_arrays([*(pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), x) for x in lists), pa.array([stream.tobytes()], pa.binary())],
                                         ["langs", "words", "counts", "codes"])


def blocks_of(docs: DataFrame) -> DataFrame:
    given = docs.select(F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return given.mapInArrow(_blocks, "langs array<string>, words array<string>, counts array<long>, codes binary")


def word_id(lang: Column, word: Column, seed: int) -> Column:
    return F.xxhash64(lang, word, F.lit(seed))


def word_counts(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, f, id) of all words, and the seed by which ids are one to one."""
    with large_rows(blocks.sparkSession):
        counted = saved(blocks.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("x")).groupBy(
            F.col("x.langs").alias("lang"), F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f")), "word-counts")
    seed = 0
    while True:
        words = counted.withColumn("id", word_id(F.col("lang"), F.col("word"), seed))
        if words.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() == 0:
            return words, seed
        seed += 1


# --- counting quotient filters


def lanes_of(size: int, width: int) -> list[int]:
    """How many ids of ``width`` bits go into each 64-bit number of an n-gram."""
    each = max(1, 64 // width)
    return [min(each, size - k) for k in range(0, size, each)]


def packed(ids: np.ndarray, width: int) -> np.ndarray:
    """Rows of ids side by side in as few numbers as hold them."""
    out, at = [], 0
    for count in lanes_of(ids.shape[1], width):
        lane = np.zeros(len(ids), np.uint64)
        for k in range(at, at + count):
            lane = (lane << np.uint64(width % 64)) | ids[:, k]
        out.append(lane)
        at += count
    return np.stack(out, axis=1)


def unpacked(lanes: np.ndarray, size: int, width: int) -> np.ndarray:
    out, mask = [], np.uint64((1 << width) - 1)
    for k, count in enumerate(lanes_of(size, width)):
        out += [(lanes[:, k] >> np.uint64(width * (count - 1 - i))) & mask for i in range(count)]
    return np.stack(out, axis=1)


def _spread(x: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """A permutation of the numbers of ``bits`` bits, or its inverse: halves are mixed into each other and multiplied."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for factor in (_UNMIX[::-1] if back else _MIX):
        x = ((x ^ (x >> half)) * factor) & mask
    return x ^ (x >> half)


def permuted(lanes: np.ndarray, bits: list[int]) -> np.ndarray:
    """Packed n-grams with their bits spread over all of them; ``restored`` undoes it."""
    out = lanes.copy()
    with np.errstate(over="ignore"):
        last = np.full(len(lanes), _START)
        for k, own in enumerate(bits):
            last = out[:, k] = _spread(out[:, k] ^ (last & np.uint64((1 << own) - 1)), own)
        if len(bits) > 1:
            out[:, 0] = _spread(out[:, 0] ^ (last & np.uint64((1 << bits[0]) - 1)), bits[0])
    return out


def restored(keys: np.ndarray, bits: list[int]) -> np.ndarray:
    out = keys.copy()
    with np.errstate(over="ignore"):
        if len(bits) > 1:
            out[:, 0] = _spread(out[:, 0], bits[0], True) ^ (out[:, -1] & np.uint64((1 << bits[0]) - 1))
        for k in range(len(bits) - 1, -1, -1):
            before = out[:, k - 1] if k else _START
            out[:, k] = _spread(out[:, k], bits[k], True) ^ (before & np.uint64((1 << bits[k]) - 1))
    return out


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys[:, 0], kind="stable")
    keys, counts = keys[order], counts[order]
    if ((keys[1:, 0] == keys[:-1, 0]) & (keys[1:] != keys[:-1]).any(axis=1)).any():  # alike in the first column alone
        order = np.lexsort(keys.T[::-1])
        keys, counts = keys[order], counts[order]
    first = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(counts, at)


def pack(keys: np.ndarray, counts: np.ndarray, bits: list[int], shard_bits: int) -> bytes:
    """A filter of sorted distinct keys that share their first ``shard_bits`` bits, which are left out.

    Quotients are two bit rows (which occur, and which entry is the last of its quotient); remainders keep as many bytes
    as they need; counts take a byte, those of 255 and more stand after them.
    """
    n, left = len(keys), bits[0] - shard_bits
    q = min(max(n.bit_length() - 1, 0), left)
    rest = left - q
    lead = keys[:, 0] & np.uint64((1 << left) - 1)
    quotient = (lead >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient] = 1
    ends = np.append(quotient[1:] != quotient[:-1], True)
    lanes = [_bytes(lead & np.uint64((1 << rest) - 1), rest), *(_bytes(keys[:, k], own) for k, own in enumerate(bits) if k)]
    small, large = np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype("<i8")
    return b"".join([struct.pack("<qb", n, q), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), *lanes, small.tobytes(), large.tobytes()])


def _bytes(numbers: np.ndarray, bits: int) -> bytes:
    return numbers.astype("<u8")[:, None].view(np.uint8)[:, :-(-bits // 8)].tobytes()


def unpack(raw: bytes, bits: list[int], shard_bits: int, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts of a filter."""
    n, q = struct.unpack_from("<qb", raw)
    at = struct.calcsize("<qb")

    def take(count: int, kind: str = "u1") -> np.ndarray:
        nonlocal at
        found = np.frombuffer(raw, kind, count, at)
        at += found.nbytes
        return found

    def numbers(own: int) -> np.ndarray:
        out, width = np.zeros((n, 8), np.uint8), -(-own // 8)
        out[:, :width] = take(n * width).reshape(n, width)
        return out.view("<u8")[:, 0].astype(np.uint64)

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    rest = bits[0] - shard_bits - q
    first = numbers(rest)
    if q:
        first = first | (occupied[np.cumsum(ends) - ends].astype(np.uint64) << np.uint64(rest))
    if shard_bits:
        first = first | np.uint64(shard << (bits[0] - shard_bits))
    keys = np.stack([first, *(numbers(own) for own in bits[1:])], axis=1)
    counts = take(n).astype(np.int64)
    counts[counts == 255] = take(int((counts == 255).sum()), "<i8")
    return keys, counts


class Counter:
    """Gathers n-grams and gives them back as filters, one for each shard."""

    def __init__(self, bits: list[int], shard_bits: int) -> None:
        self.bits, self.shard_bits = bits, shard_bits
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.fresh = 0  # entries in order, and those that came since

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        """Whether there is enough to send."""
        self.parts.append((keys, counts))
        self.fresh += len(keys)
        if self.fresh > max(HELD, self.size):
            self.settle()
        return self.size > HELD // 2

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1)) if self.parts else (np.zeros((0, len(self.bits)), np.uint64), np.zeros(0, np.int64))
        self.parts = []  # else they are held while their copy is sorted
        self.parts = [merged(keys, counts)]
        self.size, self.fresh = len(self.parts[0][0]), 0
        return self.parts[0]

    def filters(self) -> Iterator[tuple[int, bytes]]:
        keys, counts = self.settle()
        self.parts, self.size = [], 0
        if not len(keys):
            return
        shards = (keys[:, 0] >> np.uint64(self.bits[0] - self.shard_bits)).astype(np.int64) if self.shard_bits else np.zeros(len(keys), np.int64)
        at = np.flatnonzero(np.diff(shards, prepend=-1))
        for a, b in zip(at, np.append(at[1:], len(keys)), strict=True):
            yield int(shards[a]), pack(keys[a:b], counts[a:b], self.bits, self.shard_bits)


# --- n-grams, size by size


class Seen(NamedTuple):
    """A table of bits that every frequent n-gram of a size has set."""

    bits: np.ndarray

    def has(self, probes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 8 - 1)
        found = np.ones(len(probes), bool)
        for place in (probes & mask, (probes >> np.uint64(32)) & mask):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found


def seen_table(frequent: DataFrame) -> Seen:
    """From rows (probe): at most ``MOST_BITS`` bits, put together as 64-bit words."""
    wanted = max(1 << 12, BITS_EACH * frequent.count())
    size = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    places = F.array(F.col("probe").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("probe", 32).bitwiseAND(F.lit(size - 1)))
    words = frequent.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toPandas()
    table = np.zeros(size // 64, np.int64)
    table[words["word"]] = words["bits"]
    return Seen(table.view(np.uint8))


class Numbering(NamedTuple):
    """How tasks number the words that may be frequent: by rank among ``known``, or by their ids where ``seen`` lets them."""

    known: np.ndarray | None
    seen: Seen | None
    width: int  # bits of a number


def numbering(singles: DataFrame) -> Numbering:
    """Ranks for up to ``MOST_WORDS`` frequent words, whose ids are then sent; beyond, ids of 64 bits stand for themselves."""
    count = singles.count()
    if count <= MOST_WORDS:
        return Numbering(np.sort(singles.select("id").toPandas()["id"].to_numpy(np.int64).view(np.uint64)), None, max(1, count.bit_length()))
    return Numbering(None, seen_table(singles.select("id").mapInArrow(_probes, "probe long")), 64)


def _numbered(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers of the words that may be frequent, and codes of these; -1 for all others."""
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, _ = sent.value
        for batch in batches:
            ids = batch.column("ids")
            flat, bounds = ids.flatten().to_numpy(zero_copy_only=False).view(np.uint64), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            rows = []
            for k, codes in enumerate(batch.column("codes")):
                own = flat[bounds[k]:bounds[k + 1]]
                if known is None:
                    kept, number = seen.has(mixed(own)), own
                else:
                    number = np.searchsorted(known, own)
                    kept = np.append(known, 0)[number] == own if len(known) else np.zeros(len(own), bool)
                    kept &= number < len(known)
                code = np.append(np.where(kept, np.cumsum(kept) - 1, -1), -1).astype(np.int32)
                rows.append((number[kept].astype(np.uint64).tobytes(), code[np.frombuffer(codes.as_buffer(), np.int32)].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], ["ids", "codes"])

    return numbered


def _counted(size: int, width: int, shard_bits: int, seen) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Filters of the n-grams of a size; from size three on, only those whose two shorter ones may be frequent."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [width * count for count in lanes_of(size, width)]
        counter = Counter(bits, shard_bits)

        def sent() -> pa.RecordBatch:
            rows = list(counter.filters())
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int64()), pa.array([f for _, f in rows], pa.binary())], ["shard", "filter"])

        for batch in batches:
            for raw, codes in zip(batch.column("ids"), batch.column("codes"), strict=True):
                codes = np.frombuffer(codes.as_buffer(), np.int32)
                ids = np.append(np.frombuffer(raw.as_buffer(), np.uint64), np.uint64(0))[codes]
                fine = codes >= 0
                places = max(0, len(ids) - size + 1)
                held = np.ones(places, bool)
                for k in range(size):
                    held &= fine[k:k + places]
                if seen is not None:
                    shorter = seen.value.has(window_hashes(ids, size - 1))
                    held &= shorter[:places] & shorter[1:places + 1]
                at = np.flatnonzero(held)
                if len(at):
                    grams = np.stack([ids[at + k] for k in range(size)], axis=1)
                    if counter.add(*merged(permuted(packed(grams, width), bits), np.ones(len(at), np.int64))):
                        yield sent()
        yield sent()

    return counted


def _added(size: int, shard_bits: int, sent, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges the filters, ordered by shard, as they come in; n-grams of ``least`` occurrences leave with their words' ids."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _, width = sent.value
        bits = [width * count for count in lanes_of(size, width)]
        rows = ((shard.as_py(), raw) for batch in batches for shard, raw in zip(batch.column("shard"), batch.column("filter"), strict=True))
        for shard, filters in groupby(rows, lambda row: row[0]):
            counter = Counter(bits, 0)
            for _, raw in filters:
                counter.add(*unpack(raw.as_py(), bits, shard_bits, shard))
            keys, counts = counter.settle()
            keys, counts = keys[counts >= least], counts[counts >= least]
            numbers = unpacked(restored(keys, bits), size, width)
            probes = np.concatenate([window_hashes(row, size) for row in numbers]) if len(numbers) else np.zeros(0, np.uint64)
            ids = numbers if known is None else known[numbers.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * size, pa.int32()), pa.array(ids.view(np.int64).ravel())),
                pa.array(counts), pa.array(probes.view(np.int64))], ["ids", "f", "probe"])

    return added


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f, id) of all words, and (ids, f) of all phrases of 1 to ``longest`` words with ``least`` occurrences."""
    spark = docs.sparkSession
    with large_rows(spark):
        blocks = saved(blocks_of(docs), "word-blocks")
    words, seed = word_counts(blocks)
    total = words.agg(F.sum("f")).first()[0] or 0
    singles = words.filter(F.col("f") >= least)
    told = numbering(singles)
    sent = spark.sparkContext.broadcast(told)
    levels = [singles.select(F.array("id").alias("ids"), "f")]
    ids = F.transform("words", lambda word, k: word_id(F.get("langs", k), word, seed))
    with large_rows(spark):
        numbered = saved(blocks.select(ids.alias("ids"), "codes").mapInArrow(_numbered(sent), "ids binary, codes binary"), "word-codes")
    shards = max(1, -(-total // SHARD))
    seen = None
    for size in range(2, longest + 1):
        shard_bits = min((shards - 1).bit_length(), told.width * lanes_of(size, told.width)[0] - 1)
        filters = numbered.mapInArrow(_counted(size, told.width, shard_bits, seen), "shard long, filter binary")
        with large_rows(spark):
            found = saved(filters.repartition(-(-shards // TASK_SHARDS), "shard").sortWithinPartitions("shard").mapInArrow(
                _added(size, shard_bits, sent, least), "ids array<long>, f long, probe long"), "phrases")
        levels.append(found.select("ids", "f"))
        if size < longest:
            table = seen_table(found)
            if not table.bits.any():
                break
            seen = spark.sparkContext.broadcast(table)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return words, saved(every, "phrase-counts")


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mixed(batch.column("id").to_numpy().view(np.uint64)).view(np.int64))], ["probe"])


# --- scores


def scored(counts: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """(ids, lang, phrase, a, l, r, n, score) of all candidates: phrases of two words or more, by their lowest-scoring cut."""
    frequent = words.filter(F.col("f") >= least)
    candidates = counts.filter(F.size("ids") > 1)
    named = saved(candidates.select("ids", F.posexplode("ids").alias("place", "id")), "phrase-words")
    named = looked_up(named, frequent.select("id", "lang", "word"), "id", F.length("word") <= LONG_WORD).groupBy("ids").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    cuts = candidates.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    cuts = saved(looked_up(saved(cuts, "phrase-cuts"), counts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").drop("left"), "phrase-lefts")
    cuts = looked_up(cuts, counts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right").drop("right")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    whole = looked_up(saved(cuts.join(named, "ids"), "named-cuts"), totals, "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return whole.groupBy("ids", "lang", "phrase", "a", "n").agg(best).select("ids", "lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def standing_alone(candidates: DataFrame) -> DataFrame:
    """(ids) of the candidates (ids, f) that no longer one holds with as many occurrences."""
    longer = candidates.filter(F.size("ids") > 2).select(
        F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids"), F.col("f").alias("longer"))
    most = longer.groupBy("ids").agg(F.max("longer").alias("longer"))
    return candidates.join(most, "ids", "left").filter(F.col("longer").isNull() | (F.col("longer") < F.col("f"))).select("ids")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: (lang, rank, phrase, a, l, r, n, score)."""
    words, counts = frequent_phrases(docs, least, longest)
    found = scored(counts, words, least).join(standing_alone(counts.filter(F.size("ids") > 1)), "ids", "left_semi").drop("ids")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # The best of each slice of a language first, so that no task orders all phrases of one.
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = sliced.withColumn("rank", F.row_number().over(W.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


OP13_SQL = f"""
with lowered as (select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
                 from documents where text is not null),
pieces as (select lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') as w from lowered),
words as (select lang, unnest(w) as word from pieces),
totals as (select lang, count(*) as n from words group by 1),
often as (select lang, word from words group by 1, 2 having count(*) >= {LEAST}),
grams as (select lang, w[i:i + size - 1] as g from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
          from pieces, range(1, {LONGEST + 1}) t(size) where len(w) >= size)),
f as materialized (select lang, g, count(*) as f from grams group by 1, 2 having count(*) >= {LEAST}),
candidates as (select lang, g, f as a from f where len(g) > 1),
cuts as (select c.lang, c.g, a, k, x.f as l, y.f as r, n,
                cast((cast(1000 as hugeint) * a * n) // (cast(x.f as hugeint) * y.f) as bigint) as score
         from (select *, unnest(range(1, len(g))) as k from candidates) c join totals using (lang)
         join f x on x.lang = c.lang and x.g = c.g[1:k] join f y on y.lang = c.lang and y.g = c.g[k + 1:]),
best as (select lang, g, a, n, unnest(min(struct_pack(score := score, k := k, l := l, r := r))) from cuts group by 1, 2, 3, 4),
inner_parts as (select lang, g[i:i + size - 1] as g, max(a) as longer
                from (select lang, g, a, size, unnest(range(1, len(g) - size + 2)) as i from candidates, range(2, {LONGEST}) t(size) where size < len(g)) group by 1, 2),
ranked as (select b.lang, array_to_string(b.g, ' ') as phrase, a, l, r, n, score,
                  row_number() over (partition by b.lang order by score desc, a desc, array_to_string(b.g, ' ')) as rank
           from best b left join inner_parts p on p.lang = b.lang and p.g = b.g where longer is null or 100 * longer < 100 * a)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= {TOP}
"""

QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {"op13_collocations": OP13_SQL}
