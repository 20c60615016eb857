"""Near-duplicate lines by a deletion neighbourhood: of lines within one word of each other the earliest stays.

A line is what stands between line breaks; its words are lower-cased and parted by white space.  Two lines of at least
``MIN_WORDS`` words are duplicates if one word inserted, left out or replaced turns one into the other, so at five words
they agree in four fifths.  A line goes if an earlier one (by ``doc_id``, row, then place) is its duplicate or equal to
it; for equal lines ``equal_words`` words are enough, which is one in the query and the pipeline.

1. Each line gives a hash and keys of its halves.  One edit leaves a half as it is, so lines that share no key have no
   partner; only the others give variants.  Equal lines are settled by their hash.
2. Each remaining distinct line emits itself and every variant with one word left out, as hashed keys with the place.
   Equal variants at an equal place differ in that word alone; a variant equal to a line lacks one word.
3. Each line is joined to the earliest line of its key (never to all lines of it) and the edit distance of the words
   themselves decides.

Defined cases: a null text has no lines; null ``doc_id`` comes first and stays null; rows that share a ``doc_id``, or have
none, are rows of their own, in order of a hash of their texts, and equal rows in some order; further columns are kept by
``dedup`` whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import fresh, hash_strings, mixed, pieces, read, saved, signed, tokens

MIN_WORDS = 5
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Hasher:
    """Hashes of word ranges, from running sums: each in constant time."""

    def __init__(self, hashes: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            steps = np.full(len(hashes), _BASE)
            self.up = np.concatenate([[np.uint64(1)], np.multiply.accumulate(steps)])
            self.down = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(len(hashes), _INVERSE))])
            self.sums = np.concatenate([[np.uint64(0)], np.add.accumulate(hashes * self.up[:-1])])

    def _raw(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def range(self, a: np.ndarray, b: np.ndarray, tag: int = 0) -> np.ndarray:
        """Of words ``a`` to ``b``, told apart by count and tag."""
        with np.errstate(over="ignore"):
            return signed(mixed(self._raw(a, b) + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tag)))

    def without(self, a: np.ndarray, i: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of words ``a`` to ``b`` but for ``i``; equals ``range`` of a line that reads so."""
        with np.errstate(over="ignore"):
            raw = self._raw(a, i) + self._raw(i + 1, b) * self.up[i - a]
            return signed(mixed(raw + (b - a - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _words_of(lines: pa.Array) -> tuple[Hasher, np.ndarray]:
    words, bounds = tokens(pc.utf8_lower(lines))
    return Hasher(hash_strings(words)), bounds


def _line_keys(least: int):
    """(doc, line, hash, again, keys) of every line of ``least`` words; those too short for an edit have no keys."""
    def line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lists = pc.split_pattern(pc.fill_null(batch.column("text"), ""), "\n")
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            hasher, at = _words_of(lists.flatten())
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            place = np.arange(len(owner)) - bounds[owner]
            rows = np.flatnonzero(np.diff(at) >= least)
            a, b = at[rows], at[rows + 1]
            n = b - a
            full = hasher.range(a, b)
            order = np.lexsort((place[rows], full, owner[rows]))
            again = np.zeros(len(rows), bool)
            same = (full[order][1:] == full[order][:-1]) & (owner[rows][order][1:] == owner[rows][order][:-1])
            again[order[1:][same]] = True
            other = np.where(n % 2 == 0, hasher.range(a, a + (n - 1) // 2, 1), hasher.range(b - n // 2, b, 2))
            keys = (hasher.range(a, a + n // 2, 1), hasher.range(b - (n + 1) // 2, b, 2), other)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc").take(pa.array(owner[rows])), pa.array(place[rows], pa.int32()), pa.array(full), pa.array(again),
                *(pa.array(key, mask=n < MIN_WORDS) for key in keys),
            ], ["doc", "line", "hash", "again", "head", "tail", "other"])

    return line_keys


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the wanted lines."""
    for batch in batches:
        rows = [(doc, line, split[line])
                for doc, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "wanted")), strict=True)
                if wanted and text is not None for split in (text.split("\n"),) for line in wanted]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string()))],
                                         ["doc", "line", "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, place, doc, line): the line itself at place -1, then without each of its words."""
    for batch in pieces(batches, "words", 1 << 20):
        hasher, at = _words_of(batch.column("words"))
        sizes = np.diff(at)
        rows = np.repeat(np.arange(batch.num_rows), sizes + 1)
        place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1) - 1
        a, b = at[rows], at[rows + 1]
        key = np.where(place < 0, hasher.range(a, b), hasher.without(a, a + np.maximum(place, 0), b))
        yield pa.RecordBatch.from_arrays([
            pa.array(key), pa.array(place, pa.int32()), batch.column("doc").take(pa.array(rows)), batch.column("line").take(pa.array(rows)),
        ], ["key", "place", "doc", "line"])


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether at most one word inserted, left out or replaced turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[same + 1:] == b[same + 1:]
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return longer[same + 1:] == shorter[same:]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [pc.ascii_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(batch.column(c)))).to_pylist() for c in ("words", "kept_words")]
        right = pa.array([within_one([w for w in a if w], [w for w in b if w]) for a, b in zip(*split, strict=True)], pa.bool_())
        yield batch.select(["hash", "kept_doc", "kept_line"]).filter(right)


def _order(doc: str = "doc", line: str = "line") -> Column:
    return F.struct(F.col(doc).alias("doc"), F.col(line).alias("line"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, in order of ``doc_id`` (null first), and the name of that column.

    Where every row has a ``doc_id`` of its own, that is the number.  Else rows are ranged by id and text hash and written.
    """
    key, text_hash, place = fresh(docs, "row_number", "text_hash", "row_place")
    doc_id = F.col("doc_id").cast("long")
    odd = docs.groupBy(doc_id.alias("d")).agg(F.count("*").alias("n")).filter("d is null or n > 1").limit(1).count()
    if not odd:
        return docs.select(doc_id.alias(key), *docs.columns), key
    order = (doc_id.asc_nulls_first(), F.col(text_hash), F.col(place))
    ranged = docs.withColumn(text_hash, F.xxhash64("text")).withColumn(place, F.monotonically_increasing_id()).repartitionByRange(*order)
    return saved(ranged.sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias(key), *docs.columns), "line-rows"), key


def near_partners(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(hash, kept_doc, kept_line): distinct lines with an earlier line one word away; ``docs`` are rows (doc, text)."""
    keys = lines.filter("head is not null").select("hash", F.explode(F.array("head", "tail", "other")).alias("half"))
    shared = keys.groupBy("half").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).filter("a < b").select("half")
    paired = keys.join(shared, "half", "left_semi").select("hash").distinct()
    firsts = saved(lines.filter("not again").join(paired, "hash", "left_semi").groupBy("hash")
                   .agg(F.min("doc").alias("doc"), F.min_by("line", "doc").alias("line")), "line-firsts")
    wanted = firsts.groupBy("doc").agg(F.collect_list("line").alias("wanted"))
    texts = saved(docs.join(wanted.hint("merge"), "doc", "left")
                  .mapInArrow(_pick, "doc long, line int, words string").dropDuplicates(["doc", "line"]), "line-texts")
    variants = saved(texts.mapInArrow(_variants, "key long, place int, doc long, line int"), "line-variants")
    shortened, whole = variants.filter("place >= 0"), variants.filter("place < 0").select("key", _order().alias("own"))
    groups = shortened.groupBy("key", "place").agg(F.min(_order()).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    replaced = shortened.join(groups, ["key", "place"]).select(_order().alias("own"), "kept")
    lacking = shortened.join(whole, "key").select(_order().alias("own"), F.col("own").alias("kept"))
    longer = whole.join(shortened.groupBy("key").agg(F.min(_order()).alias("kept")), "key").select("own", "kept")
    found = replaced.unionByName(lacking).unionByName(longer).filter("kept < own").distinct()
    named = firsts.join(texts, ["doc", "line"])
    return (found.select(F.col("own.doc").alias("doc"), F.col("own.line").alias("line"),
                         F.col("kept.doc").alias("kept_doc"), F.col("kept.line").alias("kept_line"))
            .join(named, ["doc", "line"])
            .join(texts.select(F.col("doc").alias("kept_doc"), F.col("line").alias("kept_line"), F.col("words").alias("kept_words")), ["kept_doc", "kept_line"])
            .select("hash", "words", "kept_doc", "kept_line", "kept_words")
            .mapInArrow(_verified, "hash long, kept_doc long, kept_line int")
            .groupBy("hash").agg(F.min(F.struct("kept_doc", "kept_line")).alias("kept"))
            .select("hash", "kept.kept_doc", "kept.kept_line"))


def _marked(docs: DataFrame, equal_words: int) -> DataFrame:
    """(doc, line, near) from rows (doc, text): the lines to remove."""
    lines = saved(docs.mapInArrow(
        _line_keys(min(equal_words, MIN_WORDS)), "doc long, line int, hash long, again boolean, head long, tail long, other long"), "line-keys")
    near = near_partners(docs, lines).select("hash", F.lit(True).alias("near"))
    repeated = lines.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.max("again").alias("twice"))
    settled = repeated.join(near, "hash", "left").filter("near or twice or first < last")
    return (lines.select("doc", "line", "hash", "again").join(settled.select("hash", "first", "near"), "hash")
            .filter(F.col("near") | F.col("again") | (F.col("doc") > F.col("first")))
            .select("doc", "line", F.coalesce("near", F.lit(False)).alias("near")))


def _rows(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("doc"), F.col("text").cast("string").alias("text"))


def duplicates(docs: DataFrame, equal_words: int = MIN_WORDS) -> DataFrame:
    """(doc, line, near), ``doc`` the row's ``doc_id``: the lines to remove, equal to an earlier line (from ``equal_words`` words on) or one word from it."""
    rows, key = numbered(docs)
    ids = rows.select(F.col(key).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"))
    return _marked(_rows(rows, key), equal_words).join(ids, "doc").select(F.col("doc_id").alias("doc"), "line", "near")


def _rebuilt(names: list[str], place: int):
    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                drop = set(gone or ())
                texts.append(text if text is None or not drop else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rebuilt


def dedup(docs: DataFrame, equal_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their columns, ``text`` without the duplicate lines; those left without any word go."""
    rows, key = numbered(docs)
    gone, had = fresh(rows, "gone", "had")
    lost = _marked(_rows(rows, key), equal_words).groupBy("doc").agg(F.collect_set("line").alias(gone)).withColumnRenamed("doc", key)
    joined = rows.join(lost.hint("merge"), key, "left")
    word = F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    out = joined.withColumn(had, word & F.col(gone).isNotNull()).select(*docs.columns, had, gone).mapInArrow(
        _rebuilt([*docs.columns, had], docs.columns.index("text")), docs.withColumn(had, F.lit(True)).schema)
    return out.filter(~F.col(had) | F.col("text").rlike(r"\S")).drop(had)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every removed line: its document, place, and whether it differs from the earlier one."""
    return duplicates(read(spark, sf_dir, "documents"), 1).select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), "near")


_LINES_SQL = f"""
lines as (select doc_id, k - 1 as line_no, list_filter(regexp_split_to_array(lower(line), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as w
          from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as k from documents where text is not null)),
long as (select doc_id, line_no, array_to_string(w, ' ') as k, w from lines where len(w) > 0),
every as (select k, w, min(struct_pack(d := doc_id, l := line_no)) as o from long group by k, w),
firsts as (select * from every where len(w) >= {MIN_WORDS}),
shorter as (select o, i, array_to_string(w[1:i - 1] || w[i + 1:], ' ') as v from (select o, w, unnest(range(1, len(w) + 1)) as i from firsts)),
groups as (select v, i, min(o) as e from shorter group by v, i),
near as (select o from shorter join groups using (v, i) where e < o
         union select s.o from shorter s join firsts f on s.v = f.k where f.o < s.o
         union select f.o from shorter s join firsts f on s.v = f.k where s.o < f.o)"""
OP1_SQL = f"""
with {_LINES_SQL}
select doc_id, cast(line_no as integer) as line_no, every.o in (select o from near) as near
from long join every using (k) where every.o in (select o from near) or struct_pack(d := doc_id, l := line_no) > every.o
"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES = {"op1_line_dedup": OP1_SQL}
