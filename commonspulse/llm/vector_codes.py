"""Vector codes: each part of a vector as the index of its nearest codebook entry, by k-means with adaptive bounds.

Components become whole numbers and a vector is cut into equal parts, each with a codebook of its own.  A round assigns
every part to its nearest entry and moves the entries.  With every part goes what Drake and Hamerly keep: an upper bound
of the distance to its entry, its next ``b`` closest entries with lower bounds in order, and one outer bound for all
others.  When entries move, bounds widen by the distances moved.  A part whose upper bound stays below its least lower
bound keeps its entry without a distance; else only the entries whose bounds it reaches are measured, all of them if it
reaches the outer bound.  Whatever is measured is measured in whole numbers, so ties go to the lower index exactly.
``b`` starts at a quarter of the entries and falls, to an eighth at least, to what nearly all parts needed.

Bounds travel with their vectors in a table written each round.  Only sums per entry, codebooks and a histogram, whose
sizes depend on the parameters alone, reach the driver.

Defined cases: vectors that are null or hold null or non-finite components take no part; components of a size of 65536
or more are an error (their whole-number distances might not fit); shorter vectors, also empty ones, count as filled up
with zeros to the longest length, and that to a multiple of the number of parts; rows count each, also of one
``vec_id``; where ``vec_id`` repeats or is null, first entries go by id (null last), then vector; with fewer rows than
entries there are fewer entries; null labels are one label; further columns are left out; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import looked_up, read, saved

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LARGEST = 65536.0  # size of a component
LIKELY = 0.99  # share of the parts that ``b`` is to be enough for
SLACK = 1e-6  # by which stored bounds are wider than computed
ROWS = 4096  # vectors handled at once
_STATE = "vec_id long, label string, v array<long>, entry binary, upper binary, near binary, lower binary, need binary"


class Bounds(NamedTuple):
    """Of the parts at one position: entry, upper bound, next entries, lower bounds (one more than entries: the outer)."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact."""
    widest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * widest * widest * max(1, x.shape[1]) < 1 << 52:  # exact in doubles
        x, entries = x.astype(float), entries.astype(float)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)).astype(np.int64)


def _least(d2: np.ndarray) -> np.ndarray:
    return (np.sqrt(d2.astype(float)) * (1 - SLACK)).astype(np.float32)


def _most(d2: np.ndarray) -> np.ndarray:
    return (np.sqrt(d2.astype(float)) * (1 + SLACK)).astype(np.float32)


def measured(x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Every row against every entry."""
    d2 = distances(x, entries)
    order = np.argsort(d2, axis=1, kind="stable")  # ties to the lower index
    d2 = np.take_along_axis(d2, order, axis=1)
    b = min(b, len(entries) - 1)
    outer = _least(d2[:, b + 1:b + 2]) if len(entries) > b + 1 else np.full((len(x), 1), np.inf, np.float32)
    return Bounds(order[:, 0].astype(np.uint8), _most(d2[:, 0]), order[:, 1:b + 1].astype(np.uint8), np.hstack([_least(d2[:, 1:b + 1]), outer]))


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry went, at most."""
    return np.sqrt(((new - old).astype(float) ** 2).sum(axis=1)) * (1 + SLACK)


def reassigned(x: np.ndarray, entries: np.ndarray, held: Bounds, move: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds after the entries moved, and how many of the ordered bounds each row reached (one more than ``b``: the outer)."""
    b = min(b, held.near.shape[1])
    # Bounds in order: each stands for itself and all after it, so those beyond ``b`` merge into the outer one.
    lower = np.hstack([held.lower[:, :-1] - move[held.near], held.lower[:, -1:] - move.max(initial=0)])
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1][:, :b + 1].astype(float)
    near, entry = held.near[:, :b].copy(), held.entry.copy()
    upper = held.upper + move[entry]
    need = (lower <= upper[:, None]).sum(axis=1)
    unsure = np.flatnonzero(need)
    own = ((x[unsure] - entries[entry[unsure]]) ** 2).sum(axis=1)
    upper[unsure] = _most(own)
    need[unsure] = (lower[unsure] <= upper[unsure, None]).sum(axis=1)
    for z in range(1, b + 1):
        rows = np.flatnonzero(need == z)
        if len(rows):
            among = np.hstack([entry[rows, None], near[rows, :z]])
            d2 = ((x[rows, None, :] - entries[among]) ** 2).sum(axis=2)
            order = np.lexsort((among, d2), axis=1)
            among, d2 = np.take_along_axis(among, order, axis=1), np.take_along_axis(d2, order, axis=1)
            entry[rows], near[rows, :z] = among[:, 0], among[:, 1:]
            upper[rows], lower[rows, :z] = _most(d2[:, 0]), _least(d2[:, 1:])
    rows = np.flatnonzero(need == b + 1)
    if len(rows):
        fresh = measured(x[rows], entries, b)
        entry[rows], upper[rows], near[rows], lower[rows] = fresh
    # Kept as single precision, again on the safe side; no distance is below zero.
    lower = np.maximum(lower * (1 - SLACK), 0)
    return Bounds(entry, (upper * (1 + SLACK)).astype(np.float32), near, lower.astype(np.float32)), need.astype(np.uint8)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the vectors that take part, each component as ``floor(256 * x)``."""
    given = F.col("embedding").cast("array<double>")
    fine = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(given, lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * 256).cast("long")).otherwise(
        F.raise_error(F.lit("a component is too large for whole-number distances"))))
    return embeddings.filter(F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat, bounds = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _kept(column: pa.Array, kind: type, parts: int) -> np.ndarray:
    """Binary values of all rows as (row, part, ...)."""
    rows = [np.frombuffer(x, kind) for x in column.to_pylist()]
    flat = np.stack(rows)
    return flat.reshape(len(rows), parts, flat.shape[1] // parts)


def _halved(lower: np.ndarray) -> np.ndarray:
    """The upper half of each number's bits: two bytes of a bound that is never larger."""
    return (lower.view(np.uint32) >> 16).astype(np.uint16)


def _widened(halves: np.ndarray) -> np.ndarray:
    return (halves.astype(np.uint32) << 16).view(np.float32)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def _assign(books: np.ndarray, b: int, before: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with their bounds to ``books`` (part, entry, place); those given are to ``before``."""
    parts, _, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
                found, needs = [], np.full((len(x), parts), 255, np.uint8)
                if before is not None:
                    entry, upper, near, lower = (_kept(batch.column(c), kind, parts) for c, kind in (
                        ("entry", np.uint8), ("upper", np.float32), ("near", np.uint8), ("lower", np.uint16)))
                    lower = _widened(lower)
                for p in range(parts):
                    if before is None:
                        found.append(measured(x[:, p], books[p], b))
                    else:
                        held = Bounds(entry[:, p, 0], upper[:, p, 0].astype(float), near[:, p], lower[:, p])
                        one, needs[:, p] = reassigned(x[:, p], books[p], held, moved(before[p], books[p]), b)
                        found.append(one)
                columns = [np.stack([getattr(f, c) for f in found], axis=1) for c in ("entry", "upper", "near", "lower")]
                columns = [_binary(c) for c in (*columns[:3], _halved(columns[3]))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "v")), *columns, _binary(needs)],
                                                 ["vec_id", "label", "v", "entry", "upper", "near", "lower", "need"])

    return assign


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of its parts; unused ones stay.  Sums meet per entry and place."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
            x = np.concatenate([x, np.ones((len(x), parts, 1), np.int64)], axis=2)
            np.add.at(total, (np.arange(parts), _kept(batch.column("entry"), np.uint8, parts)[:, :, 0]), x)
        i, j, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*(pa.array(a) for a in (i, j, k)), pa.array(total[i, j, k])], ["part", "entry", "place", "s"])

    rows = state.select("v", "entry").mapInArrow(sums, "part long, entry long, place long, s long").groupBy("part", "entry", "place").agg(
        F.sum("s").alias("s")).collect()
    total = np.zeros((parts, entries, width + 1), np.int64)
    for r in rows:
        total[r["part"], r["entry"], r["place"]] = r["s"]
    count = total[:, :, -1:]
    return np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)


def _adapted(state: DataFrame, b: int, entries: int) -> int:
    """The ``b`` that nearly all parts of the last round would have had enough of; never more than before."""
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(256, np.int64)
        for batch in batches:
            seen += np.bincount(np.frombuffer(b"".join(batch.column("need").to_pylist()), np.uint8), minlength=256)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["need", "n"])

    counts = {r["need"]: r["n"] for r in state.select("need").mapInArrow(histogram, "need long, n long").groupBy("need").agg(F.sum("n").alias("n")).collect()}
    inside = {need: n for need, n in counts.items() if need <= b}  # beyond, all entries are measured whatever ``b``
    wanted, so_far = b, 0
    for need in sorted(inside):
        so_far += inside[need]
        if so_far >= LIKELY * sum(inside.values()):
            wanted = need
            break
    return min(b, max(wanted, entries // 8, 1))


class Codes(NamedTuple):
    rows: DataFrame  # vec_id, label, code, error
    books: np.ndarray  # part, entry, place
    kept: list[int]  # b of each assignment


def encode(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codes of all vectors after ``rounds`` of moving entries, with the squared distance to what they stand for."""
    if entries > 256:
        raise ValueError("a code has one byte for a part")
    vectors = saved(whole_vectors(embeddings), "code-vectors")
    longest = vectors.agg(F.max(F.size("v")).alias("d")).first()["d"]
    width = max(1, -(-(longest or 0) // parts))
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = np.zeros((len(first), parts * width), np.int64)
    for k, row in enumerate(first):
        books[k, :len(row["v"])] = row["v"]
    books = np.ascontiguousarray(books.reshape(len(first), parts, width).transpose(1, 0, 2))
    b, before, state, kept = max(1, entries // 4), None, vectors, []
    for step in range(rounds + 1 if first else 0):
        kept.append(b)
        state = state.mapInArrow(_assign(books, b, before), _STATE)
        if step < rounds:  # the last round's bounds are of no more use
            state = saved(state, "code-bounds")
            before, books = books, _moved_books(state, books)
            b = _adapted(state, b, entries) if step else b

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                entry = _kept(batch.column("entry"), np.uint8, parts)[:, :, 0]
                x = _matrix(batch.column("v"), parts * width).reshape(-1, parts, width)
                error = ((x - books[np.arange(parts), entry]) ** 2).sum(axis=(1, 2))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([e.tobytes().hex() for e in entry]), pa.array(error)],
                                                 ["vec_id", "label", "code", "error"])

    schema = "vec_id long, label string, code string, error long"
    rows = saved(state.select("vec_id", "label", "v", "entry").mapInArrow(codes, schema), "codes") if first else embeddings.sparkSession.createDataFrame([], schema)
    return Codes(rows, books, kept)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(read(spark, sf_dir, "embeddings"))
    # One text a label, null included: "v" and the label, or "n".
    keyed = found.rows.withColumn("key", F.when(F.col("label").isNull(), "n").otherwise(F.concat(F.lit("v"), "label")))
    errors = keyed.groupBy("key").agg(F.sum("error").alias("label_error"))
    return looked_up(keyed, errors, "key").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(found.books)).alias("codebooks_sha256"))


def _sql() -> str:
    nearest = """
d{r} as (select x.id, x.part, c.entry, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
         from cut x join book{r} c using (part)),
near{r} as materialized (select id, part, cast(min(struct_pack(d := d, e := entry)).e as bigint) as entry, min(d) as d from d{r} group by 1, 2)"""
    moved_sql = """
summed{r} as (select part, entry, place, sum(v[place]) as s, count(*) as n from cut join near{r} using (id, part), range(1, {w} + 1) t(place) group by 1, 2, 3),
fresh{r} as (select part, entry, list(cast((s - ((s % n) + n) % n) // n as bigint) order by place) as v from summed{r} group by 1, 2),
book{t} as materialized (select part, entry, coalesce(f.v, b.v) as v from book{r} b left join fresh{r} f using (part, entry))"""
    w = "(select any_value(len(v)) from cut)"
    steps = [nearest.format(r=0), moved_sql.format(r=0, t=1, w=w), nearest.format(r=1), moved_sql.format(r=1, t=2, w=w), nearest.format(r=2)]
    return f"""
with whole as (select row_number() over (order by vec_id nulls last, embedding) as id, vec_id, label,
                      list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
               from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as materialized (select id, part, v[part * (len(v) // {PARTS}) + 1:(part + 1) * (len(v) // {PARTS})] as v from whole, range({PARTS}) t(part)),
book0 as (select part, id - 1 as entry, v from cut where id <= {ENTRIES}),
{",".join(steps)},
books as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from book2),
coded as (select id, vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error
          from whole join near2 using (id) group by 1, 2, 3)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded, books
"""


OP11_SQL = _sql()

QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLES = {"op11_vector_codes": OP11_SQL}
