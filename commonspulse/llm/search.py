"""Exact top-k by inner product over vectors sorted by length, with pruning by residual bounds.

Components become whole numbers (``floor(256 * x)``), so scores are exact.  Vectors are dealt by descending length into
blocks of bounded size.  Queries, in chunks, first meet the block of the longest vectors, which gives each query a score
to beat.  A later block can hold a better one only if its longest vector times the query's length reaches that score:
only such pairs of chunk and block are joined.  Within a pair, both sides are rotated to the principal axes of all
vectors (SVD, from sums over all rows); the sum over the first axes plus the product of what is left of both lengths
bounds the score from above (Cauchy-Schwarz), and only what reaches the score to beat is computed in whole numbers.

Defined cases: vectors that are null, empty, without ``vec_id``, or hold a null or non-finite component take no part;
shorter vectors count as filled up with zeros; equal rows count once; different vectors of one ``vec_id`` are each a
candidate, and compete together as one query; no candidate shares the query's ``vec_id``; further columns are left out; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commonspulse.llm.common import read, saved

BLOCK, CHUNK, STEP = 4096, 512, 512  # vectors of a block, queries of a chunk, vectors scored at once
AXES = 0.25  # share of the axes in the partial sums
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v, norm2) of the vectors that take part."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * 256).cast("long"))
    fine = F.forall(F.col("embedding").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine).select(
        F.col("vec_id").cast("long"), v.alias("v")).distinct().withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Axes by descending share of the vectors' lengths, from the sums of products over all rows (dims x dims numbers)."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column("v"), dims).astype(float)
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])

    sums = vectors.select("v").mapInArrow(products, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    gram = np.zeros((dims, dims))
    gram[sums["i"], sums["j"]] = sums["s"]
    return np.linalg.svd(gram)[2]


def _pack(dims: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``size`` vectors: (number, longest, ids, values), numbered in order of partition and place."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, values = TaskContext.get().partitionId() << 32, np.zeros(0, np.int64), np.zeros((0, dims), np.int64)

        def row(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            longest = float(np.sqrt((values.astype(float) ** 2).sum(axis=1).max()))
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([longest]), pa.array([ids.tobytes()], pa.binary()),
                                               pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())], ["number", "longest", "ids", "values"])

        for batch in batches:
            ids = np.concatenate([ids, batch.column("vec_id").to_numpy()])
            values = np.concatenate([values, _matrix(batch.column("v"), dims)])
            while len(ids) >= size:
                yield row(ids[:size], values[:size])
                ids, values, number = ids[size:], values[size:], number + 1
        if len(ids):
            yield row(ids, values)

    return pack


_PACKED = "number long, longest double, ids binary, values binary"


def top_of(queries: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], axes: np.ndarray, k: int,
           beat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` rows of each query that reach ``beat``: (query number, vec_id, score), and the scores now to beat."""
    (q_ids, q), (ids, x) = queries, rows
    first = max(1, int(len(axes) * AXES))
    q_turned, x_turned = q @ axes.T, x @ axes.T
    q_rest, x_rest = (np.sqrt((m[:, first:] ** 2).sum(axis=1)) for m in (q_turned, x_turned))
    q_norm, x_norm = (np.sqrt((m ** 2).sum(axis=1)) for m in (q_turned, x_turned))
    order = np.argsort(-x_norm, kind="stable")
    beat = beat.copy()
    best: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(3))
    for start in range(0, len(order), STEP):
        at = order[start:start + STEP]
        bound = q_turned[:, :first] @ x_turned[at, :first].T + np.outer(q_rest, x_rest[at])
        bound += 1e-9 * np.outer(q_norm, x_norm[at]) + 1e-6
        i, j = np.nonzero((bound >= beat[:, None]) & (q_ids[:, None] != ids[at]))
        if not len(i):
            continue
        score = np.concatenate([(q[i[a:a + 65536]] * x[at[j[a:a + 65536]]]).sum(axis=1) for a in range(0, len(i), 65536)])
        best = tuple(np.concatenate([old, new]) for old, new in zip(best, (i, ids[at[j]], score), strict=True))
        rank = np.lexsort((best[1], -best[2], best[0]))
        best = tuple(b[rank] for b in best)
        begin = np.searchsorted(best[0], best[0])
        best = tuple(b[np.arange(len(rank)) - begin < k] for b in best)
        last = np.flatnonzero(np.bincount(best[0], minlength=len(q_ids)) == k)
        beat[last] = np.maximum(beat[last], best[2][np.searchsorted(best[0], last, side="right") - 1])
    return *best, beat


def _unpacked(ids: bytes, values: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(values, np.int64).reshape(-1, dims)


def top_k(embeddings: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` highest inner products of each query row with every other row: (query_id, rank, vec_id, score)."""
    spark = embeddings.sparkSession
    vectors = saved(whole_vectors(embeddings), "vectors")
    dims = vectors.agg(F.max(F.size("v")).alias("d")).first()["d"]
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    axes = principal_axes(vectors, dims)
    blocks = saved(vectors.repartitionByRange(F.col("norm2").desc(), "vec_id").sortWithinPartitions(F.col("norm2").desc(), "vec_id")
                   .select("vec_id", "v").mapInArrow(_pack(dims, BLOCK), _PACKED), "vector-blocks")
    chunks = saved(vectors.filter(is_query).select("vec_id", "v").mapInArrow(_pack(dims, CHUNK), _PACKED), "query-chunks")
    # The longest vectors: at most BLOCK of them, whatever the size of the table.
    longest = blocks.orderBy("number").select("ids", "values").first()
    longest = (longest["ids"], longest["values"])

    def first_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                queries = _unpacked(r["ids"], r["values"], dims)
                *_, beat = top_of(queries, _unpacked(*longest, dims), axes, k, np.full(len(queries[0]), -np.inf))
                need = beat / np.maximum(np.sqrt((queries[1].astype(float) ** 2).sum(axis=1)), 1e-300)  # length that can reach it
                yield pa.RecordBatch.from_arrays([pa.array([r["number"]]), pa.array([r["ids"]], pa.binary()), pa.array([r["values"]], pa.binary()),
                                                  pa.array([beat.tobytes()], pa.binary()), pa.array([float(need.min())])],
                                                 ["number", "ids", "values", "beat", "need"])

    asked = saved(chunks.select("number", "ids", "values").mapInArrow(
        first_scores, "number long, ids binary, values binary, beat binary, need double"), "query-scores")
    lengths = [(r["number"], r["longest"]) for r in blocks.select("number", "longest").orderBy("number").collect()]
    numbers, reach = np.array([n for n, _ in lengths]), np.array([x for _, x in lengths])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, need in zip(batch.column("number").to_pylist(), batch.column("need").to_pylist(), strict=True):
                alive = numbers[reach * (1 + 1e-9) >= need]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(alive), number)), pa.array(alive)], ["number", "block"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                queries = _unpacked(r["ids"], r["values"], dims)
                who, ids, score, _ = top_of(queries, _unpacked(r["x_ids"], r["x_values"], dims), axes, k, np.frombuffer(r["beat"]))
                yield pa.RecordBatch.from_arrays([pa.array(queries[0][who]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    met = (asked.select("number", "need").mapInArrow(pairs, "number long, block long")
           .join(blocks.select(F.col("number").alias("block"), F.col("ids").alias("x_ids"), F.col("values").alias("x_values")), "block")
           .join(asked.drop("need"), "number").drop("number", "block"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (met.mapInArrow(scored, _FOUND).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP7_SQL = """
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
           from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
ranked as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scores)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

QUERIES = {"op7_top_k": op7_top_k}
ORACLES = {"op7_top_k": OP7_SQL}
