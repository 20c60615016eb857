"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, exact links, components.

A document's set is its distinct shingles of ``SHINGLE`` words, or another width (A-Z lower-cased).  One 64-bit hash per shingle: the first
bits choose a bucket, whose register keeps the smallest remaining hash as its count of leading zeros and the next
``MANTISSA`` bits.  Documents with equal sets are one node from there on.  Registers are banded; nodes that share a band
are candidates, and an estimate from the registers, corrected for equal registers of different hashes, comes before the
exact comparison of the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import fresh, hash_strings, looked_up, mixed, pieces, read, saved, signed, tokens, window_hashes

SHINGLE = 3
SHARE = (85, 100)  # intersection to union, at least
BUCKET_BITS, MANTISSA = 7, 10
BUCKETS = 1 << BUCKET_BITS
ROWS = 4  # registers of a band
SLACK = 0.2  # how far below the share an estimate may lie: over five standard errors of 128 registers at 0.8, six at 0.85


def shingle_sets(text: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, in order."""
    words, bounds = tokens(pc.ascii_lower(pc.fill_null(text, "")))
    hashes = hash_strings(words)
    full = window_hashes(hashes, width)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        sets.append(np.unique(full[a:b - width + 1]) if b - a >= width else window_hashes(hashes[a:b], b - a) if b > a else full[:0])
    return sets


def registers(hashes: np.ndarray) -> np.ndarray:
    """One number a bucket: 0 if empty, else leading zeros and mantissa of the smallest hash, as 16 bits."""
    out = np.zeros(BUCKETS, np.uint16)
    if len(hashes):
        hashes = np.sort(hashes)
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        rest = (hashes[first] << np.uint64(BUCKET_BITS)) | np.uint64((1 << BUCKET_BITS) - 1)  # never zero
        top = (rest >> np.uint64(11)).astype(np.float64)  # 53 bits, exact
        zeros = 53 - np.frexp(top)[1]  # of the 53 highest
        after = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
        out[bucket[first]] = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA) | after).astype(np.uint16)
    return out


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, less the equal registers that different hashes give by chance."""
    filled = ((others > 0) | (one > 0)).sum(axis=1)
    equal = ((others == one) & (one > 0)).sum(axis=1)
    load = (others > 0).sum(axis=1) / BUCKETS
    chance = 0.1699 * BUCKETS / (1 << MANTISSA) * 4 * load / (1 + load) ** 2
    return np.maximum(equal - chance, 0) / np.maximum(filled, 1)


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int] = SHARE) -> bool:
    """Whether two full sets are similar enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return share[1] * both >= share[0] * (len(a) + len(b) - both)


class Groups:
    """Disjoint sets over the members of one task."""

    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.top(x)] = self.top(y)


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _signatures(width: int):
    """Size and 128-bit digest of each document's set, and its registers."""
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(batch.column("text"), width)
            low = np.zeros(len(sets), np.uint64)
            high = np.zeros(len(sets), np.uint64)
            with np.errstate(over="ignore"):
                for k, s in enumerate(sets):
                    low[k] = np.bitwise_xor.reduce(mixed(s + np.uint64(len(s)))) if len(s) else 0
                    high[k] = np.add.reduce(mixed(s ^ np.uint64(0xA0761D6478BD642F)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array(signed(low)), pa.array(signed(high)),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            ], ["doc_id", "n_shingles", "low", "high", "registers"])

    return signatures


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, band, node) of every band with a filled register."""
    for batch in batches:
        if batch.num_rows:
            bands = np.ascontiguousarray(_registers(batch.column("registers"))).view(np.uint64)
            row, band = np.nonzero(bands)
            with np.errstate(over="ignore"):
                key = mixed(mixed(bands[row, band]) + band.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(band.astype(np.int32)), batch.column("node").take(pa.array(row))],
                                             ["key", "band", "node"])


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (key, band, lo, hi), which follow one another, as one batch each."""
    keys, held = ("key", "band", "lo", "hi"), None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        columns = [batch.column(k).to_numpy() for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        starts = np.concatenate([[0], cut])
        for a, b in zip(starts[:-1], cut, strict=True):
            yield batch.slice(a, b - a)
        held = batch.slice(int(starts[-1]))
    if held is not None:
        yield held


def _partners(task: pa.RecordBatch, regs: np.ndarray, share: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each member those after it (or in the other block) that may be linked, if this is the first band they share."""
    own, band = task.column("own").to_numpy(), task.column("band")[0].as_py()
    across = task.column("lo")[0].as_py() != task.column("hi")[0].as_py()
    sizes = task.column("n").to_numpy()
    bands = np.ascontiguousarray(regs).view(np.uint64)
    floor = share[0] / share[1] - SLACK
    for x in range(len(regs) - 1):
        y = np.arange(x + 1, len(regs))
        if across:
            y = y[own[y] != own[x]]
        y = y[share[1] * np.minimum(sizes[y], sizes[x]) >= share[0] * np.maximum(sizes[y], sizes[x])]
        if len(y):
            same = (bands[y] == bands[x]) & (bands[x] > 0)
            y = y[same.argmax(axis=1) == band] if band < same.shape[1] else y[:0]
        if len(y):
            y = y[estimates(regs[x], regs[y]) >= floor]
        yield x, y


def _promising(share: tuple[int, int]):
    """Members of a task that may be linked to another one of it."""
    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _tasks(batches):
            wanted = np.zeros(task.num_rows, bool)
            for x, y in _partners(task, _registers(task.column("registers")), share):
                wanted[y] = True
                wanted[x] |= len(y) > 0
            if wanted.any():
                yield task.filter(pa.array(wanted))

    return promising


def _links(share: tuple[int, int], width: int):
    """Links of a task, confirmed on full sets; none between members that are linked already."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _tasks(batches):
            regs, sets, groups = _registers(task.column("registers")), shingle_sets(task.column("text"), width), Groups(task.num_rows)
            found = []
            for x, partners in _partners(task, regs, share):
                for y in partners.tolist():
                    if groups.top(x) != groups.top(y) and linked(sets[x], sets[y], share):
                        groups.join(x, y)
                        found.append((x, y))
            if found:
                node = task.column("node")
                yield pa.RecordBatch.from_arrays([node.take(pa.array([p[k] for p in found])) for k in (0, 1)], ["a", "b"])

    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of (a, b) reaches.

    Each round takes the smallest label among neighbours and then the label's own label; labels are written between
    rounds, so the plan stays short and a lost executor costs one round.
    """
    both = saved(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "node"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        jumped = lower.join(labels.select(F.col("node").alias("to"), F.col("label").alias("further")), "to", "left").select(
            "node", "old", F.least("to", F.coalesce("further", "to")).alias("label"))
        step = saved(jumped, "labels")
        labels = step.select("node", "label")
        if step.filter("old <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")


def near_duplicates(docs: DataFrame, share: tuple[int, int] = SHARE, block: int = 512, width: int = SHINGLE) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Band groups of more than ``block`` nodes are dealt into blocks, and each pair of blocks is one task, so no task
    holds more than two blocks whatever the size of a group, and no partner is left out.  A pair is looked at in the first
    band it shares only.

    Defined cases: a text that is null or without words is linked with nothing; so is a row without ``doc_id``, whose
    component is null and which is kept; rows of one ``doc_id`` are one node; further columns are left out; an empty
    table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed_docs = saved(docs.mapInArrow(_signatures(width), "doc_id long, n_shingles long, low long, high long, registers binary"), "signatures")
    usable = signed_docs.filter("n_shingles > 0 and doc_id is not null")
    first = usable.groupBy("low", "high").agg(F.min("doc_id").alias("node"))
    # By id as well as by set, so the copies of one text do not meet in one task.
    node_rows = usable.join(first.select(F.col("node").alias("doc_id"), "low", "high"), ["doc_id", "low", "high"])
    nodes = saved(node_rows.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "registers")
                  .dropDuplicates(["node", "registers"]), "set-nodes")
    bands = nodes.select("node", "registers").mapInArrow(_bands, "key long, band int, node long")
    groups = bands.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    k = F.ceil(F.col("m") / block).cast("int")
    members = (bands.join(groups, "key").withColumn("k", k).withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
               .select("key", "band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node"))
    task = ["key", "band", "lo", "hi"]
    rows = "key long, band int, lo int, hi int, own int, node long, n long, registers binary"
    wanted = saved(members.join(nodes.hint("merge"), "node").select(*(f.split()[0] for f in rows.split(", "))).repartition(*task)
                   .sortWithinPartitions(*task).mapInArrow(_promising(share), rows), "candidates")
    texts = saved(docs.join(wanted.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
                  .withColumnRenamed("doc_id", "node").distinct(), "candidate-texts")
    edges = saved(wanted.join(texts, "node").select(*task, "own", "node", "n", "registers", "text").repartition(*task)
                  .sortWithinPartitions(*task).mapInArrow(_links(share, width), "a long, b long"), "links")
    found = components(edges)
    one_set = F.struct("low", "high").alias("one_set")
    named = saved(first.join(found, "node", "left").select(one_set, F.coalesce("component", "node").alias("component_id")), "set-names")
    linked = looked_up(usable.select("doc_id", "n_shingles", one_set), named, "one_set").select("doc_id", "n_shingles", "component_id")
    alone = signed_docs.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, share: tuple[int, int] = SHARE, width: int = SHINGLE) -> DataFrame:
    """The documents, with all their columns, that are the first of their component."""
    (lost,) = fresh(docs, "lost")
    gone = near_duplicates(docs, share, width=width).filter("not kept").select(F.col("doc_id").alias(lost)).distinct()
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone[lost], "left_anti")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP5_SQL = f"""
with recursive d as materialized (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as w from documents),
shingles as materialized (
  select distinct doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) as i from d where len(w) > 0)),
sizes as materialized (select doc_id, count(*) as n from shingles group by 1),
common as materialized (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where {SHARE[1]} * common.n >= {SHARE[0]} * (x.n + y.n - common.n)),
edges as materialized (select a, b from links union all select b, a from links),
reached as (select doc_id as a, doc_id as b from d union select r.a, e.b from reached r join edges e on r.b = e.a),
named as (select a as doc_id, min(b) as component_id from reached group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from d left join sizes using (doc_id) join named using (doc_id)
"""

QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLES = {"op5_near_duplicates": OP5_SQL}
