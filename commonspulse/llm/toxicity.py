"""Toxicity of every text by a linear model over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of ``SIZES`` characters of the lower-cased text between two blanks, as
buckets of a hash.  Counts of the toxic and the other labelled documents that hold a bucket, over all labelled
documents, give its ratio

    r = log((toxic + t) / (all toxic + t)) - log((other + o) / (all other + o))

with ``t`` and ``o`` together ``SMOOTHING``, in the proportion of the classes, so a bucket seen rarely or never has a
ratio near zero; below ``LEAST_RATIO`` it is no feature.  A text is the vector of its ratios, divided by its length
(root of the sum of squares, and one); a logistic regression over such vectors gives the score.

The regression is fitted in numpy on a bounded sample of labelled documents, drawn by a hash of ``doc_id``: about
``SAMPLE`` of each class and ``SAMPLE_CHARS`` characters in all, weighted so that the classes count as in all labelled
documents.  Labels, ``lang``, ``source`` and ``doc_id`` are no inputs of a score.

Defined cases: a null text counts as empty; an empty text has no features, so its score is that of the intercept;
without labelled documents every score is 0, with one class only it is that class; a document marked more than once is
toxic if any mark says so; repeated rows of a labelled ``doc_id`` count each; rows with null ``doc_id`` are scored but
never learned from; further columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import mixed, pieces, read, saved

SIZES = (4, 5, 6)
BITS = 20  # of a bucket
SMOOTHING, LEAST_RATIO = 200.0, 0.02
SAMPLE, SAMPLE_CHARS = 4000, 24 << 20
STEPS, RATE, PENALTY = 80, 0.1, 0.1
MOST_MARKS = 1 << 22  # labelled ids, 12 bytes each, that are sent to the texts
TOXIC = 0.3  # score from which a text is called toxic
WINDOW = 1 << 18  # characters hashed at once
GROUP = 1 << 20  # entries of the sample worked on at once
SLICE = 1 << 12  # buckets whose counts travel together
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    ratio: np.ndarray  # of each bucket
    weight: np.ndarray
    bias: float


def _buckets(codes: np.ndarray) -> list[np.ndarray]:
    """For each size, the bucket of the n-gram from each character on."""
    found, h = [], np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for place in range(max(SIZES)):
            h = h[:max(0, len(codes) - place)] * _ODD + codes[place:] + np.uint64(1)
            if place + 1 in SIZES:
                found.append((mixed(h + np.uint64(place)) >> np.uint64(64 - BITS)).astype(np.int64))
    return found


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each lower-cased text, one text after the other, and the number of the text of each."""
    longest = WINDOW - max(SIZES)
    found, owners, group = [], [], []

    def settle() -> None:
        if group:
            codes = np.frombuffer("".join(f" {texts[i]} " for i in group).encode("utf-32-le"), np.uint32).astype(np.uint64)
            ends = np.cumsum([len(texts[i]) + 2 for i in group])
            owner = np.repeat(np.arange(len(group)), np.diff(ends, prepend=0))
            keys = []
            for size, buckets in zip(SIZES, _buckets(codes), strict=True):
                own = owner[:len(buckets)]
                inside = np.arange(len(buckets)) + size <= ends[own]
                keys.append((own[inside] << BITS) | buckets[inside])
            keys = np.sort(np.concatenate(keys))
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
            found.append((keys & ((1 << BITS) - 1)).astype(np.int32))
            owners.append(np.array(group, np.int64)[keys >> BITS])
            group.clear()

    held = 0
    for number, text in enumerate(texts):
        if held + len(text) > longest:
            settle()
            held = 0
        if len(text) <= longest:
            group.append(number)
            held += len(text) + 2
            continue
        seen = np.zeros(1 << BITS, bool)  # a long text goes in windows that overlap
        padded = f" {text} "
        for start in range(0, len(padded), longest):
            codes = np.frombuffer(padded[start:start + longest + max(SIZES) - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
            for buckets in _buckets(codes):
                seen[buckets] = True
        found.append(np.flatnonzero(seen).astype(np.int32))
        owners.append(np.full(len(found[-1]), number, np.int64))
    settle()
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return pc.utf8_lower(pc.fill_null(batch.column("text"), "")).to_pylist()


def ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Naive Bayes log-count ratio of every bucket, from the documents of each class that hold it."""
    t, o = (SMOOTHING * n / (n_toxic + n_other) for n in (n_toxic, n_other))
    ratio = np.log((toxic + t) / (n_toxic + t)) - np.log((other + o) / (n_other + o))
    return np.where(np.abs(ratio) >= LEAST_RATIO, ratio, 0.0)


def class_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and other documents that hold each bucket, over all rows (text, toxic).

    Tasks send slices of their counts; a second set of tasks adds them up as they come in, so nothing grows with the
    number of documents.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.uint32)
        for batch in pieces(batches):
            ids, owner = features(_texts(batch))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[owner]
            for side in (0, 1):
                total[side] += np.bincount(ids[toxic == side], minlength=1 << BITS).astype(np.uint32)
        total = total.reshape(2, -1, SLICE)
        at = np.flatnonzero(total.any(axis=(0, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([total[:, k].tobytes() for k in at], pa.binary())], ["at", "counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column("at").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                totals[at] = totals.get(at, 0) + np.frombuffer(raw, np.uint32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([x.tobytes() for x in totals.values()], pa.binary())], ["at", "counts"])

    schema = "at long, counts binary"
    total = np.zeros((2, (1 << BITS) // SLICE, SLICE), np.int64)
    rows = labelled.select("text", "toxic").mapInArrow(counts, schema).repartition(32, "at").mapInArrow(added, schema)
    for row in rows.toLocalIterator():  # as many rows as there are slices
        total[:, row["at"]] = np.frombuffer(row["counts"], np.int64).reshape(2, SLICE)
    return total[0].ravel(), total[1].ravel()  # other, toxic


def regression(rows: list[tuple[np.ndarray, int, float]], ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept from rows (buckets, label, weight), by gradient steps with momentum on the log loss."""
    present = np.zeros(len(ratio), bool)
    for ids, _, _ in rows:
        present[ids] = True
    at = np.flatnonzero(present)
    number = np.zeros(len(ratio), np.int32)
    number[at] = np.arange(len(at))
    sizes = np.array([len(ids) for ids, _, _ in rows])
    ends = np.cumsum(sizes)
    columns, shrink = np.empty(ends[-1], np.int32), np.empty(len(rows))
    for k, (ids, _, _) in enumerate(rows):
        columns[ends[k] - sizes[k]:ends[k]] = number[ids]
        shrink[k] = 1 / np.sqrt((ratio[ids] ** 2).sum() + 1)
    truth = np.array([label for _, label, _ in rows], float)
    share = np.array([weight for _, _, weight in rows])
    share /= share.sum()
    own_ratio = ratio[at]
    # Rows go in groups of about ``GROUP`` entries, so that what is computed of them stays small.
    cuts = [0, *(np.flatnonzero(np.diff(ends // GROUP)) + 1).tolist(), len(rows)]
    groups = [(slice(a, b), columns[ends[a] - sizes[a]:ends[b - 1]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    w, bias = np.zeros(len(at)), float(np.log(share @ truth) - np.log(1 - share @ truth))
    first, second = np.zeros(len(at) + 1), np.zeros(len(at) + 1)
    for step in range(STEPS):
        steepest, lean, scaled = np.zeros(len(at)), 0.0, own_ratio * w
        for group, own in groups:
            n = sizes[group]
            full = n > 0
            z = np.full(len(n), bias)
            if len(own):
                z[full] += shrink[group][full] * np.add.reduceat(scaled[own], (np.cumsum(n) - n)[full])
            wrong = share[group] * (1 / (1 + np.exp(-z)) - truth[group])
            steepest += np.bincount(own, np.repeat(wrong * shrink[group], n), len(at))
            lean += wrong.sum()
        grad = np.append(own_ratio * steepest + PENALTY / len(rows) * w, lean)
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        change = RATE * min(1, 3 * (1 - step / STEPS)) * first / (1 - 0.9 ** (step + 1)) / (np.sqrt(second / (1 - 0.99 ** (step + 1))) + 1e-8)
        w, bias = w - change[:-1], bias - change[-1]
    weight = np.zeros(len(ratio))
    weight[at] = w
    return weight, float(bias)


def held_out() -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled documents that may be learned from."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    marks = saved(marks, "toxic-marks")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(
        F.col("doc_id").isNotNull() & ~held_out())
    if marks.count() <= MOST_MARKS:
        return texts.join(F.broadcast(marks), "doc_id")
    return saved(texts.join(marks, "doc_id"), "labelled-texts")  # texts are shuffled once, however often they are read


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Ratios from all labelled documents, weights from a bounded sample of them."""
    labelled = training_rows(docs, labels)
    counts = {r["toxic"]: (r["n"], r["chars"]) for r in labelled.groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    nothing = np.zeros(1 << BITS)
    if len(counts) < 2:
        return Model(nothing, nothing, np.inf if 1 in counts else -np.inf)
    other, toxic = class_counts(labelled)
    ratio = ratios(toxic, other, counts[1][0], counts[0][0])
    used = labelled.sparkSession.sparkContext.broadcast(ratio != 0)  # a flag for each of the buckets
    share = {label: min(1.0, SAMPLE / n, SAMPLE_CHARS / 2 / max(chars, 1)) for label, (n, chars) in counts.items()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxic sample")), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 30)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, owner = features(_texts(batch))
            kept = used.value[ids]
            bounds = np.searchsorted(owner[kept], np.arange(batch.num_rows + 1))
            ids = ids[kept]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array([ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                                             ["doc_id", "toxic", "ids"])

    rows = [(r["doc_id"], np.frombuffer(r["ids"], np.int32), r["toxic"]) for r in labelled.filter(drawn).select("doc_id", "text", "toxic").mapInArrow(
        sampled, "doc_id long, toxic int, ids binary").toLocalIterator()]
    rows.sort(key=lambda r: (r[0], r[2], r[1].tobytes()))  # the same model whatever the order of the rows
    if len({label for _, _, label in rows}) < 2:  # a class too small for the draw: its share alone
        return Model(nothing, nothing, float(np.log(counts[1][0] / counts[0][0])))
    return Model(ratio, *regression([(ids, label, 1 / share[label]) for _, ids, label in rows], ratio))


def scores(texts: list[str], model: Model) -> np.ndarray:
    """Of lower-cased texts."""
    ids, owner = features(texts)
    ratio = model.ratio[ids]
    length = np.sqrt(np.bincount(owner, ratio * ratio, len(texts)) + 1)
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-(np.bincount(owner, ratio * model.weight[ids], len(texts)) / length + model.bias)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # its size is set by BITS

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            score = scores(_texts(batch), Model(*sent.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= TOXIC).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(
        label, "doc_id long, held_out boolean, score double, predicted int")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, fit(docs, read(spark, sf_dir, "labels")))


QUERIES = {"op12_toxicity": op12_toxicity}
ORACLES: dict[str, str] = {}
