"""Language of every text by a bidirectional gated recurrent network over bytes.

A text is cut into runs of letters, lower-cased; each run with a blank on both sides is one sequence of bytes (a longer
run several).  Two gated recurrent layers read it from both ends and label every position with language probabilities;
a document's probabilities are the mean over all positions of its whole text.  Equal runs have equal labels, so a task
labels each distinct run once.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled documents, chosen by a
hash of ``doc_id`` (about ``SAMPLE`` per language).  ``lang``, ``source`` and ``doc_id`` are no inputs of a prediction.

Defined cases: a null text and one without letters are ``und`` with score 0; without any labelled document all are
``und``; rows with null ``doc_id`` are labelled but never learned from; repeated rows are labelled each; further columns
are left out; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import pieces, read

SAMPLE = 400  # labelled documents per language that training may read, about
UNITS, STEPS, BATCH, RATE = 16, 400, 256, 0.01
RUN_BYTES = 32  # bytes of a sequence, without its blanks
MEMO_RUNS = 1 << 17  # runs a task remembers at once
UNDEFINED = "und"
Layer = dict[str, np.ndarray]


class Model(NamedTuple):
    languages: list[str]
    ahead: Layer
    back: Layer
    out: np.ndarray  # both layers' states to languages
    bias: np.ndarray


def letter_runs(text: pa.Array) -> pa.ListArray:
    """Lower-cased runs of letters of each text, in order; runs may be empty at the ends."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(text, "")), pattern=r"[^\p{L}]+", replacement=" ")
    return pc.split_pattern(spaced, " ")


def sequences(runs: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Byte sequences between blanks, and the run each belongs to."""
    found, owner = [], []
    for number, run in enumerate(runs):
        raw = run.encode()
        for start in range(0, len(raw), RUN_BYTES):
            found.append(b" " + raw[start:start + RUN_BYTES] + b" ")
            owner.append(number)
    return found, np.array(owner, np.int64)


def padded(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes from both ends as matrices, and lengths."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.frombuffer(b"".join(found), np.uint8)
    place = np.arange(sizes.max())
    real = place < sizes[:, None]
    first = np.cumsum(sizes) - sizes
    ahead = np.where(real, flat[np.minimum(first[:, None] + place, len(flat) - 1)], 32)
    back = np.where(real, flat[np.maximum(first[:, None] + sizes[:, None] - 1 - place, 0)], 32)
    return ahead, back, sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _forward(layer: Layer, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each byte: (sequence, place, unit)."""
    units = layer["state"].shape[0]
    h = np.zeros((len(x), units), np.float32)
    states = np.empty((x.shape[1], len(x), units), np.float32)
    for t in range(x.shape[1]):
        given, held = layer["byte"][x[:, t]], h @ layer["state"]
        gates = _sigmoid(given[:, :2 * units] + held[:, :2 * units])
        reset, keep = gates[:, :units], gates[:, units:]
        new = np.tanh(given[:, 2 * units:] + reset * held[:, 2 * units:])
        if trace is not None:
            trace.append((h, reset, keep, new, held[:, 2 * units:]))
        h = new + keep * (h - new)
        states[t] = h
    return states.transpose(1, 0, 2)


def _backward(layer: Layer, x: np.ndarray, trace: list, grad: np.ndarray) -> Layer:
    """Gradients of a layer from those of its states, back through time."""
    units = layer["state"].shape[0]
    d_byte, d_state = np.zeros_like(layer["byte"]), np.zeros_like(layer["state"])
    carried = np.zeros((len(x), units), np.float32)
    for t in range(x.shape[1] - 1, -1, -1):
        h, reset, keep, new, held = trace[t]
        d = grad[:, t] + carried
        d_new = d * (1 - keep) * (1 - new * new)
        d_keep = d * (h - new) * keep * (1 - keep)
        d_reset = d_new * held * reset * (1 - reset)
        given = np.concatenate([d_reset, d_keep, d_new], axis=1)
        held_grad = np.concatenate([d_reset, d_keep, d_new * reset], axis=1)
        np.add.at(d_byte, x[:, t], given)
        d_state += h.T @ held_grad
        carried = d * keep + held_grad @ layer["state"].T
    return {"byte": d_byte, "state": d_state}


def _reversed(states: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Entries of each sequence in the opposite order; what lies beyond its end stays somewhere beyond."""
    at = (sizes[:, None] - 1 - np.arange(states.shape[1])) % states.shape[1]
    return np.take_along_axis(states, at[:, :, None], axis=1)


def probabilities(model: Model, found: list[bytes]) -> np.ndarray:
    """Sum of the positions' language probabilities, for each sequence."""
    sums = np.zeros((len(found), len(model.languages)))
    order = np.argsort(np.fromiter(map(len, found), np.int64, len(found)), kind="stable")
    for start in range(0, len(order), 4096):
        rows = order[start:start + 4096]
        ahead, back, sizes = padded([found[i] for i in rows])
        both = np.concatenate([_forward(model.ahead, ahead), _reversed(_forward(model.back, back), sizes)], axis=2)
        logits = both @ model.out + model.bias
        share = np.exp(logits - logits.max(axis=2, keepdims=True))
        share /= share.sum(axis=2, keepdims=True)
        share *= (np.arange(share.shape[1]) < sizes[:, None])[:, :, None]
        sums[rows] = share.sum(axis=1)
    return sums


def train(runs: list[tuple[str, str, int]], languages: list[str], units: int = UNITS, steps: int = STEPS,
          batch: int = BATCH, rate: float = RATE, seed: int = 7) -> Model:
    """Fit the network to (run, language, count): every position is to get its document's language."""
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.25, shape).astype(np.float32)

    weights = {"ahead.byte": start(256, 3 * units), "ahead.state": start(units, 3 * units),
               "back.byte": start(256, 3 * units), "back.state": start(units, 3 * units),
               "out": start(2 * units, len(languages)), "bias": np.zeros(len(languages), np.float32)}
    found, owner = sequences([run for run, _, _ in runs])
    truth = np.array([languages.index(lang) for _, lang, _ in runs])[owner]
    likely = np.sqrt([count for _, _, count in runs])[owner]
    for label in range(len(languages)):  # languages count alike
        likely[truth == label] /= max(likely[truth == label].sum(), 1e-9)
    chosen = rng.choice(len(found), (steps, batch), p=likely / likely.sum())
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in weights.items()}
    for step in range(steps):
        ahead, back, sizes = padded([found[i] for i in chosen[step]])
        layers = [{k: weights[f"{side}.{k}"] for k in ("byte", "state")} for side in ("ahead", "back")]
        traces: tuple[list, list] = ([], [])
        both = np.concatenate([_forward(layers[0], ahead, traces[0]),
                               _reversed(_forward(layers[1], back, traces[1]), sizes)], axis=2)
        logits = both @ weights["out"] + weights["bias"]
        share = np.exp(logits - logits.max(axis=2, keepdims=True))
        share /= share.sum(axis=2, keepdims=True)
        real = np.arange(both.shape[1]) < sizes[:, None]
        wrong = share - np.eye(len(languages), dtype=np.float32)[truth[chosen[step]]][:, None, :]
        wrong *= (real / real.sum())[:, :, None].astype(np.float32)
        d_both = wrong @ weights["out"].T
        grads = {"out": np.einsum("btu,btl->ul", both, wrong), "bias": wrong.sum(axis=(0, 1))}
        for side, layer, x, trace, grad in (
                ("ahead", layers[0], ahead, traces[0], d_both[:, :, :units]),
                ("back", layers[1], back, traces[1], _reversed(d_both[:, :, units:], sizes) * real[:, :, None])):
            grads |= {f"{side}.{k}": g for k, g in _backward(layer, x, trace, grad).items()}
        now = rate * min(1, 3 * (1 - step / steps))
        for key, grad in grads.items():
            first, second = moments[key]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            weights[key] -= (now * first / (1 - 0.9 ** (step + 1)) / (np.sqrt(second / (1 - 0.99 ** (step + 1))) + 1e-8)).astype(np.float32)
    return Model(languages, {k: weights[f"ahead.{k}"] for k in ("byte", "state")},
                 {k: weights[f"back.{k}"] for k in ("byte", "state")}, weights["out"], weights["bias"])


def held_out() -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on a bounded sample: about ``sample`` documents of each language, the same for the same documents."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)
    runs: Counter[tuple[str, str]] = Counter()
    for row in labelled.filter(drawn).select("lang", "text").toLocalIterator():
        runs.update((run, row["lang"]) for run in letter_runs(pa.array([row["text"]]))[0].as_py() if run)
    languages = sorted({lang for _, lang in runs})
    return train([(run, lang, n) for (run, lang), n in sorted(runs.items())], languages) if runs else None


def _label(model: Model | None, keep_text: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = model.languages if model else []
        known: dict[str, np.ndarray] = {"": np.zeros(len(languages) + 1)}
        for batch in pieces(batches):
            lists = letter_runs(batch.column("text"))
            coded = lists.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            fresh = [run for run in distinct if run not in known]
            if fresh and model:
                found, owner = sequences(fresh)
                sums = np.zeros((len(fresh), len(languages) + 1))
                np.add.at(sums[:, :-1], owner, probabilities(model, found))
                np.add.at(sums[:, -1], owner, [len(x) for x in found])
                known.update(zip(fresh, sums, strict=True))
            if model:
                values = np.array([known[run] for run in distinct])[coded.indices.to_numpy()]
                bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                pooled = np.add.reduceat(values, bounds[:-1], axis=0)  # every text has a run, if an empty one
            else:
                pooled = np.zeros((batch.num_rows, 1))
            total = pooled[:, -1]
            if languages:
                mean = pooled[:, :-1] / np.maximum(total, 1)[:, None]
                best = mean.argmax(axis=1)
                names = np.where(total > 0, np.array(languages, object)[best], UNDEFINED)
                score = np.where(total > 0, mean[np.arange(len(best)), best], 0.0)
            else:
                names, score = np.full(batch.num_rows, UNDEFINED, object), np.zeros(batch.num_rows)
            keep = [c for c in batch.schema.names if keep_text or c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names.tolist(), pa.string()), pa.array(np.clip(score, 0, 1))],
                [*keep, "lang_pred", "score"])
            if len(known) > MEMO_RUNS:
                known = {"": known[""]}

    return label


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document, from its whole text alone."""
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")).mapInArrow(
        _label(model), "doc_id long, held_out boolean, lang_pred string, score double")


def labelled(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents with all their columns, and ``lang_pred`` and ``score`` in place of columns of these names."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    given = docs.select(*names).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))
    return docs.select(*names).mapInArrow(_label(model, keep_text=True), given.schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


QUERIES = {"op4_language": op4_language}
ORACLES: dict[str, str] = {}
