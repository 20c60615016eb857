"""Vector codes, toxicity and phrases against brute force, with nulls, empty rows, ties, repeats and clashing names."""

import collections
import math
import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commonspulse.llm import collocations, common, toxicity, vector_codes

SF_DIR = "/root/testdata/sf0.01"


# --- vector codes


def naive_codes(rows, parts, entries, rounds):
    """Rows (vec_id, vector) by plain loops over whole numbers."""
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v in rows) // parts))
    rows = [(i, v + [0] * (parts * width - len(v))) for i, v in rows]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((far(x, c), k) for k, c in enumerate(book))
    for step in range(rounds + 1):
        told = [[nearest(cut(v, p), books[p]) for p in range(parts)] for _, v in rows]
        if step == rounds:
            return books, sorted((i is None, i or 0, bytes(k for _, k in t).hex(), sum(d for d, _ in t)) for (i, _), t in zip(rows, told, strict=True))
        for p in range(parts):
            for k in range(len(first)):
                own = [cut(v, p) for (_, v), t in zip(rows, told, strict=True) if t[p][1] == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own, strict=True)]


def coded(spark, rows, **sizes):
    frame = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, label int, entry int, key int")
    found = vector_codes.encode(frame, **sizes)
    return found, sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in found.rows.collect())


@pytest.mark.parametrize("rounds", [0, 1, 2, 6])
def test_codes_equal_plain_loops(spark, rounds):
    rng = random.Random(rounds)
    centres = [[rng.uniform(-1, 1) for _ in range(12)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(150)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (500, None), (501, [float("nan")] * 12), (502, [0.5, None]), (503, [float("inf")] * 12),
             (-1, []), (504, [0.25] * 5), (505, [0.0] * 12), (506, [0.0] * 12), (507, [-300.0] * 12)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found, told = coded(spark, rows, parts=4, entries=16, rounds=rounds)
    books, expected = naive_codes(rows, 4, 16, rounds)
    assert told == expected
    assert found.books.tolist() == books
    assert found.kept[0] == 4 and found.kept[-1] >= 2 and found.kept == sorted(found.kept, reverse=True)


def test_codes_of_small_and_empty_tables(spark):
    rows = [(2, [1.0, 2.0]), (1, [1.0, 2.0]), (7, [1.0, 2.0])]
    assert coded(spark, rows, parts=2, entries=64, rounds=2)[1] == naive_codes(rows, 2, 64, 2)[1]
    assert coded(spark, [(1, [0.5])], parts=16)[1] == [(False, 1, "00" * 16, 0)]
    assert coded(spark, [])[1] == coded(spark, [(1, None)])[1] == []
    with pytest.raises(Exception, match="too large"):
        coded(spark, [(1, [1e9])])


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(3)
    entries = rng.integers(-300, 300, (64, 4))
    x = entries[rng.integers(0, 64, 4000)] + rng.integers(-20, 20, (4000, 4))
    held = vector_codes.measured(x, entries, 16)
    for _ in range(5):
        after = entries + rng.integers(-3, 4, entries.shape)
        held, need = vector_codes.reassigned(x, after, held, vector_codes.moved(entries, after), 16)
        entries = after
        d2 = vector_codes.distances(x, entries)
        assert (held.entry == d2.argmin(axis=1)).all()
        real = np.sqrt(d2)
        assert (held.upper >= real[np.arange(len(x)), held.entry]).all()
        assert (held.lower[:, :-1] <= np.take_along_axis(real, held.near.astype(int), axis=1)).all()
        others = real.copy()
        np.put_along_axis(others, np.hstack([held.entry[:, None], held.near]).astype(int), np.inf, axis=1)
        assert (held.lower[:, -1] <= others.min(axis=1)).all()
        assert (need == 0).mean() > 0.5 and (need == 17).mean() < 0.1


def test_equal_distances_go_to_the_lower_index():
    entries = np.array([[2, 0], [0, 2], [-2, 0], [0, 0], [0, 0]])
    x = np.array([[1, 1], [1, 0], [0, 0], [-1, 1], [2, 2]])
    held = vector_codes.measured(x, entries, 2)
    assert held.entry.tolist() == [0, 0, 3, 1, 0]
    again, _ = vector_codes.reassigned(x, entries, held._replace(entry=np.array([1, 3, 4, 2, 1], np.uint8), near=np.array([[0, 3], [0, 4], [3, 0], [1, 3], [0, 3]], np.uint8),
                                       upper=np.full(5, 1e9), lower=np.zeros((5, 3), np.float32)), np.zeros(5), 2)
    assert again.entry.tolist() == [0, 0, 3, 1, 0]


def test_large_components_are_measured_exactly():
    x, entries = np.array([[(1 << 24) - 1] * 16, [1] * 16]), np.array([[-(1 << 24)] * 16, [-(1 << 24) + 1] * 16])
    assert vector_codes.distances(x, entries).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c, strict=True)) for c in entries] for r in x]


def test_hot_keys_are_looked_up_like_all_others(spark):
    frame = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(6000)], "key string, i int").cache()
    table = frame.select("key").distinct().withColumn("value", F.length("key"))
    expected = sorted(map(tuple, frame.join(table, "key").collect()))
    assert sorted(map(tuple, common.looked_up(frame, table, "key").collect())) == expected
    assert sorted(map(tuple, common.looked_up(frame, table, "key", F.length("key") > 3).collect())) == expected


# --- toxicity


def naive_features(text):
    text = f" {text.lower()} "
    found = set()
    for size in toxicity.SIZES:
        for at in range(len(text) - size + 1):
            h = 0
            for letter in text[at:at + size]:
                h = (h * 0x9E3779B97F4A7C15 + ord(letter) + 1) % (1 << 64)
            h = (h + size - 1) % (1 << 64)
            h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
            h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) % (1 << 64)
            found.add((h ^ (h >> 31)) >> (64 - toxicity.BITS))
    return found


def told(ids, owner, n):
    return [set(ids[owner == k].tolist()) for k in range(n)]


def test_features_equal_plain_loops(monkeypatch):
    texts = ["", "a", "ab", "Éx y\n☃☃☃", "same", "same", "word " * 300, "x" * 700, "no"]
    expected = [naive_features(t) for t in texts]
    lowered = [t.lower() for t in texts]
    assert told(*toxicity.features(lowered), len(texts)) == expected
    monkeypatch.setattr(toxicity, "WINDOW", 100)
    assert told(*toxicity.features(lowered), len(texts)) == expected
    assert toxicity.features([])[0].size == 0


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.fit(docs, labels)


def test_ratios_and_scores_equal_plain_loops(learned):
    docs, labels, model = learned
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    counts, n = (collections.Counter(), collections.Counter()), [0, 0]
    for doc, toxic in marks.items():
        if doc in texts and zlib.crc32(str(doc).encode()) % 4 != 2:
            counts[toxic].update(naive_features(texts[doc]))
            n[toxic] += 1
    smooth = [toxicity.SMOOTHING * c / sum(n) for c in n]
    for bucket in random.Random(1).sample(sorted(counts[1] | counts[0]), 3000) + [0, 1]:
        ratio = math.log((counts[1][bucket] + smooth[1]) / (n[1] + smooth[1])) - math.log((counts[0][bucket] + smooth[0]) / (n[0] + smooth[0]))
        assert model.ratio[bucket] == pytest.approx(ratio if abs(ratio) >= toxicity.LEAST_RATIO else 0, abs=1e-9)
    rows = {r["doc_id"]: r for r in toxicity.predict(docs, model).collect()}
    assert len(rows) == docs.count()
    for doc in sorted(texts)[:40]:
        ids = sorted(naive_features(texts[doc]))
        length = math.sqrt(sum(model.ratio[i] ** 2 for i in ids) + 1)
        score = 1 / (1 + math.exp(-(sum(model.ratio[i] * model.weight[i] for i in ids) / length + model.bias)))
        assert rows[doc]["score"] == pytest.approx(score, abs=1e-9)
        assert rows[doc]["predicted"] == (rows[doc]["score"] >= 0.3)
        assert rows[doc]["held_out"] == (zlib.crc32(str(doc).encode()) % 4 == 2)


def test_regression_meets_its_condition():
    rng = np.random.default_rng(5)
    ratio = rng.normal(0, 1, 40)
    rows = [(np.sort(rng.choice(40, 8, replace=False)), int(k % 4 == 0), 1.0) for k in range(200)]
    weight, bias = toxicity.regression(rows, ratio)

    def loss(w, b):
        total = 0.0
        for ids, label, _ in rows:
            values = ratio[ids] / math.sqrt((ratio[ids] ** 2).sum() + 1)
            z = values @ w[ids] + b
            total += math.log1p(math.exp(-z if label else z)) / len(rows)
        return total + toxicity.PENALTY / len(rows) / 2 * (w @ w)

    at = loss(weight, bias)
    assert at < loss(np.zeros(40), math.log(0.25 / 0.75)) - 0.01
    for k in range(0, 40, 5):  # no step along a weight gains much
        for step in (-0.05, 0.05):
            other = weight.copy()
            other[k] += step
            assert loss(other, bias) > at - 1e-3


def test_toxicity_on_held_out_documents(learned):
    docs, labels, model = learned
    rows = toxicity.predict(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    wrong = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(caught) / len(caught) > 0.5 and sum(wrong) / len(wrong) < 0.03


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(k, t, "en", 1, 1) for k, t in enumerate(["you idiot fool " * 5, "kind words here"] * 20)] + [
        (None, "you idiot fool", "en", 1, 1), (90, None, None, 1, 1), (91, "", None, 1, 1), (92, "y" * 400_000, None, 1, 1), (0, "you idiot fool " * 5, "en", 1, 1)],
        "doc_id long, text string, lang string, toxic int, score int")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(40)] + [(0, 0, 0), (1, None, 0), (None, 1, 0)], "doc_id long, toxic int, text int")
    rows = toxicity.predict(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == 45
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert [r["predicted"] for r in by_id[0]] == [1, 1] and by_id[0][0]["score"] == by_id[0][1]["score"]
    assert by_id[1][0]["predicted"] == 0 and by_id[None][0]["score"] > by_id[1][0]["score"] and not by_id[None][0]["held_out"]
    assert by_id[90][0]["score"] == by_id[91][0]["score"] and 0 <= by_id[92][0]["score"] <= 1
    one = labels.filter("toxic = 1")
    assert {r["score"] for r in toxicity.predict(docs, toxicity.fit(docs, one)).collect()} == {1.0}
    assert {r["score"] for r in toxicity.predict(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.predict(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []


# --- phrases


def naive_phrases(rows, least, longest, top):
    pieces, words, f = [], collections.Counter(), collections.Counter()
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\x0a\x0b\x0c\x0d":
            lowered = lowered.replace(mark, "\x0a")
        pieces += [(lang if lang is not None else "und", [w for w in p.replace("\t", " ").split(" ") if w]) for p in lowered.split("\x0a")]
    for lang, piece in pieces:
        words[lang] += len(piece)
        f.update((lang, tuple(piece[i:i + n])) for n in range(1, longest + 1) for i in range(len(piece) - n + 1))
    candidates = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    held = set()
    for (lang, g), a in candidates.items():
        held |= {(lang, g[i:i + n]) for n in range(2, len(g)) for i in range(len(g) - n + 1) if a >= f[lang, g[i:i + n]]}
    found = collections.defaultdict(list)
    for (lang, g), a in candidates.items():
        if (lang, g) not in held:
            score, _, l, r = min((1000 * a * words[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
            found[lang].append((-score, -a, " ".join(g).encode(), l, r))
    return sorted((lang, rank, phrase.decode(), -a, l, r, words[lang], -score) for lang, rows in found.items()
                  for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1))


@pytest.mark.parametrize(("least", "longest", "top"), [(3, 5, 2000), (2, 3, 7), (1, 4, 5), (50, 5, 10)])
def test_phrases_equal_plain_loops(spark, least, longest, top):
    rng = random.Random(least)
    names = ["the", "of", "New", "york", "é", "a　b", "x" * 5000]
    rows = [(" ".join(rng.choices(names, [9, 6, 3, 3, 2, 1, 1], k=rng.randint(1, 40))) + rng.choice([". ", "\n", "\t\t", " \x0b", ""]) + "the new york of the", rng.choice(["en", "de", None, "und"]))
            for _ in range(40)]
    rows += [(None, "en"), ("", "en"), ("...", "fr"), ("  \t ", None), rows[0], rows[0], ("a a a a a a a", "fr"), ("one", "xx"), ("end", "en"), ("start", "en")]
    docs = spark.createDataFrame([(k, t, lang, 1, 2, 3) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, words int, ids int, rank int").repartition(3)
    found = sorted(tuple(r) for r in collocations.collocations(docs, least, longest, top).collect())
    assert found == naive_phrases(rows, least, longest, top)


def test_phrases_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None)], docs.schema)).collect() == []


def test_filters_are_lossless(monkeypatch):
    rng = np.random.default_rng(9)
    for size, width, n, shard_bits in [(1, 64, 1, 0), (2, 64, 1000, 3), (5, 64, 5000, 0), (3, 64, 0, 2), (2, 4, 900, 3), (5, 17, 3000, 4), (4, 1, 500, 3), (3, 22, 1, 5)]:
        bits = [width * c for c in collocations.lanes_of(size, width)]
        ids = rng.integers(0, 1 << width, (n, size), np.uint64)
        lanes = collocations.packed(ids, width)
        assert (collocations.restored(collocations.permuted(lanes, bits), bits) == lanes).all()
        assert (collocations.unpacked(lanes, size, width) == ids).all()
        grams, times = np.concatenate([lanes, lanes[:n // 3]]), rng.integers(1, 400, n + n // 3)
        expected = collections.Counter()
        for gram, c in zip(grams.tolist(), times.tolist(), strict=True):
            expected[tuple(gram)] += c
        counter = collocations.Counter(bits, shard_bits)
        monkeypatch.setattr(collocations, "HELD", 200)
        for a in range(0, len(grams), 97):
            counter.add(collocations.permuted(grams[a:a + 97], bits), times[a:a + 97])
        told = {}
        for shard, raw in counter.filters():
            keys, counts = collocations.unpack(raw, bits, shard_bits, shard)
            assert (keys[1:, 0] >= keys[:-1, 0]).all()
            told |= dict(zip(map(tuple, collocations.restored(keys, bits).tolist()), counts.tolist(), strict=True))
        assert told == expected


def test_keys_alike_in_their_first_lane_stay_apart():
    keys = np.array([[7, 1], [7, 2], [7, 1], [3, 9], [7, 2], [7, 1]], np.uint64)
    found, counts = collocations.merged(keys, np.ones(6, np.int64))
    assert found.tolist() == [[3, 9], [7, 1], [7, 2]] and counts.tolist() == [1, 3, 2]
    raw = collocations.pack(found, counts, [64, 64], 0)
    assert [x.tolist() for x in collocations.unpack(raw, [64, 64], 0, 0)] == [found.tolist(), counts.tolist()]


def test_a_task_holds_one_shard_at_a_time():
    width, shard_bits, rng = 8, 2, np.random.default_rng(3)
    bits = [width * c for c in collocations.lanes_of(2, width)]
    given, expected = [], collections.Counter()
    for _ in range(3):
        ids = rng.integers(0, 100, (4000, 2), np.uint64)
        counter = collocations.Counter(bits, shard_bits)
        counter.add(collocations.permuted(collocations.packed(ids, width), bits), np.ones(len(ids), np.int64))
        given += counter.filters()
        expected.update(map(tuple, ids.tolist()))
    taken = []

    def batches():
        for shard, raw in sorted(given):
            taken.append(shard)
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([raw])], ["shard", "filter"])

    sent = SimpleNamespace(value=collocations.Numbering(np.arange(100, dtype=np.uint64), None, width))
    out, held = [], []
    for batch in collocations._added(2, shard_bits, sent, 2)(batches()):
        out += zip(map(tuple, batch.column("ids").to_pylist()), batch.column("f").to_pylist(), strict=True)
        held.append(set(taken))
    assert [len(x) for x in held] == [2, 3, 4, 4]  # a shard leaves when the first filter of the next one comes
    assert dict(out) == {g: c for g, c in expected.items() if c >= 2} and len(out) == len(dict(out))


def test_blocks_are_read_a_few_at_a_time(spark, monkeypatch):
    keys, real, read_by = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch"), collocations.saved, {}
    before = [spark.conf.get(k) for k in keys]

    def watched(frame, purpose):
        read_by.setdefault(purpose, []).append(tuple(spark.conf.get(k) for k in keys))
        if purpose == "phrases":
            read_by["tasks"] = frame.rdd.getNumPartitions()
        return real(frame, purpose)

    monkeypatch.setattr(collocations, "saved", watched)
    monkeypatch.setattr(collocations, "SHARD", 8)
    rows = [("ab cd ef ab cd ef. ab cd", "en")] * 16
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    found = sorted(tuple(r) for r in collocations.collocations(docs, 2, 3, 9).collect())
    assert found == naive_phrases(rows, 2, 3, 9)
    assert {x for purpose in ("word-blocks", "word-counts", "word-codes", "phrases") for x in read_by[purpose]} == {("4", "4m")}
    assert read_by["tasks"] == 8  # 128 words are 16 shards
    assert [spark.conf.get(k) for k in keys] == before


def test_phrases_of_more_words_than_are_sent(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_WORDS", 3)
    rng = random.Random(4)
    rows = [(" ".join(rng.choices([f"w{k}" for k in range(30)], k=60)) + " w1 w2 w3 w4", "en") for _ in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, 4, 4, 50).collect()) == naive_phrases(rows, 4, 4, 50)


def test_a_shared_word_id_takes_another_seed(spark, monkeypatch):
    real = collocations.word_id
    monkeypatch.setattr(collocations, "word_id", lambda lang, word, seed: F.length(word).cast("long") if seed < 2 else real(lang, word, seed))
    docs = spark.createDataFrame([("ab cd ab cd ab", "en")] * 2, "text string, lang string")
    found = sorted(tuple(r) for r in collocations.collocations(docs, 2, 3, 9).collect())
    assert found == naive_phrases([("ab cd ab cd ab", "en")] * 2, 2, 3, 9)


def test_scores_beyond_64_bits(spark):
    a, n = 4_000_000_000_000, 90_000_000_000_000
    words = spark.createDataFrame([("en", "x", a, 1), ("en", "y", a + 7, 2), ("en", "z", n - 2 * a - 7, 3)], "lang string, word string, f long, id long")
    counts = spark.createDataFrame([([1], a), ([2], a + 7), ([1, 2], a - 5)], "ids array<long>, f long")
    row, = collocations.scored(counts, words).collect()
    assert (row["phrase"], row["l"], row["r"], row["n"], row["score"]) == ("x y", a, a + 7, n, 1000 * (a - 5) * n // (a * (a + 7)))
