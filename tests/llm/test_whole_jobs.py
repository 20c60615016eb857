"""What operators once left out without notice: each test fails on the narrower job."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from checking import connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commonspulse.llm import bpe, chat, contamination, huffman, lines, near_duplicates
from commonspulse.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("ids", [[0, 1, 2, 3, 4], [0, 2, 4, 6, 8], [5, 2 ** 60, 2 ** 60 + 4, -7, 11]])
def test_every_conversation_has_a_preference(spark, ids):
    ids = sorted(ids)
    rows = [(i, 0, "user", f"q{i}") for i in ids] + [(i, 1, "assistant", f"r{i}") for i in ids if i != ids[2]]
    turns = spark.createDataFrame(rows, "pair_id long, turn long, role string, text string")
    found = {r["pair_id"]: r for r in chat.preferences(turns, chat.swapped_replies(turns)).collect()}
    replying = [i for i in ids if i != ids[2]]
    expected = {i: None if i not in replying else i ^ 1 if i ^ 1 in replying else min((j for j in replying if j > i), default=None) for i in ids}
    assert sorted(found) == ids
    for i, other in expected.items():
        if other is None:
            assert (found[i]["chosen"], found[i]["rejected"], found[i]["chosen_mask"], found[i]["rejected_mask"]) == ("", "", [], [])
        else:
            assert (found[i]["chosen"], found[i]["rejected"]) == (f"<|assistant|>\nr{i}<|end|>\n", f"<|assistant|>\nr{other}<|end|>\n")


def test_followers_over_many_ranges(spark):
    ids = [k * k * 7 - 900 for k in range(1000)]
    found = chat.followers(spark.createDataFrame([(i,) for i in ids], "pair_id long").repartition(5)).collect()
    assert sorted(map(tuple, found)) == list(zip(ids[:-1], ids[1:], strict=True))


def test_preferences_and_their_check_have_every_conversation(spark):
    found = chat.op6_preferences(spark, SF_DIR)
    cursor = connect(SF_DIR).execute(chat.OP6_SQL)
    names = [d[0] for d in cursor.description]
    rows = {tuple(r[n] for n in names) for r in found.collect()}
    assert set(cursor.fetchall()) == rows
    every = spark.read.parquet(f"{SF_DIR}/conversations.parquet").filter(F.col("conv_id").isNotNull()).select("conv_id").distinct().count()
    assert len(rows) == every == found.count()


def test_equal_lines_go_whatever_their_length(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen, equal, rows = set(), set(), given.select("doc_id", "text").orderBy("doc_id").collect()
    for doc, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = " ".join(line.lower().split())
            if words and words in seen:
                equal.add((doc, k))
            seen.add(words)
    found = {(r["doc_id"], r["line_no"]): r["near"] for r in lines.op1_line_dedup(spark, SF_DIR).collect()}
    checked = set(connect(SF_DIR).execute(lines.OP1_SQL).fetchall())
    assert equal <= set(found)
    assert checked == {(*at, near) for at, near in found.items()}


ROWS = [(0, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon\nfirst of one"), (1, "UNIQUE line of the second row one\nsecond of one"),
        (None, "twice twice\ntwice twice"), (None, "kept here too\nand this line stays\nas this one does"), (None, None), (None, ""),
        (2, "second of one\nsomething else"), (2, "other words\nsomething else"), (3, "same\nrow"), (3, "same\nrow"), (4, "unique line of the second row two")]


def naive_lines(rows):
    """Rows (doc_id, text) by comparing every line with all earlier ones; rows in order of id (null first), text hash, place."""
    kept, seen = [], []
    for at in rows:
        out = []
        for line in (at[1] or "").split("\n"):
            words = line.lower().split()
            near = any(words == w or min(len(words), len(w)) >= lines.MIN_WORDS and lines.within_one(words, w) for w in seen)
            if not words or not near:
                out.append(line)
            if words:
                seen.append(words)
        if at[1] is None or not at[1].split() or "\n".join(out).split():
            kept.append((at[0], None if at[1] is None else "\n".join(out)))
    return kept


def test_lines_of_repeated_and_null_ids_are_their_own(spark):
    docs = spark.createDataFrame([(i, t, k, -k, "x", k + 7) for k, (i, t) in enumerate(ROWS)],
                                 "doc_id long, text string, _gone int, _had int, _doc string, row_number int").repartition(3)
    told = lines.dedup(docs, 1)
    assert told.columns == docs.columns
    found = told.collect()
    ordered = docs.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_first(), "h").collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in found) == sorted((str(i), str(t)) for i, t in naive_lines([(r["doc_id"], r["text"]) for r in ordered]))
    by_place = {r["_gone"]: r for r in found}
    assert all(r["_had"] == -k and r["row_number"] == k + 7 and r["doc_id"] == ROWS[k][0] for k, r in by_place.items())
    assert by_place[4]["text"] == ROWS[4][1] and by_place[2]["text"].startswith("UNIQUE")  # lines of other rows stay
    gone = lines.duplicates(docs, 1).collect()
    assert all(r["doc"] is None or 0 <= r["doc"] <= 4 for r in gone)
    stayed = sum(len((r["text"] or "").split("\n")) for r in found)
    assert len(gone) == sum(len((t or "").split("\n")) for _, t in ROWS) - stayed  # nothing but these lines went


def test_pipeline_removes_short_and_unspaced_lines(spark):
    rows = [(1, "All rights reserved.\nfirst", "en", "s", 9), (2, "second\nall  rights reserved.", "en", "s", 9), (3, "今日は良い天気ですね。\nthird", "ja", "s", 9),
            (4, "今日は良い天気ですね。\nfourth\n\n", "ja", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF_DIR).collect()}
    assert kept == {1: rows[0][1], 2: "second", 3: rows[2][1], 4: "fourth\n\n"}


def test_pipeline_near_dedup_goes_by_five_words_and_four_fifths(spark):
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(base), " ".join(base[:330]), " ".join(base[60:360]), " ".join(f"v{k}" for k in range(400)),
             " ".join(f"x{k}" if k % 11 == 5 else f"v{k}" for k in range(400))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    sets = near_duplicates.shingle_sets(pa.array(texts), 5)
    share = {(a, b): len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a in range(5) for b in range(a)}
    assert {pair for pair, s in share.items() if s >= 0.8} == {(1, 0)} and share[1, 0] < 0.85
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect())
    assert kept == [0, 2, 3, 4]
    assert near_duplicates.keep_first(docs).count() == 5  # op5's own figures stay


def test_bands_and_slack_at_four_fifths():
    draw = np.random.default_rng(7)
    lost = low = 0
    for _ in range(400):
        both, one, other = (draw.integers(0, 2 ** 64, n, np.uint64) for n in (1600, 200, 200))
        a, b = (near_duplicates.registers(np.unique(np.concatenate([both, x]))) for x in (one, other))
        same = a.view(np.uint64) == b.view(np.uint64)
        lost += not (same & (a.view(np.uint64) > 0)).any()
        low += near_duplicates.estimates(a, b[None])[0] < 0.8 - near_duplicates.SLACK
    assert (lost, low) == (0, 0)


def test_added_tokens_have_the_ids_of_the_plain_library_call(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    texts = ["see <|endoftext|> here", "x<|endoftext|>y.z <|startoftext|><|endoftext|>", "É.<|ENDOFTEXT|>, <|StartOfText|>it's", "<| endoftext |> <|endoftext|", "<|endoftext|>\u0338 a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    at, expected = 0, []
    for k, text in enumerate(texts):
        ids = [*coder.encode(text, add_special_tokens=False).ids, huffman.END_ID]
        expected.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert coder.encode(texts[0], add_special_tokens=False).ids == [862, 49407, 763]
    assert sorted(map(tuple, huffman.digests(docs, path, scratch_dir(spark, "h")).collect())) == expected


def test_stages_keep_columns_of_any_name(spark):
    """Names that the operators used, or might use, inside belong to the caller."""
    passage = " ".join(f"bench{k}" for k in range(30))
    texts = ["one two three four five six seven"] * 3 + [passage, "nothing of the kind stands here at all", None, ""]
    rows = [(k, t, f"g{k}", k * 2, k * 3, k * 5, f"o{k}") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string, _dirty int, lost int, hit_row int, one_set string")
    kept = near_duplicates.keep_first(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in kept] == [rows[k] for k in (0, 3, 4, 5, 6)]
    clean = contamination.remove_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in clean] == [rows[k] for k in (0, 1, 2, 4, 5, 6)]


def test_many_copies_of_one_text_and_rows_without_words(spark):
    """Copies of one text, and empty texts, are more than half of the rows each; every row comes back once."""
    copies, empty = [(k, "the same short text for everyone") for k in range(0, 6000, 2)], [(k, None if k % 3 else " ") for k in range(1, 6000, 2)]
    docs = spark.createDataFrame([*copies, *empty, (None, "the same short text for everyone"), (None, None)], "doc_id long, text string").repartition(5)
    found = near_duplicates.near_duplicates(docs).collect()
    assert len(found) == 6002
    told = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found if r["doc_id"] is not None}
    assert all(told[k] == (4, 0, k == 0) for k, _ in copies) and all(told[k] == (0, k, True) for k, _ in empty)
    assert sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in found if r["doc_id"] is None) == [(0, None, True), (4, None, True)]


def test_range_of_counts_the_cuts(spark):
    for cuts in ([], [5], list(range(-40, 60, 3)), list(range(0, 9000, 7))):
        values = [-100, -40, -39, 0, 1, 5, 6, 7, 8, 895, 896, 897, 903, 8000, 9000, 1 << 40]
        found = spark.createDataFrame([(v,) for v in values], "v long").select("v", chat._range_of(F.col("v"), cuts).alias("n")).collect()
        assert {r["v"]: r["n"] for r in found} == {v: sum(c <= v for c in cuts) for v in values}


def test_each_distinct_word_is_encoded_once(monkeypatch):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = []
    library = bpe.tiktoken.Encoding

    class Counting:
        def __init__(self, *given, **named):
            self.coder = library(*given, **named)

        def encode_ordinary(self, word):
            encoded.append(word)
            return self.coder.encode_ordinary(word)

    monkeypatch.setattr(bpe.tiktoken, "Encoding", Counting)
    texts = [f"zqx{'abcdefghi'[k % 9]} wvut{'qrst'[k % 4]}q the" for k in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(bpe, "TaskContext", Task)
    blocks = pa.Table.from_batches(list(bpe._cut(pattern, 5, 30)(iter([batch]))))
    assert len(set(blocks["block"].to_pylist())) > 3
    ordered = blocks.filter(pa.compute.is_valid(blocks["bucket"])).sort_by("bucket").select(["block", "bucket", "data"])
    rows = pa.Table.from_batches(list(bpe._encode_words(path, pattern)(iter(ordered.to_batches(max_chunksize=2)))))
    assert rows.num_rows == ordered.num_rows
    assert len(encoded) == len(set(encoded)) >= 13


def test_encode_sorts_by_bucket(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "two one three")], "doc_id long, text string")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "Sort [bucket" in plan


def python_steps(frame) -> list[str]:
    """Python steps of the plan that is yet to run, but for those behind a shuffle."""
    above, found = [], []
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, name) for d, name in above if d < depth]
        above.append((depth, line))
        if "InArrow" in line and not any("Exchange" in name for _, name in above):
            found.append(line)
    return found


def test_digests_run_one_python_step_after_a_shuffle(spark):
    docs = spark.createDataFrame([(2, "a b a"), (1, None), (None, ""), (2, "é  b.c")], "doc_id long, text string")
    ids = huffman.digests(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "h"))
    assert len(python_steps(ids)) == 1 and ids.count() == 4
    path, pattern = bpe._public()
    both = bpe.encode_and_decode(docs, path, pattern)
    assert len(python_steps(both)) == 1
    expected = bpe.decode(bpe.encode(docs, path, pattern), path)
    assert len(python_steps(expected)) == 2
    assert sorted(map(str, both.collect())) == sorted(map(str, expected.collect()))
    assert bpe.digests(docs.limit(0)).count() == 0


def texts_given(monkeypatch, batch: pa.RecordBatch) -> tuple[list[str], list[list[int]]]:
    """What the tokenizer library was given for a batch of texts, and the ids of each text."""
    given = []

    class Counted:
        def __init__(self, coder):
            self.coder = coder

        def __getattr__(self, name):
            return getattr(self.coder, name)

        def encode_batch_fast(self, texts, **settings):
            given.extend(texts)
            return self.coder.encode_batch_fast(texts, **settings)

    class Library:
        @staticmethod
        def from_file(path):
            return Counted(Tokenizer.from_file(path))

    monkeypatch.setattr("tokenizers.Tokenizer", Library)
    monkeypatch.setattr(huffman.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": staticmethod(lambda: 0)})))
    ids = []
    for part in huffman._tokenize(public_tokenizers.path("word_bpe_49k.json"), huffman.END_ID)(iter([batch])):
        ids += [np.frombuffer(x, "<u4").tolist() if isinstance(x, bytes) else x for x in part.column("ids").to_pylist() if x is not None]
    return given, ids


def test_new_words_of_letters_go_to_the_tokenizer_together(monkeypatch):
    if hasattr(huffman, "_parts"):
        huffman._parts.cache_clear()
    draw = random.Random(11)
    odd = ["İx", "क़क़", "יִ", "한", "ŉa", "ΑΣ", "straße", "ﬁne", "中文字", "ไทย", "ͅx", "ǅ", "x²", "Ωhm"]
    words = [*("".join(draw.choices("abcdeéß", k=draw.randint(1, 12))) for _ in range(6000)), *odd * 2]
    draw.shuffle(words)
    texts = [*(" ".join(words[k:k + 40]) for k in range(0, len(words), 40)), None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [[*coder.encode(t or "", add_special_tokens=False).ids, huffman.END_ID] for t in texts]
    given, ids = texts_given(monkeypatch, batch)
    assert ids == expected
    assert len(given) < 6000 / 4  # each was one text
    given, ids = texts_given(monkeypatch, batch)  # the next task of the worker
    assert ids == expected and given == []
    huffman._parts.cache_clear()


def test_parts_beyond_the_memo_are_encoded_again(monkeypatch):
    monkeypatch.setattr(huffman, "MEMO_PARTS", 50)
    known = huffman._Parts(public_tokenizers.path("word_bpe_49k.json"))
    draw = random.Random(5)
    words = ["".join(draw.choices("abcxyzé", k=4)) for _ in range(300)]
    for start in range(0, 600, 60):
        some = [words[(start + k) % 300] for k in range(90)] + words[:3] * 2
        found = known.ids(pa.array(some).dictionary_encode()).to_pylist()
        assert found == [known.coder.encode(w, add_special_tokens=False).ids for w in some]
        assert len(known.names) == len(known.table)
    assert len(known.names) < 150


def test_ids_do_not_tell_ends_where_a_byte_or_an_added_token_hides_them():
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    vocabulary = coder.get_vocab()
    ends = huffman.ends_of_words(coder, ["<|endoftext|>"])
    assert ends[vocabulary["the</w>"]] and ends[vocabulary["!</w>"]] and not ends[vocabulary["the"]]
    assert huffman.ends_of_words(coder, ["<|endoftext|>", "mask"]) is None
    parts = pa.array(["one", "it's", "two"])
    assert huffman.encode_parts(coder, None, parts).to_pylist() == huffman.encode_parts(coder, ends, parts).to_pylist()
    assert huffman.encode_parts(coder, ends, parts[:0]).to_pylist() == []


def test_blocks_hold_every_code_bit_by_bit():
    draw = np.random.default_rng(2)
    for n in (1, 2, 3, 4, 5, 257, 1000):
        for low, high in ((1, 2), (16, 17), (1, 17), (15, 17)):
            length = draw.integers(low, high, 40)
            code = draw.integers(0, 1 << 16, 40) & ((1 << length) - 1)
            values = draw.integers(0, 40, n).astype(np.uint32)
            bits = "".join(format(code[v], f"0{length[v]}b") for v in values)
            found, checkpoints = huffman.encode_block(values, code, length, stride=4)
            assert "".join(format(x, "08b") for x in found) == bits + "0" * (-len(bits) % 8)
            assert checkpoints.tolist() == np.append(0, np.cumsum(length[values]))[:n:4].tolist()


def test_counts_beside_the_ids_are_those_of_the_ids(spark):
    rows = [(k % 7, f"a b{k} <|endoftext|> é.{k % 3}" if k % 5 else None) for k in range(60)]
    ids = huffman.tokenized(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
    found, counted = ids.collect(), {}
    for r in found:
        if r["ids"] is not None:
            for i in np.frombuffer(r["ids"], "<u4").tolist():
                counted[r["part"], i] = counted.get((r["part"], i), 0) + 1
    assert sum(r["ids"] is not None for r in found) == 60
    assert {(r["part"], r["id"]): r["n"] for r in found if r["ids"] is None} == counted
