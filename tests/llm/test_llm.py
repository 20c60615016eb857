"""The dealt operators against brute force on small tables, with nulls, empty texts, ties, repeats and clashing names."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from checking import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from commonspulse.llm import (
    bpe,
    chat,
    contamination,
    huffman,
    language,
    lines,
    main_text,
    near_duplicates,
    queries,
    search,
    substrings,
)
from commonspulse.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, node long, hash long, own int"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.fixture
def docs(spark):
    def make(*texts, ids=None):
        rows = [(i, t, "en", "s", len(t or ""), 1, 2, 3) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
        return spark.createDataFrame(rows, DOC)
    return make


def vocabulary_text(seed, count, words=300):
    rng = random.Random(seed)
    names = ["w" + "".join(rng.choices("abcdefgh", k=4)) for _ in range(words)]
    return " ".join(rng.choices(names, k=count))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_check(spark, connection, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), queries.ORACLES[name], connection) == []


def test_all_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_native_plans_have_no_python(spark):
    for frame in (chat.op6_preferences(spark, SF_DIR), contamination.op9_contamination(spark, SF_DIR)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


HARD = ["", None, "   ", "a", "it's 'S ''s  x​ \r\n\r\n  y", "한국 12² กำ", "\x1c b", "word " * 3000, "same same", "same same", "é" * 5000]


def test_bpe_equals_library(docs):
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(VOCABULARY), special_tokens={})
    found = {r["doc_id"]: r for r in bpe.encode(docs(*HARD), VOCABULARY, public_tokenizers.PATTERN, block_words=7).collect()}
    assert {i: r["ids"] for i, r in found.items()} == {i: coder.encode_ordinary(t or "") for i, t in enumerate(HARD)}
    told = {r["doc_id"]: r["decoded_sha256"] for r in bpe.digests(docs(*HARD)).collect()}
    assert told == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(HARD)}


def test_bpe_with_repeated_and_null_ids_and_no_rows(docs):
    found = bpe.digests(docs("a b", "c", None, ids=[None, None, 4])).collect()
    assert sorted(r["n_tokens"] for r in found) == [0, 1, 2]
    assert bpe.digests(docs()).count() == 0


def test_huffman_lengths_are_optimal():
    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 60):
        counts = rng.integers(1, 500, n)
        book = huffman.code_book(np.arange(n), counts)
        sums, left = 0, sorted(counts.tolist())
        while len(left) > 1:
            sums += left[0] + left[1]
            left = sorted([left[0] + left[1], *left[2:]])
        assert (counts[book.ids] * book.lengths).sum() == (sums if n > 1 else counts[0])
    skewed = huffman.code_book(np.arange(40), np.array([2 ** k for k in range(40)]))
    assert skewed.lengths.max() <= huffman.LIMIT and sum(2.0 ** -skewed.lengths) <= 1


def test_huffman_blocks_round_trip():
    values = np.random.default_rng(5).zipf(1.3, 5000) % 900
    ids, counts = np.unique(values, return_counts=True)
    book = huffman.code_book(ids, counts)
    code, length = np.zeros(900, np.int64), np.zeros(900, np.int64)
    code[book.ids], length[book.ids] = huffman.codes(book), book.lengths
    bits, checkpoints = huffman.encode_block(values, code, length)
    assert len(checkpoints) == math.ceil(len(values) / huffman.STRIDE)
    assert (huffman.decode_block(bits, checkpoints, len(values), huffman.decode_table(book)) == values).all()


@pytest.mark.parametrize("ids", [None, [5, 3, None, 3, 9, 1, 2, 40, 41, 42, 43]])
def test_huffman_file_holds_the_library_ids(spark, docs, ids):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    coder = Tokenizer.from_file(tokenizer)
    coder.encode_special_tokens = True
    rows = [(i, t) for i, t in zip(ids or range(len(HARD)), HARD, strict=True)]
    found = huffman.digests(docs(*HARD, ids=ids), tokenizer, scratch_dir(spark, "h")).collect()
    at, expected = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        own = coder.encode(t or "", add_special_tokens=False).ids + [huffman.END_ID]
        expected.append((i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_huffman_of_no_documents(spark, docs):
    assert huffman.digests(docs(), public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "h")).count() == 0


def test_language_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    layer = {"byte": rng.normal(0, 0.3, (256, 9)), "state": rng.normal(0, 0.3, (3, 9))}
    x, weight = rng.integers(97, 100, (4, 5)), rng.normal(0, 1, (4, 5, 3))
    trace = []
    language._forward(layer, x, trace)
    grads = language._backward(layer, x, trace, weight)
    for key, place in (("byte", (97, 4)), ("byte", (98, 7)), ("state", (1, 2)), ("state", (2, 8))):
        sides = []
        for step in (1e-3, -1e-3):
            moved = {k: v.copy() for k, v in layer.items()}
            moved[key][place] += step
            sides.append((language._forward(moved, x) * weight).sum())
        assert grads[key][place] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=0.02, abs=1e-3)


def test_language_on_held_out_documents_and_odd_texts(spark, docs):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(given)
    told = language.predict(given, model).join(given.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in told) >= 0.95 * len(told) > 0
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in told)
    odd = {r["doc_id"]: r for r in language.predict(docs(None, "", "12 !?", "ä" * 900, ids=[1, 2, 3, None]), model).collect()}
    assert [odd[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and odd[1]["score"] == 0
    assert odd[None]["lang_pred"] in model.languages and odd[None]["held_out"] is False
    assert language.predict(docs("a b"), None).first()["lang_pred"] == "und"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_lines_equal_brute_force(docs):
    rng = random.Random(8)
    base = [rng.choices("abcdefg", k=rng.randint(3, 9)) for _ in range(25)]
    texts = []
    for _ in range(60):
        chosen = []
        for line in rng.choices(base, k=rng.randint(0, 4)):
            line = list(line)
            if rng.random() < 0.6:
                at = rng.randrange(len(line))
                line[at:at + rng.randint(0, 1)] = rng.choices("abcdefg", k=rng.randint(0, 1))
            chosen.append(" ".join(line))
        texts.append("\n".join(chosen))
    texts += [None, "", "\n\n"]
    seen, expected = [], set()
    for doc, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            words = line.lower().split()
            if len(words) >= lines.MIN_WORDS:
                if any(one_edit(words, other) for other in seen):
                    expected.add((doc, k))
                seen.append(words)
    found = [(r["doc"], r["line"]) for r in lines.duplicates(docs(*texts)).collect()]
    assert sorted(found) == sorted(expected) and expected


def test_line_dedup_keeps_columns_and_short_lines(docs):
    kept = lines.dedup(docs("x y\none two three four five", "x y\none two three four six", "One two  three four five", None, "", ids=[1, 2, 3, 4, 5]))
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {1: "x y\none two three four five", 2: "x y", 4: None, 5: ""}
    assert kept.columns == [c.split()[0] for c in DOC.split(", ")]
    assert lines.dedup(docs()).count() == 0


def shingles(text):
    table = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = (text or "").translate(table).split()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set()


def brute_components(texts):
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            old, new = max(up[a], up[b]), min(up[a], up[b])
            up = [new if u == old else u for u in up]
    return up, sets


def test_near_duplicates_equal_brute_force(docs):
    rng, texts = random.Random(4), []
    for family in range(6):
        base = vocabulary_text(family, rng.choice([8, 40, 150, 400])).split()
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = "new" + str(rng.random())
            texts.append(" ".join(copy))
    texts += ["a b", "A  b", "a c", "", None, "   ", texts[0], texts[0]]
    rng.shuffle(texts)
    up, sets = brute_components(texts)
    for block in (512, 8):  # one task a group, and many
        found = {r["doc_id"]: r for r in near_duplicates.near_duplicates(docs(*texts), block=block).collect()}
        assert [found[i]["component_id"] for i in range(len(texts))] == up
        assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert near_duplicates.keep_first(docs(*texts)).count() == len(set(up))


def test_near_duplicates_with_null_and_repeated_ids(docs):
    found = near_duplicates.near_duplicates(docs("a b c d", "a b c d", "a b c d", "x", ids=[None, 7, 7, 3])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in found if r["doc_id"]) == [(3, 3, True), (7, 7, True), (7, 7, True)]
    assert [r["kept"] for r in found if r["doc_id"] is None] == [True]
    assert near_duplicates.near_duplicates(docs()).count() == 0


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, chosen string"
    a = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "yes", ""), (2, 0, None, None, ""), (None, 0, "user", "x", ""), (3, 0, "user", "q", "")], schema)
    b = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "nö", ""), (2, 0, None, None, "")], schema)
    rows = {r["pair_id"]: r for r in chat.preferences(a, b).collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert one["n_shared"] == 1 and one["prompt"] == "<|user|>\nhi<|end|>\n" and one["rejected"] == "<|assistant|>\nnö<|end|>\n"
    start, end = one["chosen_mask"][0]
    assert one["chosen"][start:end] == "yes<|end|>\n" and len(one["rejected_mask"]) == 1
    assert rows[2]["chosen"] == "" and rows[2]["chosen_mask"] == []
    assert chat.preferences(a.limit(0), b).count() == 0


def test_search_equals_brute_force_and_leaves_odd_vectors_out(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 8).tolist(), 1) for i in range(300)] + [(i, rows, 1) for i, rows in (
        (300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (None, [9.0] * 8), (305, [3.0]), (306, [3.0]))]
    rows += rows[:5]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    found = sorted(map(tuple, search.top_k(frame, F.col("vec_id") % 50 == 0, 5).collect()))
    vectors = {i: np.array([math.floor(256 * x) for x in v] + [0] * (8 - len(v))) for i, v, _ in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in vectors if i % 50 == 0):
        best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert found == sorted(expected)
    assert search.top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_substrings_equal_brute_force(docs):
    rng, passage = random.Random(6), vocabulary_text(99, 40).split()
    texts = []
    for k in range(40):
        words = vocabulary_text(k, rng.randint(0, 60)).split()
        if k % 3 == 0:
            a = rng.randint(0, 20)
            words[5:5] = passage[a:a + rng.randint(8, 20)]
        texts.append("  ".join(words))
    texts += [texts[3], texts[3], None, "", " ".join(["z"] * 50)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    windows = collections.defaultdict(set)
    split = {i: (texts[k] or "").split() for i, k in enumerate(order)}
    for i, w in split.items():
        for p in range(len(w) - 12):
            windows[tuple(w[p:p + 13])].add(i)
    expected = {}
    for i, w in split.items():
        gone = {q for p in range(len(w) - 12) if min(windows[tuple(w[p:p + 13])]) < i for q in range(p, p + 13)}
        expected[i] = (len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    found = substrings.remove_repeats(docs(*(texts[k] for k in order)), block_chars=700).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found} == expected
    assert all(f["length"] >= 13 and f["reference"] < r["doc_id"] for r in found for f in r["factors"])
    assert substrings.remove_repeats(docs()).count() == 0


def test_contamination_of_short_repeated_and_odd_items(spark, docs):
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "alpha BETA"), (3, None), (4, "!!"), (None, "gamma"), (5, vocabulary_text(1, 20))], "item_id long, text string")
    long = vocabulary_text(1, 20)
    texts = ["x alpha, beta y", long + " " + vocabulary_text(2, 500), None, "", "gamma É é", "alpha beta " * 400]
    found = {r["doc_id"]: r for r in contamination.report(docs(*texts), items).collect()}
    assert (found[0]["n_hit"], found[0]["n_items"], found[0]["contaminated"]) == (2, 2, True)
    assert found[0]["items_sha256"] == hashlib.sha256(b"1,2").hexdigest()
    assert (found[1]["n_hit"], found[1]["n_items"], found[1]["contaminated"]) == (20, 1, False)
    assert [found[k]["n_hit"] for k in (2, 3, 4)] == [0, 0, 0] and found[4]["n_words"] == 3
    assert (found[5]["n_hit"], found[5]["n_words"]) == (800, 800)
    assert contamination.report(docs(*texts), items.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination.report(docs(), items).count() == 0


def test_proximity_matches(spark, docs):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    found, _ = contamination.matches(docs("red green blue", "red x green blue", "red green x y z w blue", "blue green red"), items, slop=2)
    told = {r["doc_id"]: (len(r["exact"]) > 0, len(r["near"]) > 0) for r in found.collect()}
    assert told[0][0] and told[1] == (False, True) and told[2] == (False, False) and not told[3][0]


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav><div class="ad">Buy now this thing</div>
{open}<h1>Head &amp; line</h1><p>First <b>bold</b> para&shy;graph with several words, and more of them.<p>Second&nbsp;one<br>goes on, with a
line break and enough words to count.<form>Name <input></form><section class="comments"><p>I disagree.</p></section>{close}
<aside>Side</aside><footer>&copy; 2024</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "div"])
def test_main_text(tag):
    text = main_text.main_text(PAGE.format(open=f"<{tag}>", close=f"</{tag}>"))
    assert text == ("Head & line First bold para­graph with several words, and more of them. Second one goes on, with a line break and "
                    "enough words to count.")


STORY = "".join(f"<p>Sentence {i} of the story goes on for a while, as stories in newspapers do, and ends here.</p>" for i in range(12))
TOLD = " ".join(f"Sentence {i} of the story goes on for a while, as stories in newspapers do, and ends here." for i in range(12))
MENU = "<nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>"
TALK = "".join(f"<article class='comment-body'><p>Reader {i} holds another view and says so in a rather long reply to all.</p></article>" for i in range(30))


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm>{MENU}<div><h1>Big news</h1>{STORY}</div><div class=footer>End</div></form></body>",
    f"<body><form id=f><div class=page>{MENU}<div class=sidebar-page><article><h1>Big news</h1>{STORY}</article></div></div></form></body>",
    f"<body>{MENU}<div class='content has-sidebar'><h1>Big news</h1>{STORY}</div><div class=sidebar>Side</div></body>",
    f"<body>{MENU}<article class='post with-comments'><h1>Big news</h1>{STORY}</article><div id=comments>{TALK}</div></body>",
    f"<body>{MENU}<article><h1>Big news</h1>{STORY[:STORY.index("<p>Sentence 6")]}</article><article>{STORY[STORY.index("<p>Sentence 6"):]}</article></body>",
    f"<body>{MENU}<article><h1>Big news</h1>{STORY}<ul>{'<li><a href=x>One more link</a>' * 20}</ul></article></body>",
    f"<body>{MENU}<div class=alert-story><p>Big news</p>{STORY}</div><div class=comments>{TALK}</div><p>x</p></body>",
    f"<body>{MENU}<main><div><h1>Big news</h1>{STORY}</div></main><section class=comment-list>{TALK}</section></body>",
])
def test_names_and_tags_alone_do_not_lose_the_article(page):
    text = main_text.main_text(page)
    if "alert-story" in page:  # nothing but names tells the story from its comments
        assert TOLD in text
    else:
        assert text == "Big news " + TOLD


def test_densities_equal_a_naive_count():
    def naive(node, what):
        found = [what(node)]
        for part in node.parts:
            if not isinstance(part, str) and not part.empty:
                found += naive(part, what)
        return found

    page = PAGE.format(open="<div class=story>", close="</div>" + "<ul>" + "<li><a href=q>more</a> now" * 4 + "</ul>")
    nodes = main_text.measure(main_text.parse(page))

    def numbers(node):
        texts = lambda n: sum(len("".join(p.split())) for p in n.parts if isinstance(p, str))
        links = [n for n in nodes_below(node) if n.tag == "a"]
        return (sum(naive(node, texts)), len(naive(node, lambda n: 1)) - 1, sum(sum(naive(a, texts)) for a in links), len(links))

    def nodes_below(node):
        return naive(node, lambda n: n)[1:]

    body = next(n for n in nodes if n.tag == "body")
    share = numbers(body)[2] / numbers(body)[0]
    for node in nodes:
        chars, tags, link_chars, link_tags = numbers(node)
        assert (chars, tags, link_chars, link_tags) == (node.chars, node.tags, node.link_chars, node.link_tags)
        if chars:
            under = np.log(np.log(chars * link_chars / max(chars - link_chars, 1) + share * chars + np.e))
            over = np.log(max(chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1), 1))
            assert node.density == pytest.approx(chars / max(tags, 1) * over / under, rel=1e-6) or under < 1e-6
        assert node.total == pytest.approx(sum(p.density for p in node.parts if not isinstance(p, str) and not p.empty))


def test_main_text_of_odd_pages(spark):
    odd = [None, "", "<p>", "no tags & <3", "<div>" * 2000 + "deep", "<p>x" * 3, "<script>1<"]
    frame = spark.createDataFrame([(k, None, h, "x") for k, h in enumerate(odd)], "page_id long, url string, html string, text string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text.extract(frame).collect()}
    assert found == {0: ("", 0), 1: ("", 0), 2: ("", 0), 3: ("no tags & <3", 12), 4: ("deep", 4), 5: ("x x x", 5), 6: ("", 0)}


def test_pipeline_stages_chain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "encode"]
    kept = corpus_pipeline.language_id(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and kept.count() == docs.filter("text rlike '\\\\p{L}'").count()
    cleaned = corpus_pipeline.decontaminate(spark, docs, SF_DIR)
    dirty = {r["doc_id"] for r in contamination.report(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).filter("contaminated").collect()}
    assert {r["doc_id"] for r in cleaned.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()} - dirty
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_parts_of_words_encode_like_whole_words():
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.encode_special_tokens = True
    draw = random.Random(3)
    signs = ["a", "B", "É", "é", "̸", "=", "'", "'S", "'ll", ".", "##", "1", "İ", "ŉ", "H̱", "Σ", "한", "<|endoftext|>"]
    words = ["".join(draw.choices(signs, k=draw.randint(1, 9))) for _ in range(5000)]
    found = huffman.parts_of(pa.array(words)).to_pylist()
    assert sum(len(parts) > 1 for parts in found) > 1000
    for word, parts in zip(words, found, strict=True):
        ids = [i for part in parts for i in coder.encode(part, add_special_tokens=False).ids]
        assert ids == coder.encode(word, add_special_tokens=False).ids, word
