"""Benchmark items found in documents through a positional inverted index, in DataFrame functions only.

An item's windows are its runs of ``WIDTH`` words (a shorter item is one window).  Words are lower-cased in A-Z.
1. Count the documents' words and find, for each window, its two rarest terms; a window with a term that no document
   has cannot occur.
2. Store the postings (term, document, position) of those terms.
3. Shift each list by the term's place in the window and intersect the lists of the rarest and the second rarest term:
   what both name is a candidate start.  With ``slop``, starts that differ by up to so many words meet as well.
4. Compare the candidates with the documents' own words: exact phrases, or all terms within the window and its slop.

Lists meet by grouping on (window, document, start), so neither a frequent term nor a document with many copies of a
passage makes pairs.  The probed terms are broadcast only below a measured size; beyond it the same join shuffles.

Defined cases: a null text has no words; an item that is null, has no words or no ``item_id`` takes no part; equal
items all count; repeated rows are judged each; rows with null ``doc_id`` too; further columns are left out; with an
empty benchmark nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse.llm.common import fresh, read, saved

WIDTH = 13
BROADCAST_BYTES = 8 << 20  # of probed terms, measured before each use
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(word: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(word, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Words of a text, case as it is."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN), "")


def row_key() -> Column:
    """Tells documents apart, also where ``doc_id`` is null or repeated."""
    return F.xxhash64("doc_id", "text")


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, words) of every window of every item."""
    parts = items.select(F.col("item_id").cast("string"), words(lower(F.col("text"))).alias("all")).filter(
        F.col("item_id").isNotNull() & (F.size("all") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (width - 1), F.lit(1)))
    return parts.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, width))).alias("words")).distinct()


def word_forms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(form, term, n): how often each spelling of the given terms stands in the documents."""
    return (docs.select(F.explode(words(F.col("text"))).alias("form")).groupBy("form").agg(F.count("*").alias("n"))
            .withColumn("term", lower(F.col("form"))).join(terms, "term", "left_semi"))


def rarest(wins: DataFrame, forms: DataFrame, lists: int = 2) -> DataFrame:
    """(wid, size, anchors): the ``lists`` rarest terms of each window that can occur, with their places in it."""
    counts = forms.groupBy("term").agg(F.sum("n").alias("n"))
    placed = wins.select("wid", F.size("words").alias("size"), F.posexplode("words").alias("place", "term"))
    return (placed.join(counts, "term").groupBy("wid", "size")
            .agg(F.sort_array(F.collect_list(F.struct("n", "place", "term"))).alias("anchors"))
            .filter(F.size("anchors") == F.col("size")).withColumn("anchors", F.slice("anchors", 1, lists)))


def postings(docs: DataFrame, forms: DataFrame) -> DataFrame:
    """(term, doc, position, n_words) of every occurrence of the given spellings."""
    size = forms.agg(F.sum(F.length("form") + F.length("term") + 32).alias("b")).first()["b"] or 0
    probes = forms.select("form", "term")
    return (docs.select(row_key().alias("doc"), words(F.col("text")).alias("all"))
            .select("doc", F.size("all").alias("n_words"), F.posexplode("all").alias("position", "form"))
            .join(F.broadcast(probes) if size <= BROADCAST_BYTES else probes, "form")
            .select("term", "doc", "position", "n_words"))


def candidates(index: DataFrame, anchors: DataFrame, slop: int = 0) -> DataFrame:
    """(wid, doc, start): where the shifted lists of a window's anchors agree, up to ``slop`` words."""
    lists = anchors.select("wid", "size", F.posexplode("anchors").alias("list", "anchor")).select(
        "wid", "size", F.expr("shiftleft(1, list)").alias("bit"),
        F.col("anchor.place").alias("place"), F.col("anchor.term").alias("term"))
    need = anchors.select("wid", F.expr("shiftleft(1, size(anchors)) - 1").alias("need"))
    starts = (lists.join(index, "term").withColumn("start", F.col("position") - F.col("place"))
              .filter((F.col("start") >= -slop) & (F.col("start") + F.col("size") <= F.col("n_words") + slop)))
    if slop:
        near = F.when(F.col("bit") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(-slop), F.lit(slop)))
        starts = starts.withColumn("by", F.explode(near)).withColumn("start", F.col("start") + F.col("by"))
    return (starts.groupBy("wid", "doc", "start").agg(F.bit_or("bit").alias("bits"))
            .join(need, "wid").filter(F.col("bits") == F.col("need")).select("wid", "doc", "start"))


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """Documents with their matches, and the items of each window.

    The first holds one row per document: key ``doc``, ``doc_id``, ``n_words``, ``exact`` and ``near``, lists of
    (start, size, wid); ``near`` has the proximity matches that are not exact.  The second is (wid, item_id).
    """
    found = saved(windows(items, width), "item-windows")
    wins = saved(found.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    owners = found.join(wins, "words").select("wid", "item_id")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    forms = saved(word_forms(docs, wins.select(F.explode("words").alias("term")).distinct()), "word-forms")
    anchors = saved(rarest(wins, forms), "anchors")
    probed = anchors.select(F.explode("anchors.term").alias("term")).distinct()
    index = saved(postings(docs, forms.join(probed, "term", "left_semi")), "postings")
    placed = candidates(index, anchors, slop).join(wins, "wid").groupBy("doc").agg(
        F.collect_list(F.struct("start", "wid", "words")).alias("places"))
    joined = (docs.select(row_key().alias("doc"), "doc_id", "text").join(placed, "doc", "left")
              .withColumn("all", words(F.col("text"))).withColumn("places", F.coalesce("places", F.array())))

    def same(c: Column) -> Column:
        return (c["start"] >= 0) & (F.transform(F.slice("all", c["start"] + 1, F.size(c["words"])), lower) == c["words"])

    def close(c: Column) -> Column:
        first = F.greatest(c["start"] - slop, F.lit(0))
        span = F.slice("all", first + 1, c["start"] + F.size(c["words"]) + slop - first)
        return ~same(c) & (F.size(F.array_except(c["words"], F.transform(span, lower))) == 0)

    def brief(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), F.size(c["words"]).alias("size"), c["wid"].alias("wid"))

    exact = F.transform(F.filter("places", same), brief)
    near = F.transform(F.filter("places", close), brief) if slop else F.slice(exact, 1, 0)
    return joined.select("doc", "doc_id", F.size("all").cast("long").alias("n_words"), exact.alias("exact"), near.alias("near")), owners


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: hit words, items with occurring windows, and whether it counts as contaminated.

    Contaminated: a word is hit, and at least one word in twenty.
    """
    found, owners = matches(docs, items, width)
    covered = F.flatten(F.transform("exact", lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1)))
    told = saved(found.select("doc", "doc_id", "n_words", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                              F.array_distinct("exact.wid").alias("wids")), "hits")
    named = (told.select("doc", F.explode("wids").alias("wid")).distinct().join(owners, "wid").groupBy("doc")
             .agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return told.join(named, "doc", "left").select(
        "doc", "doc_id", "n_words", "n_hit", F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_of), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    (hit,) = fresh(docs, "hit_row")
    dirty = report(docs, items).filter("contaminated").select(F.col("doc").alias(hit)).distinct()
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return docs.join(dirty.hint("merge"), key == dirty[hit], "left_anti")


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("doc")


_WORDS_SQL = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
OP9_SQL = f"""
with d as (select doc_id, {_WORDS_SQL} as w from documents),
b as (select cast(item_id as varchar) as item_id, {_WORDS_SQL} as w from benchmark where item_id is not null),
windows as (select distinct item_id, array_to_string(w[i:i + 12], ' ') as k, least(len(w), 13) as size
            from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct size from windows),
places as (select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as k
           from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes)),
found as (select doc_id, i, size, item_id from places join windows using (k, size)),
hit as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from found) group by 1),
named as (select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as ids
          from (select distinct doc_id, item_id from found) group by 1)
select d.doc_id, len(d.w) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(named.n, 0) as n_items,
       sha256(coalesce(named.ids, '')) as items_sha256,
       coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(d.w) as contaminated
from d left join hit using (doc_id) left join named using (doc_id)
"""

QUERIES = {"op9_contamination": op9_contamination}
ORACLES = {"op9_contamination": OP9_SQL}
