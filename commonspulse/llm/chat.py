"""Preference formatting in DataFrame functions: one prompt and two masked completions for each pair of conversations.

The prompt is the longest run of turns that chosen and rejected begin with alike, rendered once; what follows in each is
its completion.  A completion's mask lists the spans (start, end, in characters) of the assistant's own words, end mark
included: only there a loss counts.

Defined cases: turns are in order of ``turn``, then role and text (nulls first, repeated rows stay); a null text is empty,
a null role an empty name; rows without pair id are left out, and so is a pair that has one side only; equal sides give
empty completions; further columns are left out; empty tables give an empty table.  A conversation is one row of the
result, so its turns meet in one task; pairs are spread by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commonspulse.llm.common import read

OPEN, AFTER, CLOSE = "<|", "|>\n", "<|end|>\n"  # around role and text of a turn
TRAINED = "assistant"
RANGE_IDS = 1 << 20  # ids of a range, about; each range is put in order by itself
LEAST_RANGES, STEP = 64, 128  # ranges of a small table; cuts looked at before the finer ones
_SPANS = "array<struct<start:int,end:int>>"


def conversations(turns: DataFrame, name: str) -> DataFrame:
    """One row a pair: its turns in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.filter(F.col("pair_id").isNotNull()).groupBy("pair_id")
            .agg(F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias(name)))


def shared_turns(a: Column, b: Column) -> Column:
    """How many turns both begin with."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(AFTER), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """Spans of the assistant's words in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(seen: Column, turn: Column) -> Column:
        first = seen["at"] + len(OPEN) + F.length(turn["role"]) + len(AFTER)
        end = seen["at"] + F.length(rendered(turn))
        span = F.array(F.struct(first.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(turn["role"] == TRAINED, F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda seen: seen["spans"])


def preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Pairs of conversations, given as rows (pair_id, turn, role, text), as prompt and two masked completions."""
    both = conversations(chosen, "chosen").join(conversations(rejected, "rejected"), "pair_id").withColumn(
        "n_shared", shared_turns(F.col("chosen"), F.col("rejected")))

    def rest(side: str) -> Column:
        return F.slice(F.col(side), F.col("n_shared") + 1, F.size(side))

    return both.select(
        "pair_id", "n_shared", render(F.slice("chosen", 1, F.col("n_shared"))).alias("prompt"),
        render(rest("chosen")).alias("chosen"), render(rest("rejected")).alias("rejected"),
        mask(rest("chosen")).alias("chosen_mask"), mask(rest("rejected")).alias("rejected_mask"))


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the ordered cuts are at most ``value``: every ``STEP``-th is looked at, then those up to the next."""
    if not cuts:
        return F.lit(0)

    def passed(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda c: c <= value))

    def numbers(values: list[int]) -> Column:
        return F.array(*(F.lit(c).cast("long") for c in values))

    if len(cuts) <= STEP:
        return passed(numbers(cuts))
    coarse = passed(numbers(cuts[::STEP]))
    finer = F.array(*(numbers(cuts[k:k + STEP]) for k in range(0, len(cuts), STEP)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * STEP + passed(F.get(finer, coarse - 1)))


def followers(ids: DataFrame) -> DataFrame:
    """(pair_id, next): each of the distinct ids with the one after it in order; the last has none.

    Ids are dealt into ranges of about ``RANGE_IDS`` at percentiles, so no task holds them all; the last of a range takes
    the least id of the next range that has any, found in one row a range.
    """
    ranges = max(LEAST_RANGES, -(-ids.count() // RANGE_IDS))
    cuts = ids.agg(F.percentile_approx("pair_id", F.array(*(F.lit(k / ranges) for k in range(1, ranges))), F.lit(10 * ranges))).first()[0]
    placed = ids.withColumn("range", _range_of(F.col("pair_id"), sorted(set(cuts or []))))
    least = placed.groupBy("range").agg(F.min("pair_id").alias("least"))
    after = least.select("range", F.lead("least").over(Window.partitionBy(F.lit(0)).orderBy("range")).alias("after"))
    inner = placed.withColumn("inner", F.lead("pair_id").over(Window.partitionBy("range").orderBy("pair_id")))
    return inner.join(after, "range", "left").select("pair_id", F.coalesce("inner", "after").alias("next")).filter("next is not null")


def swapped_replies(turns: DataFrame) -> DataFrame:
    """The same conversations with their last reply replaced by the last reply of the neighbour (ids 2k and 2k + 1).

    Where the neighbour has none, the next conversation in order of ids that has a reply gives it.  A conversation stays
    as it is if there is none after it either, or if it has no reply itself.
    """
    turns = turns.filter(F.col("pair_id").isNotNull())
    replies = turns.filter(F.col("role") == TRAINED).groupBy("pair_id").agg(
        F.max("turn").alias("last"), F.max_by(F.coalesce("text", F.lit("")), F.struct("turn", "text")).alias("reply"))
    others = replies.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("reply").alias("other"))
    alone = replies.join(others, "pair_id", "left_anti").select("pair_id")
    later = followers(replies.select("pair_id")).join(alone, "pair_id", "left_semi").select(F.col("next").alias("pair_id"), F.col("pair_id").alias("to"))
    others = others.unionByName(later.join(replies, "pair_id").select(F.col("to").alias("pair_id"), F.col("reply").alias("other")))
    given = turns.join(replies.drop("reply").join(others, "pair_id"), "pair_id", "left")
    here = (F.col("role") == TRAINED) & (F.col("turn") == F.col("last"))
    return given.select("pair_id", "turn", "role", F.when(here, F.col("other")).otherwise(F.col("text")).alias("text"))


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last reply, or the next one's; equal sides where there is none."""
    turns = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    told = preferences(turns, swapped_replies(turns))

    def spans(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(name)

    return told.select("pair_id", "n_shared", "prompt", "chosen", "rejected", spans("chosen_mask"), spans("rejected_mask"))


OP6_SQL = """
with t as (select conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
replies as (select pair_id, max(turn) as last, max_by(text, turn) as reply from t where role = 'assistant' group by 1),
others as (select a.pair_id, a.last, coalesce(b.reply, (select arg_min(c.reply, c.pair_id) from replies c where c.pair_id > a.pair_id)) as other,
                  b.pair_id is not null or exists (select 1 from replies c where c.pair_id > a.pair_id) as found
           from replies a left join replies b on b.pair_id = xor(a.pair_id, 1)),
swapped as (select t.pair_id, turn, role, case when found and role = 'assistant' and turn = last then other else text end as text
            from t left join others using (pair_id)),
sides as (select 'c' as side, * from t union all select 'r', * from swapped),
numbered as (select *, row_number() over (partition by side, pair_id order by turn nulls first, role, text) as k,
                    '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as shown from sides),
differing as (select pair_id, min(c.k) as k from numbered c join numbered r using (pair_id, k)
              where c.side = 'c' and r.side = 'r' and (c.role <> r.role or c.text <> r.text) group by 1),
sized as (select pair_id, count(*) as n from t group by 1),
cuts as (select pair_id, cast(coalesce(d.k - 1, s.n) as integer) as n_shared from sized s left join differing d using (pair_id)
        ),
placed as (select n.*, c.n_shared, k > c.n_shared as own,
                  sum(case when k > c.n_shared then length(shown) else 0 end) over (partition by side, pair_id order by k) as ends
           from numbered n join cuts c using (pair_id)),
shown as (select pair_id, side, any_value(n_shared) as n_shared, coalesce(string_agg(shown, '' order by k) filter (not own), '') as prompt,
                 coalesce(string_agg(shown, '' order by k) filter (own), '') as rest,
                 coalesce(string_agg((ends - length(text) - 8) || '-' || ends, ',' order by k) filter (own and role = 'assistant'), '') as mask
          from placed group by 1, 2)
select c.pair_id, c.n_shared, c.prompt, c.rest as chosen, r.rest as rejected, c.mask as chosen_mask, r.mask as rejected_mask
from shown c join shown r using (pair_id) where c.side = 'c' and r.side = 'r'
"""

QUERIES = {"op6_preferences": op6_preferences}
ORACLES = {"op6_preferences": OP6_SQL}
