"""Operator 12: mixing sources to target weights by a low-discrepancy schedule.

1. Sizes are words.  The sources, by code point with null last, have the weights 1, 2,
   3, repeating; a source's target is its weight times one level for all, but never more
   than ``cap`` times its size, and the level is the one at which the targets add up to
   all words.  It rises from the uncapped level until no further source is capped, one
   aggregate over the sources a round.
2. The documents of a source, shuffled by a hash, form one stream that is cut into
   blocks of ``block`` words.  A target needs a number of slots: whole passes through
   the blocks, and a part of one whose last block is cut to the word.
3. Cumulative weights, counted in slots, give each source an interval of the whole
   numbers below 2**k.  Van der Corput's point of time t is t's bits reversed, so the
   times of a source are the reversed numbers of its interval: the map is inverted, and
   no point has to be looked up.  The rank of a slot among those of its source follows
   from its bits alone (how many numbers of an interval have a given remainder), so
   neither step shuffles anything.
4. Slot ``rank`` takes block ``rank mod blocks``; slots and the pieces of documents are
   joined on (source, block), at most ``cap`` slots and ``block`` pieces to a key.

Sums along an order (source numbers, slot intervals, places in a stream) are two-level:
totals of bounded parts, then a window inside each part, so a source of any size is
spread.  The order depends on hashes only: reruns agree.

Defined cases: a null text has no words, takes no place and is returned with taken 0;
a null source is a source; rows alike in id, source and size are told apart by number;
a null id is an id; sources without words have target 0; empty table: empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiflow.llm.graph import saved_table

WEIGHTS, CAP = 3, 3       # weights 1 to 3 in turn; a source is read at most three times
BLOCK = 1024              # words of a block
PART_ROWS = 50_000        # documents of a source that one window task orders, about
SLOTS = 1 << 14           # slots that one row of an interval's table stands for
SEED = "mix"


class Mix(NamedTuple):
    documents: DataFrame    # doc_id, copy, source, size, source_size, target
    schedule: DataFrame     # place, source_no, epoch, block, words: the slots, in the order of place
    spans: DataFrame        # place, epoch, doc_id, copy, source, from_word, n_words: what each slot takes


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running(rows: DataFrame, groups: list[str], part: str, order: list, value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over earlier rows of the group, by part and then by order."""
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*groups, part).agg(F.sum(value).alias("_sum")).select(
        *groups, part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(totals, [*groups, part]).withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_before"))


def level(sources: DataFrame) -> float:
    """Words per unit of weight at which the capped targets add up to all words."""
    words, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    now, capped = (words or 0) / (weight or 1), -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(now)
        n, taken, free = sources.agg(F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not free:
            return now
        capped, now = n, ((words or 0) - (taken or 0)) / free


def planned(sized: DataFrame, block: int = BLOCK, cap: int = CAP) -> DataFrame:
    """A row per source: its number, target, words to take, blocks, and slots [lo, hi)."""
    part = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    part = saved_table(part.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()).withColumn("_one", F.lit(1)))
    part = running(part, [], "_part", [F.col("source").asc_nulls_last()], "_one", "source_no").drop("_one")
    part = saved_table(part.withColumn("weight", F.col("source_no") % WEIGHTS + 1).withColumn("most", F.col("source_size") * cap))
    now = level(part)
    size = F.col("source_size")
    part = part.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(now)))
    part = part.withColumn("words", F.floor(F.col("target") + 0.5)).withColumn("blocks", F.ceil(size / block).cast("long"))
    part = part.withColumn("need", F.when(size > 0, F.expr("words div source_size") * F.col("blocks") + F.expr(f"(words % source_size + {block - 1}) div {block}")).otherwise(0))
    part = running(part, [], "_part", ["source_no"], "need", "lo")
    return saved_table(part.select("source", "source_no", "source_size", "target", "words", "blocks", "lo", (F.col("lo") + F.col("need")).alias("hi")))


# The masks that swap neighbouring groups of 1, 2, 4, 8, 16 bits
SWAPS = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF))


def reversed_bits(i: Column, k: int) -> Column:
    """The number whose k bits are those of i in reverse order (k > 0)."""
    for n, mask in SWAPS:
        i = F.shiftrightunsigned(i, n).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(i.bitwiseAND(F.lit(mask)), n))
    i = F.shiftrightunsigned(i, 32).bitwiseOR(F.shiftleft(i, 32))
    return F.shiftrightunsigned(i, 64 - k)


def rank(i: Column, lo: Column, hi: Column, k: int) -> Column:
    """How many numbers of [lo, hi) come before i when their k bits are read in reverse.

    A number does so if it agrees with i in its lowest p bits and has a 0 where i has a 1.
    """
    total = F.lit(0).cast("long")
    for p in range(k):
        rest = F.lit((2 << p) - 1) - i.bitwiseAND(F.lit((1 << p) - 1))
        upto = lambda x: F.shiftright(x + rest, p + 1)  # noqa: E731, B023
        total = total + F.shiftright(i, p).bitwiseAND(F.lit(1)) * (upto(hi) - upto(lo))
    return total


def slots(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """(place, source_no, epoch, block, words) of every slot of the schedule."""
    n = plan.agg(F.max("hi")).first()[0] or 0
    k = max(1, (n - 1).bit_length())
    # an interval in rows of bounded length, so that no task writes out a whole source
    chunk = F.explode(F.sequence(F.expr(f"lo div {SLOTS}"), F.expr(f"(hi - 1) div {SLOTS}")))
    plan = plan.where("hi > lo").select("*", chunk.alias("_chunk")).repartition("_chunk", "source_no")
    i = F.explode(F.sequence(F.greatest("lo", F.col("_chunk") * SLOTS), F.least("hi", (F.col("_chunk") + 1) * SLOTS) - 1))
    out = plan.select("*", i.alias("_i")).withColumn("_rank", rank(F.col("_i"), F.col("lo"), F.col("hi"), k))
    out = out.withColumn("epoch", F.expr("_rank div blocks")).withColumn("block", F.col("_rank") % F.col("blocks"))
    left = F.least(F.col("source_size"), F.col("words") - F.col("epoch") * F.col("source_size")) - F.col("block") * block
    return out.select(reversed_bits(F.col("_i"), k).alias("place"), "source_no", "epoch", "block", F.least(F.lit(block), left).alias("words"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, cap: int = CAP,
        seed: str = SEED) -> Mix:
    """Plan, schedule and spans of a mix; ``seed`` chooses another shuffle."""
    sized = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), n_words(text).alias("size"))
    sized = saved_table(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")))
    plan = planned(sized, block, cap)
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "copy").cast("binary"))
    rows = sized.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies").withColumn("_key", key)
    p = plan.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    parts = 1 + sized.count() // PART_ROWS
    head = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = running(rows.withColumn("_part", F.shiftright(head * parts, 32)), ["source_no"], "_part", ["_key", "doc_id"], "size", "_at")
    documents = rows.drop("_part")
    pieces = documents.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"_at div {block}"), F.expr(f"(_at + size - 1) div {block}"))))
    pieces = (pieces.withColumn("_from", F.greatest(F.lit(0), F.col("_at") - F.col("block") * block))
              .withColumn("_to", F.least(F.lit(block), F.col("_at") + F.col("size") - F.col("block") * block))
              .select("doc_id", "copy", "source", "size", "source_no", "block", "_from", "_to", (F.col("block") * block + F.col("_from") - F.col("_at")).alias("from_word")))
    schedule = slots(plan, block)
    spans = pieces.join(schedule, ["source_no", "block"]).where("words > _from").select(
        "place", "epoch", "doc_id", "copy", "source", "size", "from_word", (F.least("words", "_to") - F.col("_from")).alias("n_words"))
    return Mix(documents.select("doc_id", "copy", "source", "size", "source_size", "target"), schedule, spans)


def taken(m: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for every document."""
    key = ["doc_id", "copy", "source", "size"]
    none = m.documents.withColumn("n_words", F.lit(0).cast("long"))
    both = none.unionByName(m.spans.select(*key, "n_words"), allowMissingColumns=True)
    return both.groupBy(*key).agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"),
                                  F.sum("n_words").alias("taken")).select("doc_id", "size", "source_size", "target", "taken", "source")


# The schedule decides when a block is read, its length how much of it: a document's words
# in a mix of w words are those of whole passes and of the stream's first w mod size words.
ORACLE = rf"""
with d as (select doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
c as (select *, row_number() over (partition by doc_id, source, size) as copy from d),
s as (select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % {WEIGHTS} + 1 as weight from d group by source),
r as (select *, {CAP} * source_size as most, (select sum(size) from d) as total,
      coalesce(sum({CAP} * source_size) over (order by {CAP} * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as below,
      sum(weight) over (order by {CAP} * source_size / weight, source nulls last rows between current row and unbounded following) as free from s),
l as (select coalesce(max((total - below)::double / free::double) filter (where (total - below)::double / free::double * weight <= most), 0) as level from r),
t as (select source, source_size, least(most::double, weight * level) as target, floor(least(most::double, weight * level) + 0.5)::bigint as words from r, l),
o as (select c.*, coalesce(sum(size) over (partition by source order by md5(concat_ws('|', '{SEED}', coalesce(doc_id::varchar, ''), size, copy)), doc_id
      rows between unbounded preceding and 1 preceding), 0) as pos from c)
select doc_id, size, source_size, target, case when source_size = 0 then 0 else
       (words // source_size) * size + greatest(0, least(pos + size, words % source_size) - pos) end::bigint as taken, o.source
from o join t on o.source is not distinct from t.source"""
