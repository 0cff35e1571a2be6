"""Filter interaction audit: what each of five filters removes, in every order.

A filter order decides only who gets the blame. A document's fate in all 120
orders follows from the set of filters that it fails, so the texts are read
once, into a mask of five bits, and rows are counted into cells of (part,
mask): 32 a part at most. Each cell is then folded over the array of all
orders by higher-order SQL functions (``transform`` over the orders,
``aggregate`` along an order), which makes 600 structs weighted by the cell's
counts; summing them by position gives the report.

Filters (a document fails if): A under 50 words; B 100 * distinct words < 65 *
words; C 100 * upper-case A-Z > 5 * code points; D holds any of ``#$%&*|``; E
some smaller doc_id has an identical text, table-wide. Words are maximal runs
of other characters than space and U+0009 to U+000D.

Defined cases. Null text: empty (so null and empty texts are identical for E).
Null source: the part ''. Null doc_id: neither fails E nor makes another fail
it, and has no labels. Repeated rows: each is a document; equal ids are not
smaller than one another. Several labels of one id: good (toxic) if any says
so. Empty table: no rows. Very long texts: whole, in one row's memory. Other
columns are not read, so clashing names do not matter. Identity of texts is
that of their SHA-256.

A hot text (a third of all rows) is counted before shuffling; its rows meet
their smallest id in a join of narrow rows whose large partitions Spark splits.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.llm.common import drop_folder, stage, staged

LETTERS = "ABCDE"
#: Fixed values of the filters.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
WHITE, UPPER, SYMBOLS = r"[\x20\x09-\x0D]+", "[A-Z]", r"[#$%&*|]"

ORDERS = ["".join(p) for p in permutations(LETTERS)]
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _bit(condition: Column, letter: str) -> Column:
    return F.when(condition, 1 << LETTERS.index(letter)).otherwise(0)


def text_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, the mask of filters A to D, and the text's SHA-256."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"),
                        F.array_remove(F.split(text, WHITE), "").alias("words"))
    n = F.size("words")
    mask = (_bit(n < MIN_WORDS, "A") + _bit(100 * F.size(F.array_distinct("words")) < DISTINCT_PERCENT * n, "B")
            + _bit(100 * F.regexp_count("text", F.lit(UPPER)) > UPPER_PERCENT * F.length("text"), "C")
            + _bit(F.col("text").rlike(SYMBOLS), "D"))
    return words.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: one row per part and set of failed filters."""
    rows, folder = staged(text_masks(docs), "audit-masks")
    copied = (rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
              .filter("copies > 1").select("digest", "first_id"))
    told = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                 F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
            .filter("good or toxic"))
    late = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    cells = (rows.join(copied, "digest", "left")
             .select("doc_id", "part", (F.col("mask") + _bit(late, "E")).alias("mask"))
             .join(told, "doc_id", "left")
             .groupBy("part", "mask")
             .agg(F.count("*").alias("n"), F.count_if(F.coalesce("good", F.lit(False))).alias("good"),
                  F.count_if(F.coalesce("toxic", F.lit(False))).alias("toxic")))
    cells = stage(cells, "audit-cells")
    drop_folder(docs.sparkSession, folder)
    return cells


def _weighted(letter: Column, gone: Column) -> Column:
    """What a cell adds to the report of one step."""
    mask, n = F.col("mask"), F.col("n")
    fails = mask.bitwiseAND(letter) != 0

    def weight(condition: Column, amount: Column) -> Column:
        return F.when(condition, amount).otherwise(F.lit(0).cast("long"))

    here = fails & ~gone
    return F.struct(weight(~fails & ~gone, n).alias("kept"), weight(here, n).alias("removed"),
                    weight(fails & gone, n).alias("redundant"), weight(mask == letter, n).alias("unique_fails"),
                    weight(here, F.col("good")).alias("good_lost"), weight(here, F.col("toxic")).alias("toxic_lost"))


def fold_orders(cells: DataFrame) -> DataFrame:
    """Every cell folded over all orders: part, at (0 to 599) and the summed counts."""
    orders = F.array(*[F.array(*[F.lit(1 << LETTERS.index(c)) for c in order]) for order in ORDERS])
    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in _COUNTS) + ">>"

    def along(order: Column) -> Column:
        start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))

        def step(state: Column, letter: Column) -> Column:
            return F.struct((state["gone"] | (F.col("mask").bitwiseAND(letter) != 0)).alias("gone"),
                            F.concat(state["steps"], F.array(_weighted(letter, state["gone"]))).alias("steps"))

        return F.aggregate(order, start, step, lambda state: state["steps"])

    folded = cells.select("part", F.posexplode(F.flatten(F.transform(orders, along))).alias("at", "w"))
    return folded.groupBy("part", "at").agg(*[F.sum(f"w.{c}").alias(c) for c in _COUNTS])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report: one row per part, order and step (see the module's text)."""
    summed = fold_orders(mask_cells(docs, labels))
    named = summed.select("part", F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("at") / 5).cast("int") + 1).alias("filter_order"),
                          (F.col("at") % 5 + 1).cast("int").alias("step"), *_COUNTS)
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    blamed = (named.groupBy("part", letter.alias("letter")).agg(F.sum("removed").alias("shapley")))
    return (named.withColumn("letter", letter).join(blamed, ["part", "letter"])
            .select("part", "filter_order", "step", *_COUNTS, "shapley"))


#: The same report in DuckDB.
AUDIT_SQL = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from d),
told as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic
         from labels where doc_id is not null group by doc_id),
failed as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    case when len(words) < 50 then 1 else 0 end
    + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when w.doc_id > min(w.doc_id) over (partition by t) then 16 else 0 end as mask
  from w left join told using (doc_id)),
cells as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failed group by all),
f(c, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.c || b.c || g.c || h.c || i.c as filter_order, [a.bit, b.bit, g.bit, h.bit, i.bit] as bits
  from f a, f b, f g, f h, f i where a.bit + b.bit + g.bit + h.bit + i.bit = 31
    and (a.bit | b.bit | g.bit | h.bit | i.bit) = 31),
steps as (
  select filter_order, s.step, bits[s.step] as bit, coalesce(list_sum(bits[1:s.step - 1]), 0) as before
  from orders, (values (1), (2), (3), (4), (5)) s(step)),
report as (
  select part, filter_order, step, bit,
    sum(case when (mask & bit) = 0 and (mask & cast(before as bigint)) = 0 then n else 0 end) as kept,
    sum(case when (mask & bit) <> 0 and (mask & cast(before as bigint)) = 0 then n else 0 end) as removed,
    sum(case when (mask & bit) <> 0 and (mask & cast(before as bigint)) <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when (mask & bit) <> 0 and (mask & cast(before as bigint)) = 0 then good else 0 end) as good_lost,
    sum(case when (mask & bit) <> 0 and (mask & cast(before as bigint)) = 0 then toxic else 0 end) as toxic_lost
  from cells, steps group by all)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from report
"""
