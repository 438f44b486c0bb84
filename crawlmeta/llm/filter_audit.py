"""What each filter of a cleaning chain removes, in every order of the filters.

A document fails a set of filters; the set is a bit mask. Documents become mask
cells first: (part, mask) with counts, at most 2^k cells for each part. Only
cells are folded over the orders. Each cell runs through the array of all orders
with ``transform`` and through the steps of an order with ``aggregate``, which
gives one struct of counts per order and step (600 for five filters), weighted
by the cell's counts. The structs of a part's cells are merged by elementwise
sums. The array of orders is a literal of the plan, so every task has it.

The duplicate filter compares ids over the whole table. Rows meet by the SHA-256
of the text, after rows with equal text, part and labels were counted together,
so a text with very many copies is a few rows before it meets the others.

Defined cases: null text is empty text; a null part is the empty string; a null
id is never a later copy of anything and has no labels; rows that repeat id and
text are copies of equal rank (none of them fails the duplicate filter because
of the others); several label rows of one id count as labelled if any of them
says 1; an empty table gives no rows; only id, text and part are read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed pattern of the contract: characters between words.
WORD_GAP = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Sums that a step carries; a merge adds them place by place.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

#: Letter -> failure condition over (text, words); the letters are names in the result.
ROW_FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda t, w: F.size(w) < 50,
    "B": lambda t, w: 100 * F.size(F.array_distinct(w)) < 65 * F.size(w),
    "C": lambda t, w: 100 * (F.length(t) - F.length(F.translate(t, _CAPITALS, ""))) > 5 * F.length(t),
    "D": lambda t, w: t.rlike(r"[#$%&*|]"),
}
DUPLICATES = "E"


def failed_rows(docs: DataFrame, row_filters: dict[str, Callable[[Column, Column], Column]],
                id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, h (of the text), mask of the row filters that the document fails."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    words = texts.withColumn("w", F.array_remove(F.split("t", WORD_GAP, -1), ""))
    bits = [F.when(fails(F.col("t"), F.col("w")), 1 << i).otherwise(0) for i, fails in enumerate(row_filters.values())]
    mask = F.lit(0)
    for b in bits:
        mask = mask + b
    return words.select("id", "part", F.unhex(F.sha2(F.encode("t", "UTF-8"), 256)).alias("h"), mask.alias("mask"))


def label_flags(labels: DataFrame, id_col: str) -> DataFrame:
    flag = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0)))
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
            .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))


def cells(rows: DataFrame, flags: DataFrame, duplicate_bit: int) -> DataFrame:
    """(part, mask) with n, n_good, n_toxic, the duplicate filter's bit included."""
    zero = F.lit(0)
    seen = (rows.join(flags, "id", "left")
            .withColumns({"good": F.coalesce("good", zero), "toxic": F.coalesce("toxic", zero)}))
    # The join leaves rows dealt by id: equal rows meet without another shuffle.
    per_id = seen.groupBy("id", "h", "mask", "part", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    per_text = per_id.groupBy("h", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    least = per_text.withColumn("least", F.min("first.id").over(Window.partitionBy("h")))
    stay = F.col("no_id") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = least.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), stay.alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << duplicate_bit).alias("mask"), (F.col("n") - stay).alias("n")))))
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"),
        F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))


def folded(letters: str) -> Column:
    """The cell's struct of counts at every step of every order."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    kinds = "".join(f", {c}: long" for c in COUNTS)
    nothing = F.array().cast(f"array<struct<filter_order: string, step: int, letter: string{kinds}>>")
    weight = lambda on, by="n": F.when(on, F.col(by)).otherwise(F.lit(0).cast("long"))

    def step(order: Column, acc: Column, i: Column) -> Column:
        letter = F.substr(order, i, F.lit(1))
        bit = F.call_function("instr", F.lit(letters), letter) - 1
        fails = F.call_function("getbit", F.col("mask"), bit) == 1
        only = F.col("mask") == F.call_function("shiftleft", F.lit(1), bit)
        alive = acc["alive"]
        made = F.struct(
            order.alias("filter_order"), i.alias("step"), letter.alias("letter"),
            weight(alive & ~fails).alias("kept"), weight(alive & fails).alias("removed"),
            weight(~alive & fails).alias("redundant"), weight(only).alias("unique_fails"),
            weight(alive & fails, "n_good").alias("good_lost"), weight(alive & fails, "n_toxic").alias("toxic_lost"))
        return F.struct((alive & ~fails).alias("alive"), F.concat(acc["out"], F.array(made)).alias("out"))

    start = F.struct(F.lit(True).alias("alive"), nothing.alias("out"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(
        F.sequence(F.lit(1), F.lit(len(letters))), start, lambda acc, i: step(order, acc, i), lambda acc: acc["out"])))


def merged(per_cell: Column) -> Column:
    """Elementwise sums of the arrays of a part's cells (at most 2^k arrays)."""
    def add(a: Column, b: Column) -> Column:
        return F.struct(a["filter_order"].alias("filter_order"), a["step"].alias("step"), a["letter"].alias("letter"),
                        *[(a[c] + b[c]).alias(c) for c in COUNTS])

    return F.aggregate(F.slice(per_cell, F.lit(2), F.size(per_cell)), per_cell[0],
                       lambda acc, one: F.zip_with(acc, one, add))


def audit(docs: DataFrame, labels: DataFrame,
          row_filters: dict[str, Callable[[Column, Column], Column]] = ROW_FILTERS, duplicates: str = DUPLICATES,
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: the counts of COUNTS and
    ``shapley``, the documents that the step's filter removes, summed over all orders."""
    letters = "".join(row_filters) + duplicates
    if len(set(letters)) != len(row_filters) + 1:
        raise ValueError("filters need distinct one-letter names")
    counted = cells(failed_rows(docs, row_filters, id_col, text_col, part_col),
                    label_flags(labels, id_col), len(row_filters))
    steps = (counted.select("part", folded(letters).alias("steps"))
             .groupBy("part").agg(F.collect_list("steps").alias("all")).select("part", merged(F.col("all")).alias("steps")))
    def removed_by(letter: str) -> Column:
        return F.aggregate(F.filter("steps", lambda s: s["letter"] == letter), F.lit(0).cast("long"),
                           lambda acc, s: acc + s["removed"])

    removed = F.array(*[removed_by(x) for x in letters])
    return (steps.withColumn("by_filter", removed).select("part", "by_filter", F.inline("steps"))
            .select("part", "filter_order", "step", *COUNTS,
                    F.col("by_filter")[F.call_function("instr", F.lit(letters), F.col("letter")) - 1].alias("shapley")))
