"""What each filter of a chain removes under every order of the filters.

A document's failed filters make a mask. Under one order a document goes at the first filter of its
mask, so the orders in which a mask goes at a certain step are those with certain beginnings, and the
orders with a common beginning are neighbours in the dictionary: their Lehmer ranks are one interval.
Documents are therefore counted by mask once; each mask adds its counts at the first rank of its
intervals and takes them off behind the last one, and running sums over the ranks give the counts of
every order and step. After the counting nothing depends on the number of documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parcelflow.llm.shared import written

SPACES = r"[\x20\x09-\x0D]+"


def lehmer_rank(beginning: Sequence[int], n: int) -> int:
    """Rank of the first permutation of 0..n-1 with the given beginning, in dictionary order."""
    return sum(
        sum(1 for other in range(item) if other not in beginning[:at]) * factorial(n - 1 - at)
        for at, item in enumerate(beginning)
    )


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last) for the orders under which the mask goes at the step."""
    found = []
    for mask in range(1, 2**n):
        inside = [i for i in range(n) if mask >> i & 1]
        outside = [i for i in range(n) if not mask >> i & 1]
        for passed in range(len(outside) + 1):
            length = factorial(n - 1 - passed)
            starts = sorted(lehmer_rank((*p, i), n) for p in permutations(outside, passed) for i in inside)
            first = behind = starts[0]
            for start in starts:
                if start != behind:
                    found.append((mask, passed + 1, first, behind))
                    first = start
                behind = start + length
            found.append((mask, passed + 1, first, behind))
    return found


def order_steps(names: Sequence[str]) -> list[tuple[int, int, str, int]]:
    """(rank, step, the order as text, number of the filter at that step) for all orders."""
    orders = permutations(range(len(names)))
    return [(rank, step, "".join(names[i] for i in order), order[step - 1])
            for rank, order in enumerate(orders) for step in range(1, len(names) + 1)]


def audit_orders(flagged: DataFrame, filters: Sequence[str], part: str, marks: Sequence[str] = ()) -> DataFrame:
    """Counts of every part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, shapley, <mark>_lost.

    ``flagged`` has one row per document: the part (not null), a boolean column for each of up to seven filters
    (true: fails; null: passes) and boolean ``marks`` (null: unmarked). An order is named by its filters' names one
    after another. Parts without failures have their rows too, with zeros; an empty table gives no rows.
    """
    if not 0 < len(filters) <= 7:
        raise ValueError("an audit takes one to seven filters")
    spark, n = flagged.sparkSession, len(filters)
    mask = sum((F.when(F.col(name), 1 << i).otherwise(0) for i, name in enumerate(filters)), F.lit(0))
    counted = flagged.groupBy(F.col(part).alias("part"), mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("removed"), *[F.count_if(F.coalesce(m, F.lit(False))).alias(f"{m}_lost") for m in marks]
    )
    counted = written(counted, "filter-masks")
    counts = ["removed", *[f"{m}_lost" for m in marks]]

    # bounded by the number of filters alone
    intervals = spark.createDataFrame(removal_intervals(n), "mask int, step int, first int, behind int")
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("behind").alias("rank"), F.lit(-1).alias("sign"))))
    changes = (
        counted.join(F.broadcast(intervals), "mask").select("*", ends.alias("end"))
        .groupBy("part", "step", F.col("end.rank").alias("rank"))
        .agg(*[F.sum(F.col(c) * F.col("end.sign")).alias(c) for c in counts])
    )

    def in_each(test) -> Column:
        """Documents per filter whose mask passes the test for the filter's bit."""
        return F.array(*[F.sum(F.when(test(1 << i), F.col("removed")).otherwise(0)) for i in range(n)])

    totals = counted.groupBy("part").agg(
        F.sum("removed").alias("documents"),
        in_each(lambda bit: F.col("mask").bitwiseAND(bit) != 0).alias("fails"),
        in_each(lambda bit: F.col("mask") == bit).alias("only"),
    )
    steps = spark.createDataFrame(order_steps(filters), "rank int, step int, filter_order string, filter int")
    grid = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(n)))
    )
    # windows of at most 5,040 ranks of a part
    ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = grid.join(changes, ["part", "step", "rank"], "left").select(
        "part", "step", "rank", "documents", "fails", "only", *[F.sum(F.coalesce(c, F.lit(0))).over(ranks).alias(c) for c in counts]
    )
    named = summed.join(F.broadcast(steps), ["rank", "step"])
    return named.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.sum("removed").over(so_far)).alias("kept"),
        "removed",
        (F.get("fails", "filter") - F.col("removed")).alias("redundant"),
        F.get("only", "filter").alias("unique_fails"),
        *counts[1:],
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def text_faults(text: Column) -> dict[str, Column]:
    """Conditions on one text: too few words, few distinct ones, many capitals, marks of code or tables."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def flag_documents(docs: DataFrame, labels: DataFrame, part: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The part of every document ('' for null), its failures A to E, and the marks good and toxic.

    A to D are ``text_faults`` of the whole text (null: empty). E: some document with a smaller id has the same
    text; a null id is smaller than none and has none below it, rows that share an id are not copies of each
    other. A document labelled several times is good (toxic) if one label says so.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    faults = [condition.alias(name) for name, condition in text_faults(F.col("_text")).items()]
    # one pass over the texts; what follows reads narrow rows
    narrow = written(rows.select("_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_digest"), *faults), "filter-flags")
    first = narrow.groupBy("_digest").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = labels.groupBy(F.col(doc_id).alias("_id")).agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    return (
        narrow.join(first, "_digest", "left").join(marked, "_id", "left")
        .select("part", "A", "B", "C", "D", F.coalesce(F.col("_id") > F.col("_first"), F.lit(False)).alias("E"), "good", "toxic")
    )
