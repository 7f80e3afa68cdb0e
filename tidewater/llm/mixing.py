"""Mixing sources to target weights by weighted fair queueing.

Each document of the shuffled source gets a virtual finish time: the words its source has
sent up to and including it, divided by the target of the source.  Sources are served side
by side in that order.  A source's words are served one after the other, at a rate of its
target, and none runs dry before time 1, so the total budget is used up at virtual time 1,
where every source has sent its target: the mix ends there.  A source whose target exceeds its size starts again,
up to ``most`` times in all.  The document that the end falls into counts with the words
before it.

The running sums are taken in two steps, over ranges of the shuffled order and within
them, so that a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import n_words, stored


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` of each source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating.  Shares add up to all
    words; what a source can't take beyond ``most`` times its size goes to the others by
    weight.  Only one row for each source meets in a window.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", (F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).cast("double"))
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    everything = Window.partitionBy()
    # the sources that reach their cap first are those with the least cap for their weight
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        weighed.withColumn("cap", cap)
        .withColumn("all_words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left_words", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left_words") / F.col("left_weight"))
        # the first level that caps nothing more holds for all sources from there on
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min(F.when(F.col("open"), F.struct(F.row_number().over(by_cap), "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return filled.select("source", "source_size", "weight", target.alias("target"))


def served(docs: DataFrame, *, seed: int = 11, most: int = 3, kept: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, text): ``doc_id, source, size, source_size,
    target, first_finish, whole, taken`` and the columns ``kept``.

    ``first_finish``: virtual finish time of the first copy; ``whole``: whole copies that
    the mix takes; ``taken``: words it takes, those of the document at the end included.
    Size is the number of words, 0 for null.  Rows without words take nothing.  A null
    source is a source; rows that repeat an id are documents of their own.
    """
    sizes = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            n_words("text").alias("size"),
            # by the text as well, so that rows without an id are spread like others
            F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text")).alias("draw"),
            *kept,
        ),
        "sizes",
    )
    goals = stored(targets(sizes, most), "targets")
    # as many ranges as rows in each, so that both steps stay small
    width = max(1, math.isqrt(sizes.count()).bit_length())
    part = F.shiftrightunsigned("draw", 64 - width)
    placed = sizes.withColumn("part", part)
    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("source", "part").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = placed.withColumn("sent", F.sum("size").over(within))
    queue = queue.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    queue = queue.withColumn("sent", F.col("sent") + F.col("start")).drop("s", "p", "start", "part")
    queue = queue.join(
        F.broadcast(goals.withColumnRenamed("source", "s")) if _few(goals) else goals.withColumnRenamed("source", "s"),
        F.col("source").eqNullSafe(F.col("s")),
    )
    # by time 1 the source has sent 'target' words: copy e of a document ends at e * source_size + sent
    limit = F.floor(F.col("target")).cast("long")
    ends = [F.lit(e) * F.col("source_size") + F.col("sent") for e in range(most)]

    def words(end: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), F.col("size") - (end - limit)))

    taken, whole = F.lit(0).cast("long"), F.lit(0)
    for end in ends:
        taken = taken + words(end)
        whole = whole + F.when((end <= limit) & (limit > 0), 1).otherwise(0)
    return queue.select(
        "doc_id", "source", "size", "source_size", "target",
        F.try_divide(F.col("sent").cast("double"), "target").alias("first_finish"),
        whole.cast("int").alias("whole"), taken.cast("long").alias("taken"), *kept,
    )


def _few(goals: DataFrame, bound: int = 1000) -> bool:
    """Whether there are so few sources that they may be broadcast."""
    return goals.limit(bound + 1).count() <= bound


def mix(docs: DataFrame, *, seed: int = 11, most: int = 3) -> DataFrame:
    """The rows of ``docs`` in mixed order, each as often as the mix takes it.

    Documents that the end falls into stay whole if at least half is taken.  Order: virtual
    finish time, by a range sort over all rows.  Columns are those of ``docs``.  Rows
    without words are in no mix; an empty table gives an empty mix; each row that repeats an
    id (null included) is taken as often as its own words are.
    """
    names = docs.columns
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "mixed_rows")
    plan = served(rows, seed=seed, most=most, kept=("__row",)).where("size > 0")
    times = plan.select(
        "__row", F.col("first_finish").alias("__finish"), F.round(F.col("taken") / F.col("size")).cast("int").alias("__copies"),
        F.try_divide(F.col("source_size").cast("double"), "target").alias("__round"),
    ).where("__copies > 0")
    copies = rows.join(times, "__row").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    finish = F.col("__finish") + F.col("__copy") * F.col("__round")
    return copies.withColumn("__finish", finish).orderBy("__finish", "__row", "__copy").select(*names)
