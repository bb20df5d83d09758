"""Mix sources to target weights by weighted fair queueing.

Every source offers its documents in a shuffled order, and then once more in
another one. A document is served at its virtual time: the words of its source
up to its middle, divided by the target of the source. All documents are sorted
by virtual time and the sequence is cut where the budget is used up.

Running totals over one source and over the whole mix are taken in two steps,
over ranges and within each range, so that no source and no budget passes
through one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.tables import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
# Rows that one range of a running total is meant to have.
RANGE_ROWS = 1 << 12

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """``(source, source_size, target)`` from rows ``(source, size)``.

    Sources in the order of their code points, null last, get the weights in
    turn. Together they share ``share`` times all words; no target exceeds
    ``EPOCHS`` times its source, and what is above goes to the others by weight.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank - 1) % len(weights) + 1)
    limit = (EPOCHS * F.col("source_size")).cast("double")
    ranked = totals.withColumn("weight", weight).withColumn("limit", limit)
    # Sources fill up in the order of limit over weight. The level is the
    # target per weight of all that do not fill up.
    full_at = F.col("limit") / F.col("weight")
    order = everything.orderBy(full_at, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    budget = share * F.sum("source_size").over(everything).cast("double")
    levels = ranked.select(
        "*",
        F.row_number().over(order).alias("nth"),
        (
            (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("level"),
    )
    level = F.min(F.when(F.col("level") < full_at, F.struct("nth", "level"))).over(
        everything
    )
    share_of = level["level"] * F.col("weight")
    return levels.select(
        "source",
        "source_size",
        F.least("limit", F.coalesce(share_of, F.col("limit"))).alias("target"),
    )


def fair_queue(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every copy on offer, in the order of the mix by ``virtual_time``.

    Columns: ``row`` (a number of the document's row), the id, ``source``,
    ``size``, ``source_size``, ``target``, ``epoch``, ``virtual_time`` and
    ``taken``. A copy is taken if at least half of it fits into the budget.
    """
    sized = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "sized",
    )
    ranges = max(1, sized.count() * EPOCHS // range_rows)
    digits = max(1, math.ceil(math.log(ranges, 16)))
    targets = stored(source_targets(sized, weights, share), "targets")
    epoch = F.explode(F.array(*map(F.lit, range(EPOCHS)))).alias("epoch")
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    offers = sized.select("*", epoch).withColumn(
        "key", F.md5(F.concat_ws(":", F.col("epoch").cast("string"), name))
    )
    offers = offers.withColumn("lot", F.substring("key", 1, digits))

    # Words of the source before each lot, then within it.
    lots = offers.groupBy("source", "epoch", "lot").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("epoch", "lot")
    lots = lots.withColumn("before", F.sum("words").over(ahead) - F.col("words"))
    lots = lots.alias("l").join(
        targets.alias("t"), F.col("l.source").eqNullSafe(F.col("t.source"))
    )
    lots = lots.select("l.source", "epoch", "lot", "before", "source_size", "target")
    within = (
        Window.partitionBy("source", "epoch", "lot")
        .orderBy("key", F.col("id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = offers.withColumn("words", F.sum("size").over(within))
    placed = summed.alias("o").join(
        lots.alias("l"),
        F.col("o.source").eqNullSafe(F.col("l.source"))
        & (F.col("o.epoch") == F.col("l.epoch"))
        & (F.col("o.lot") == F.col("l.lot")),
        # Every copy has its lot. A left join never broadcasts the copies, which
        # Spark takes for few as they are made by an explode.
        "left",
    )
    middle = 2 * (F.col("before") + F.col("words")) - F.col("size")
    timed = placed.select(
        "o.row", "o.id", "o.source", "o.size", "o.epoch", "key", "source_size",
        "target",
        F.when(F.col("target") > 0, middle.cast("double") / (2 * F.col("target")))
        .otherwise(F.lit(0.0))
        .alias("virtual_time"),
    )
    timed = stored(
        timed.withColumn("slot", F.floor(F.col("virtual_time") * ranges)), "timed"
    )

    # The same for the whole mix: words before each slot, then within it.
    slots = timed.groupBy("slot").agg(F.sum("size").alias("words"))
    slots = slots.select(
        "slot",
        (F.sum("words").over(Window.orderBy("slot")) - F.col("words")).alias("before"),
    )
    queue = (
        Window.partitionBy("slot")
        .orderBy(
            "virtual_time",
            F.col("source").asc_nulls_last(),
            "epoch",
            "key",
            F.col("id").asc_nulls_last(),
            "size",
        )
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    budget = share * sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    served = timed.withColumn("words", F.sum("size").over(queue))
    served = served.join(slots, "slot", "left")
    reached = 2 * (F.col("before") + F.col("words")) - F.col("size")
    return served.select(
        "row", F.col("id").alias(id_col), "source", "size", "source_size", "target",
        "epoch", "virtual_time", (reached <= 2 * budget).alias("taken"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``.

    Sizes are words. ``taken`` is a multiple of the size: a document is taken
    whole, at most ``EPOCHS`` times. Sources miss their targets by about half a
    document. The order depends on the id alone, so that a rerun gives the same
    mix; rows that repeat an id follow each other by size.

    Null and empty texts have size 0 and are taken 0 times. Null sources are one
    source, the last. Null ids are ordinary ids that come after equal keys. An
    empty table gives no rows, and other columns are not looked at.
    """
    offers = fair_queue(
        docs, id_col, text_col, source_col, weights, share, range_rows
    )
    words = F.when(F.col("taken"), F.col("size")).otherwise(F.lit(0))
    return (
        offers.groupBy("row", id_col, "size", "source_size", "target")
        .agg(F.sum(words).alias("taken"))
        .drop("row")
    )
