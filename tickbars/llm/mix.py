"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source's documents are dealt over shards of about SHARD_TOKENS words (a large
source has more of them) and stand there in a seeded order; the words of a shard,
one document after the other, are cut in equal blocks.  The quota of blocks goes to
sources by highest quotients, then to a source's shards likewise; a shard takes its
quota as whole passes over its blocks and, for the rest, the blocks that follow a
seeded one.  What a document gives is the overlap of its words with those blocks.

Targets: sources by code point (null last) weigh ``WEIGHTS`` in turn and share all
words; a target ends at LIMIT times its source's size and the excess is shared by
weight among the others.

Defined results: a null or empty text has no words and gives none.  A source
without words has target 0.  Rows alike in id and text are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.rows import KEY, keyed, row_key, text_key
from tickbars.session import stored

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK_TOKENS = 128
SHARD_TOKENS = 1 << 20
SEED = 20240101


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A key that is never null and sorts like the source, null last."""
    return F.when(source.isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), source))


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """*rows* with ``rank`` from 0 in the order of the unique *key*: ranges are counted, then numbered inside."""
    spread = stored(rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = spread.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")  # a row for each partition
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return spread.withColumn("_at", inside).join(starts, "_part").select(
        *rows.columns, (F.col("_start") + F.col("_at")).cast("long").alias("rank")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """``target`` of each row (key, source_size, weight): shares by weight, each at most LIMIT sizes."""
    cap = (F.col("source_size") * LIMIT).cast("double")
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level >= cap
        row = sizes.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(over, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
        ).first()
        if not row["words"] or not row["weight"] or row["n"] == capped:
            break
        level, capped = (row["words"] - row["held"]) / row["weight"], row["n"]
    target = F.lit(0.0) if level is None else F.least(cap, F.col("weight") * F.lit(float(level)))
    return sizes.withColumn("target", target)


def apportion(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """``seats`` for each row (votes, most) of a group with ``house`` seats, by Sainte-Lague.

    Seats start at the rounded share; a group short of seats gives them to the
    highest next quotients votes / (2 seats + 1), one with too many takes the lowest
    last ones back, in the order of *key* where they tie.  No row has over ``most``.
    """
    whole = Window.partitionBy(*group)
    votes = F.sum("votes").over(whole)
    share = F.when(votes > 0, F.col("votes") * F.col("house") / votes).otherwise(0.0)
    state = rows.withColumn("_share", share).withColumn(
        "seats", F.least("most", F.floor(F.col("_share") + 0.5)).cast("long")
    )
    while True:
        state = stored(state, "seats")
        short = state.withColumn("_short", F.col("house") - F.sum("seats").over(whole)).withColumn(
            "_n", F.count("*").over(whole)
        ).where("_short <> 0")
        # seats that move in one pass: in proportion to the share
        room = F.when(F.col("_short") > 0, F.col("most") - F.col("seats")).otherwise(F.col("seats"))
        part = (F.abs("_short") + F.col("_n") / 2) * F.col("_share") / F.greatest("house", F.lit(1))
        steps = F.least(room, F.abs("_short"), F.ceil(part) + 1).cast("int")
        moves = short.where((F.col("votes") > 0) & (steps > 0)).select(
            *group, key, "votes", "seats", "_short", F.explode(F.sequence(F.lit(1), steps)).alias("_step")
        )
        quotient = F.when(
            F.col("_short") > 0, -F.col("votes") / (2 * (F.col("seats") + F.col("_step")) - 1)
        ).otherwise(F.col("votes") / (2 * (F.col("seats") - F.col("_step")) + 1))
        best = Window.partitionBy(*group).orderBy(quotient, key, "_step")
        won = moves.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= F.abs("_short"))
        change = stored(
            won.groupBy(*group, key).agg(F.sum(F.signum("_short")).cast("long").alias("_change")), "moves"
        )
        if change.isEmpty():
            return state.drop("_share")
        state = state.join(change, [*group, key], "left").withColumn(
            "seats", F.col("seats") + F.coalesce("_change", F.lit(0))
        ).drop("_change")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, text_key."""
    sizes = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key"),
            _source_key(F.col(source)).alias("key"), n_words(F.col(text)).alias("size"),
        ),
        "sizes",
    )
    by_source = ranked(sizes.groupBy("key").agg(F.sum("size").alias("source_size")), "key")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    wanted = stored(targets(stored(by_source.withColumn("weight", weight), "sources")), "targets")

    n_cells = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_TOKENS)).cast("long")
    cell = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), n_cells)
    dealt = sizes.join(wanted, "key").withColumn("cell", cell)
    blocks = F.when(F.col("cell_size") > 0, F.greatest(F.lit(1), F.round(F.col("cell_size") / BLOCK_TOKENS)))
    cells = stored(
        dealt.groupBy("key", "cell").agg(
            F.sum("size").alias("cell_size"), F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
        ).withColumn("blocks", F.coalesce(blocks, F.lit(0)).cast("long")),
        "cells",
    )
    sources = cells.groupBy("key").agg(
        F.sum("blocks").alias("blocks"), F.try_divide(F.first("target"), F.first("source_size")).alias("ratio")
    ).withColumn("votes", F.coalesce(F.col("ratio") * F.col("blocks"), F.lit(0.0)))
    house = F.round(F.sum("votes").over(Window.partitionBy("all"))).cast("long")
    quota = apportion(
        sources.withColumn("all", F.lit(0)).withColumn("house", house).withColumn("most", F.col("blocks") * LIMIT),
        ["all"], "key",
    ).select("key", F.col("seats").alias("house"))
    shares = cells.join(quota, "key").withColumn("votes", F.col("blocks").cast("double")).withColumn(
        "most", F.col("blocks") * LIMIT
    )
    quotas = apportion(shares, ["key"], "cell").select(
        "key", "cell", "cell_size", "blocks", "seats",
        F.pmod(F.xxhash64(F.lit(seed), "key", "cell"), F.greatest("blocks", F.lit(1))).alias("start"),
    )

    order = Window.partitionBy("key", "cell").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.join(quotas, ["key", "cell"])
    passes = F.expr("seats div greatest(blocks, 1)")
    rest = F.expr("seats % greatest(blocks, 1)")
    edge = lambda block: F.floor(block * F.col("cell_size") / F.greatest("blocks", F.lit(1))).cast("long")
    begin, stop = edge(F.col("start")), edge(F.col("start") + rest)
    overlap = lambda low, high: F.greatest(
        F.lit(0), F.least(F.col("end"), high) - F.greatest(F.col("end") - F.col("size"), low)
    )
    # the chosen blocks may run over the end of the shard and go on at its start
    chosen = overlap(begin, F.least(stop, F.col("cell_size"))) + overlap(F.lit(0), stop - F.col("cell_size"))
    return joined.select(
        "doc_id", "size", "source_size", "target",
        (passes * F.col("size") + F.when(rest > 0, chosen).otherwise(0)).cast("long").alias("taken"),
        "text_key",
    )


def keep(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix as documents, with the columns of *docs*: one row for each time that the mix takes the document.

    A document cut by the edge of a block is in if at least half of it is.
    """
    copies = mix(docs, doc_id, source, text).select(
        *row_key(F.col("doc_id"), F.col("text_key")),
        F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int").alias("_n"),
    ).groupBy(*KEY).agg(F.sum("_n").cast("int").alias("_copies")).where("_copies > 0")
    once = keyed(docs, doc_id, text).join(copies, KEY)
    return once.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")
