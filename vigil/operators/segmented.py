"""The scoring model for devices too large for one task.

Rows are range-partitioned on (device_key, event_time, seq): Spark samples
the keys and cuts the ordered sequence into ``blocks`` ranges of about equal
size, so a device holding a third of all rows is spread over a third of the
tasks. ``blk`` (the range index) is monotone in the device order, so every
running quantity of the model is a two-level scan:

1. inside each (device, blk): the same window functions as the window plan,
   over a group no larger than one range;
2. across blocks: a small table with one row per (device, blk[, bucket…])
   holds each block's total (count, max, bit-or, last rows); an exclusive
   running total over ``blk`` gives each block its carry-in;
3. the carry joins back and combines with the local value (sum, greatest,
   bit-or, or replaces the first rows' lags).

No carry join ever moves the rows: a carry is broadcast when small and otherwise
dealt by block number as the rows are (``placed``; dealt by a hash of its keys it
would draw the rows after it, several blocks to a task). Only a block's first
device continues from an earlier block, so the carries of whole blocks have at
most ``blocks`` rows (numbering: ``2 * blocks``); those of transitions and of
buckets have at most ``n_buckets`` x (``n_buckets`` + 1) and ``n_buckets`` rows a block.

One range exchange cuts the rows into blocks; a second exchange deals them by
block number (each block is one partition), after which every window, aggregate
and join keeps its partitioning. Two relations are cached: the numbered blocks
with all fields, and, with the model's columns alone, the rows with their running
mode and successor set, so that each row-level window runs once. The results join
the records by (device, block, number in the block), which is unique however
``seq`` repeats or is null. The scores are
checkpointed (reliable, in ``spark.checkpoint.dir``), which cuts the lineage
and lets the caches go. The plan is eager: it runs its jobs when called.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.encoders import bucket_value
from vigil.operators.bitsets import bit_word, n_words
from vigil.operators.score import ORDER, finish
from vigil.settings import ScoreSettings

UNB = Window.unboundedPreceding


def blocked_rows(rows: DataFrame, blocks: int) -> DataFrame:
    """Cut the device-ordered rows into ``blocks`` ranges (``blk``), one
    partition each, number them inside each (device, blk) (``ln``) and read the
    next bucket there (``nb_local``); persisted.

    Every later step reads this one cached relation, so all plan branches
    see the same ``blk`` (two separate range exchanges would each draw their
    own sample and could cut at different rows), and the cached relation
    keeps its partitioning by ``blk``, so no later window, aggregate or carry
    join moves the rows again. A lost cached block is recomputed from the same
    shuffle dependency, hence the same cut. The cache is filled here: plans
    built on a filled cache see its partitioning (an unfilled one reports none)."""
    local = Window.partitionBy("device_key", "blk").orderBy(*ORDER)
    base = (rows.repartitionByRange(blocks, "device_key", *ORDER)
            .withColumn("blk", F.spark_partition_id())
            .repartitionById(blocks, F.col("blk"))
            .select("*", F.row_number().over(local).cast("long").alias("ln"),
                    F.lead("b").over(local).alias("nb_local"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    base.count()
    return base


def score_segmented(prepared: DataFrame, s: ScoreSettings, blocks: int) -> DataFrame:
    base = blocked_rows(prepared, blocks)
    try:
        return _score_blocks(base, s, blocks)
    finally:
        base.unpersist()


def _score_blocks(base: DataFrame, s: ScoreSettings, blocks: int) -> DataFrame:
    """The model over the cached blocked rows; returns the checkpointed
    scores. Only what the model needs goes through the windows and the second
    cache; the other fields join at the end, by a row's number in its block."""
    place = ["device_key", "blk", "ln"]

    def placed(carry: DataFrame) -> DataFrame:
        return carry.repartitionById(blocks, F.col("blk"))

    a = base.select(*place, "nb_local", "b", "measurement")
    words = range(n_words(s.n_buckets))
    succ = [f"succ_{k}" for k in words]
    by_blk = Window.partitionBy("device_key").orderBy("blk")

    # 1. Global row number and the successor across the block edge.
    edge = a.groupBy("device_key", "blk").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min_by("b", "ln").alias("first_b"))
    carry1 = (edge.select(
        "device_key", "blk",
        F.coalesce(F.sum("cnt").over(by_blk.rowsBetween(UNB, -1)), F.lit(0)).cast("long").alias("off"),
        F.lead("first_b").over(by_blk).alias("next_first_b"))
        .filter((F.col("off") > 0) | F.col("next_first_b").isNotNull()))
    # <= 2 * blocks rows: per block only its first device has off > 0 and only
    # its last device continues into a later block.
    a = (a.join(F.broadcast(carry1), ["device_key", "blk"], "left")
          .withColumn("record_number", F.coalesce(F.col("off"), F.lit(0)) + F.col("ln") - 1)
          .withColumn("to_b", F.coalesce(F.col("nb_local"), F.col("next_first_b")))
          .withColumn("to_k", F.coalesce(F.col("to_b"), F.lit(-1)))
          .drop("off", "next_first_b", "nb_local"))

    # 2. Running count of each transition (device, b, to). Per block and
    #    transition: count and last row number; the carry-in count is the
    #    running total over earlier blocks.
    by_pair_blk = Window.partitionBy("device_key", "b", "to_k").orderBy("blk")
    pair_tot = (a.groupBy("device_key", "b", "to_k", "blk")
                .agg(F.count(F.lit(1)).alias("cnt2"), F.max("record_number").alias("last_n"))
                .withColumn("off2", F.coalesce(F.sum("cnt2").over(by_pair_blk.rowsBetween(UNB, -1)),
                                               F.lit(0)).cast("long")))
    carry2 = placed(pair_tot.filter(F.col("off2") > 0).select("device_key", "blk", "b", "to_k", "off2"))
    pair = Window.partitionBy("device_key", "blk", "b", "to_k").orderBy("ln")
    b2 = (a.withColumn("lc", F.row_number().over(pair).cast("long"))
           .join(carry2, ["device_key", "blk", "b", "to_k"], "left")
           .withColumn("c", F.col("lc") + F.coalesce("off2", F.lit(0)))
           .drop("lc", "off2"))

    # 3. Running mode and successor set of b over the rows before this one.
    #    A block's best (count, row, to) for b is, per transition, its count
    #    after the block and its last row: no row-level pass needed.
    mode = F.struct(F.col("c"), F.col("record_number"), F.col("to_b"))
    to_b = F.when(F.col("to_k") >= 0, F.col("to_k"))
    b_tot = pair_tot.groupBy("device_key", "b", "blk").agg(
        F.max(F.struct((F.col("off2") + F.col("cnt2")).alias("c"), F.col("last_n").alias("record_number"),
                       to_b.alias("to_b"))).alias("bm"),
        *[F.bit_or(bit_word(to_b, k)).alias(f"w{k}") for k in words])
    by_b_blk = Window.partitionBy("device_key", "b").orderBy("blk").rowsBetween(UNB, -1)
    carry3 = placed(b_tot.select(
        "device_key", "blk", "b",
        F.struct(F.max("bm").over(by_b_blk).alias("best"),
                 *[F.bit_or(f"w{k}").over(by_b_blk).alias(f"w{k}") for k in words]).alias("cv"))
        .filter(F.col("cv.best").isNotNull()))
    before = Window.partitionBy("device_key", "blk", "b").orderBy("ln").rowsBetween(UNB, -1)
    zero = F.lit(0).cast("long")
    c3 = (b2.select("*", F.max(mode).over(before).alias("best_l"),
                    *[F.bit_or(bit_word("to_b", k)).over(before).alias(f"w{k}_l") for k in words])
            .join(carry3, ["device_key", "blk", "b"], "left")
            .withColumn("best", F.greatest("best_l", "cv.best"))
            .withColumns({f"succ_{k}": F.coalesce(f"w{k}_l", zero).bitwiseOR(F.coalesce(f"cv.w{k}", zero)) for k in words})
            .withColumn("predictionNext", bucket_value(F.coalesce(F.col("best.to_b"), F.col("b")), s))
            .drop("best_l", *[f"w{k}_l" for k in words], "cv", "best", "c", "to_b", "to_k"))
    c3 = c3.persist(StorageLevel.MEMORY_AND_DISK)
    c3.count()

    # 4. Values of the previous one or two rows; a block's first rows take
    #    them from the tail of the device's earlier blocks.
    seq_w = Window.partitionBy("device_key", "blk").orderBy("ln")
    d = c3.select("*", F.lag("predictionNext", 1).over(seq_w).alias("pn1_l"),
                  F.lag("predictionNext", 2).over(seq_w).alias("pn2_l"),
                  F.lag("measurement", 1).over(seq_w).alias("x1_l"),
                  *[F.lag(f"succ_{k}", 1).over(seq_w).alias(f"s{k}_l") for k in words])
    tail = d.select("device_key", "blk", "ln", "predictionNext", "measurement", *succ, "pn1_l").groupBy("device_key", "blk").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.max_by(F.struct("predictionNext", "measurement", *succ, "pn1_l"), "ln").alias("last"))
    carry4 = (tail.select(
        "device_key", "blk",
        F.lag("last.predictionNext").over(by_blk).alias("p_pn1"),
        F.when(F.lag("cnt").over(by_blk) >= 2, F.lag("last.pn1_l").over(by_blk))
         .otherwise(F.lag("last.predictionNext", 2).over(by_blk)).alias("p_pn2"),
        F.lag("last.measurement").over(by_blk).alias("p_x1"),
        *[F.lag(f"last.succ_{k}").over(by_blk).alias(f"p_s{k}") for k in words])
        .filter(F.col("p_pn1").isNotNull()))
    # <= blocks rows: only a block's first device has an earlier block.
    d = d.join(F.broadcast(carry4), ["device_key", "blk"], "left")
    ln = F.col("ln")
    prev = {
        "pn1": F.when(ln == 1, F.col("p_pn1")).otherwise(F.col("pn1_l")),
        "pn2": F.when(ln == 1, F.col("p_pn2")).when(ln == 2, F.col("p_pn1")).otherwise(F.col("pn2_l")),
        "x1": F.when(ln == 1, F.col("p_x1")).otherwise(F.col("x1_l")),
        **{f"p{k}": F.when(ln == 1, F.col(f"p_s{k}")).otherwise(F.col(f"s{k}_l")) for k in words},
    }
    # Cut the lineage (reliable checkpoint in spark.checkpoint.dir) so the
    # cached rows can go.
    from vigil.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(base.sparkSession)
    try:
        results = finish(d, s, prev).select(*place, "record_number", "predictionNext", "prediction", "error", "anomaly")
        # Both sides are dealt by block already, so this join moves no row.
        return base.drop("nb_local").join(results.hint("merge"), place).drop("blk", "ln").checkpoint(eager=True)
    finally:
        c3.unpersist()
