"""Keyed sequence operators that stay parallel when one key is huge.

``row_positions`` numbers rows in a global order, ``number_rows`` numbers
rows per key, ``previous_value`` reads the previous row of the same key.
Each has a window form (one exchange on the key; right when no key is
larger than a task) and a blocked form. ``row_positions`` range-partitions
on the order and fixes block index and in-block position with a reliable
checkpoint; block offsets (one row per block) are broadcast. The per-key
forms place range blocks by (keys, blk) in one filled cache (so every
branch sees the same cut and its partitioning), carry counts or last values
from earlier blocks in a table of at most one row per block (broadcast),
and checkpoint the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _blocks(df: DataFrame, blocks: int | None, cols: list[str]) -> int:
    """Ranges for the blocked forms: as given, else by cores and rows."""
    from vigil.operators.score import block_count
    return blocks or block_count(df.select(*cols))


def blocked(df: DataFrame, cols: list[str], blocks: int | None = None) -> DataFrame:
    """Range-partition on ``cols``, sort inside each range, and fix ``blk``
    (range index) and ``pos`` (0-based row index inside the range) with a
    reliable checkpoint (two range exchanges could cut at different rows)."""
    from vigil.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    one = F.lit(1).cast("long")
    return (df.repartitionByRange(_blocks(df, blocks, cols), *cols)
            .sortWithinPartitions(*cols)
            .withColumn("blk", F.spark_partition_id())
            .withColumn("pos", F.monotonically_increasing_id()
                        - F.call_function("shiftleft", F.col("blk").cast("long"), F.lit(33)) * one)
            .checkpoint(eager=True))


def row_positions(df: DataFrame, order: list[str], name: str = "position",
                  blocks: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """0-based position of every row in the global ``order`` (like a
    zip-with-index): one range exchange, one checkpoint write, and a
    ``blocks``-row table of block offsets that is broadcast on that bound.
    Only the order columns and ``keep`` cross the exchange and the checkpoint."""
    df = df.select(*dict.fromkeys([*order, *(keep or [])]))
    b = blocked(df, order, blocks)
    sizes = b.groupBy("blk").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("blk", F.coalesce(
        F.sum("n").over(Window.orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("off"))
    # ``offsets`` has one row per block (at most ``blocks`` rows); the window
    # above runs over that small table only.
    return (b.join(F.broadcast(offsets), "blk")
             .withColumn(name, (F.col("off") + F.col("pos")).cast("long"))
             .drop("blk", "pos", "off"))


def _placed(df: DataFrame, keys: list[str], order: list[str], blocks: int | None) -> DataFrame:
    """Range blocks (``blk``), one partition each, numbered inside each
    (key, blk) (``ln``), persisted and filled, so every branch sees the same
    cut and keeps the (keys, blk) partitioning (as in the segmented scorer)."""
    from pyspark import StorageLevel
    n = _blocks(df, blocks, keys)
    local = Window.partitionBy(*keys, "blk").orderBy(*order)
    base = (df.repartitionByRange(n, *keys, *order)
            .withColumn("blk", F.spark_partition_id())
            .repartitionById(n, F.col("blk"))
            .select("*", F.row_number().over(local).cast("long").alias("ln"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    base.count()
    return base


def _finish_placed(base: DataFrame, out: DataFrame) -> DataFrame:
    """Checkpoint the result (cuts the lineage) and release the cache."""
    from vigil.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(base.sparkSession)
    try:
        return out.checkpoint(eager=True)
    finally:
        base.unpersist()


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = "record_number",
                plan: str = "window", blocks: int | None = None) -> DataFrame:
    """0-based row number per key in ``order``; ``plan`` is ``window`` or ``blocked``."""
    if plan == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))
    base = _placed(df, keys, order, blocks)
    edge = base.groupBy(*keys, "blk").agg(F.count(F.lit(1)).alias("cnt"))
    by_blk = Window.partitionBy(*keys).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (edge.select(*keys, "blk", F.sum("cnt").over(by_blk).alias("off"))
             .filter(F.col("off").isNotNull()))
    # Only a range's first key continues from earlier ranges: <= blocks rows.
    out = (base.join(F.broadcast(carry), keys + ["blk"], "left")
           .withColumn(name, (F.coalesce(F.col("off"), F.lit(0)) + F.col("ln") - 1).cast("long"))
           .drop("blk", "ln", "off"))
    return _finish_placed(base, out)


def previous_value(df: DataFrame, keys: list[str], order: list[str], col: str, name: str,
                   plan: str = "window", blocks: int | None = None) -> DataFrame:
    """``col`` of the previous row of the same key in ``order`` (null first);
    ``plan`` is ``window`` or ``blocked``."""
    if plan == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.lag(col).over(w))
    base = _placed(df, keys, order, blocks)
    local = Window.partitionBy(*keys, "blk").orderBy("ln")
    tail = base.groupBy(*keys, "blk").agg(F.max_by(F.col(col), F.col("ln")).alias("last"))
    by_blk = Window.partitionBy(*keys).orderBy("blk")
    carry = (tail.select(*keys, "blk", F.lag("last").over(by_blk).alias("carry"),
                         F.lag("blk").over(by_blk).alias("prev_blk"))
             .filter(F.col("prev_blk").isNotNull()).drop("prev_blk"))
    # Only a range's first key has an earlier range: <= blocks rows.
    out = (base.withColumn("_l", F.lag(col).over(local))
           .join(F.broadcast(carry), keys + ["blk"], "left")
           .withColumn(name, F.when(F.col("ln") == 1, F.col("carry")).otherwise(F.col("_l")))
           .drop("_l", "carry", "blk", "ln"))
    return _finish_placed(base, out)
