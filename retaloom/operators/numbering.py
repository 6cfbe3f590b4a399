"""Dense global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.session import settle

_IN_BLOCK = (1 << 33) - 1  # low bits of monotonically_increasing_id: row within its task


BLOCK_BYTES = 256 << 20  # of the input, for a block
UNKNOWN = 1 << 60  # sizes from here on stand for none known, as of rows handed over by the driver


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that the frame is made from, as far as Spark knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN)


def number_rows(
    df: DataFrame,
    order: list[str | Column],
    out: str,
    tie: str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Same numbers as ``row_number() over (order by ...)``, computed in parallel.

    Rows are range-partitioned on the whole order, so one hot date is spread by
    the later order keys; each task numbers its own sorted block, and a block's
    start is the sum of the sizes before it. The ranged rows are settled once:
    sizes and numbers must come from the same placement, also after a lost
    executor. There are at least so many blocks that each stands for BLOCK_BYTES of the
    input. ``tie`` names a deterministic per-row value that spreads identical
    copies over blocks; it is dropped from the result.
    """
    spark = df.sparkSession
    keys = [F.col(k) if isinstance(k, str) else k for k in order] + ([F.col(tie)] if tie else [])
    count = blocks or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                          -(-_input_bytes(df) // BLOCK_BYTES))
    placed = settle(
        df.repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_block", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_BLOCK)))
    )
    # At most one row per block, so this window and the broadcast stay small
    # whatever the size of the data.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    drop = ["_block", "_row", "_start"] + ([tie] if tie else [])
    return (
        placed.join(F.broadcast(starts), "_block")
        .withColumn(out, (F.col("_start") + F.col("_row") + 1).cast("bigint"))
        .drop(*drop)
    )
