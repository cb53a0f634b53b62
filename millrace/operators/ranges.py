"""Pruning a sorted index by key ranges.

A block starts at its first key and ends before the next block's; a prefix
covers ``[p, p + 0xff)``. The blocks that overlap a prefix are consecutive: from
the last one that starts at or before the prefix to the last one that starts
before its end. Both are found in the merged sort order, and a running sum of
where ranges begin and end marks the blocks inside any of them: no block is
compared with a range, however many there are of either. Orders are total over
even range partitions, so a host with a third of all keys spreads over a third
of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Sorts after every key.
AFTER = "￿"


def blocks(keys: DataFrame, key: str = "key", size: int = 10) -> DataFrame:
    """``block, first_key, next_key``, staged: every ``size`` keys in order make a block.

    The order is total over the index, so ranks are taken in two steps: range
    partitions sorted in parallel, offset by the counts of those before.
    """
    spread = stage(keys.select(key).repartitionByRange(F.col(key)).withColumn("_p", F.spark_partition_id()), "keys")
    counts = spread.groupBy("_p").agg(F.count("*").alias("_c"))
    offsets = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_o"))  # a row per partition
    ranked = spread.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(key))).join(F.broadcast(offsets), "_p")
    firsts = (
        ranked.withColumn("_n", F.col("_r") + F.col("_o") - 1)
        .where(F.col("_n") % size == 0)
        .select((F.col("_n") / size).cast("long").alias("block"), F.col(key).alias("first_key"))
    )
    following = firsts.select((F.col("block") - 1).alias("block"), F.col("first_key").alias("next_key"))
    return stage(firsts.join(following, "block", "left").withColumn("next_key", F.coalesce("next_key", F.lit(AFTER))), "index")


def overlapping(index: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Blocks that overlap any prefix range, each once. ``index`` is read twice, so give it staged."""
    p = prefixes.select("prefix").where("prefix is not null").distinct()
    begin, stop = (F.struct(F.lit(i).alias("end"), F.concat("prefix", F.lit(tail)).alias("probe")) for i, tail in enumerate(("", AFTER)))
    ends = p.select(F.explode(F.array(begin, stop)).alias("x"), "prefix").select("x.*", "prefix")
    found = predecessor(index, ends, "end", "prefix")
    # a range that begins before all blocks begins with the first; one that ends before all has none
    steps = (
        found.groupBy("prefix")
        .agg(F.max(F.when(F.col("end") == 0, F.coalesce("block", F.lit(0)))).alias("first"), F.max(F.when(F.col("end") == 1, F.col("block"))).alias("last"))
        .where("last is not null")
        .select(F.explode(F.array(F.struct(F.col("first").alias("block"), F.lit(1).alias("step")), F.struct((F.col("last") + 1).alias("block"), F.lit(-1).alias("step")))).alias("x"))
        .select("x.*")
        .groupBy("block")
        .agg(F.sum("step").alias("step"))
    )
    spread = stage(index.join(steps, "block", "left").repartitionByRange("block").withColumn("_p", F.spark_partition_id()), "steps")
    before = spread.groupBy("_p").agg(F.sum("step").alias("_s"))
    offsets = before.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # a row per partition
    w = Window.partitionBy("_p").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    open_ = F.coalesce(F.sum("step").over(w), F.lit(0)) + F.col("_o")
    return spread.join(F.broadcast(offsets), "_p").withColumn("_open", open_).where("_open > 0").select("block", "first_key", "next_key")


def predecessor(index: DataFrame, probes: DataFrame, *keep: str) -> DataFrame:
    """For each probe the last block whose first key is not above it (backward as-of), with the columns ``keep`` of the probe.

    Blocks and probes are merged into one sort order over even range partitions;
    the last block is carried forward inside a partition, and from the
    partitions before by one row each.
    """
    both = index.select(F.col("first_key").alias("k"), F.lit(0).alias("side"), "block").unionByName(
        probes.select(F.col("probe").alias("k"), F.lit(1).alias("side"), "probe", *keep), allowMissingColumns=True
    )
    spread = stage(both.repartitionByRange(F.col("k"), F.col("side")).withColumn("_p", F.spark_partition_id()), "merged")
    w = Window.partitionBy("_p").orderBy("k", "side").rowsBetween(Window.unboundedPreceding, 0)
    carried = spread.withColumn("found", F.last("block", ignorenulls=True).over(w)).where("side = 1")
    ends = spread.groupBy("_p").agg(F.max("block").alias("m"))
    earlier = ends.select("_p", F.max("m").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))  # a row per partition
    return carried.join(F.broadcast(earlier), "_p").select("probe", *keep, F.coalesce("found", "earlier").alias("block"))
