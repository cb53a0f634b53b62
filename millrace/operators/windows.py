"""Order-dependent operators over the fetch log and work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def segmented(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The frame in total order of key and row, cut into even range partitions and staged with their number ``_p``.

    A key that holds a third of all rows spreads over a third of the
    partitions; what a partition needs to know of those before it is one row
    per (partition, key). Partition numbers are stored, so every later pass and
    every retry sees the same cut. Rows that tie in ``order`` may stand in
    either partition; give a total order.
    """
    spread = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)]).withColumn("_p", F.spark_partition_id())
    return stage(spread, "segments")


def _attach(rows: DataFrame, summary: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Rows with the columns of a summary by key; null keys are equal."""
    renamed = summary.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in summary.columns if c not in keys])
    return rows.join(renamed, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], how).drop(*[f"_k_{k}" for k in keys])


def _local(keys: tuple[str, ...], order: tuple[str, ...]):
    return Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _before(summary: DataFrame, keys: tuple[str, ...], column: str) -> DataFrame:
    """Sum of a summary's column over the earlier partitions of the same key."""
    w = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return summary.select("_p", *keys, F.coalesce(F.sum(column).over(w), F.lit(0)).alias("_before"))


def runs(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], flag: Column) -> DataFrame:
    """Length so far of the run of true flags that each row ends (0 on false).

    Runs are counted inside range partitions; the run a partition starts in
    the middle of is carried over from the partitions before.
    """
    seg = segmented(df.withColumn("_f", flag.cast("int")), keys, order)
    w = _local(keys, order)
    local = seg.withColumn("_n", F.count("*").over(w)).withColumn("_island", F.sum(1 - F.col("_f")).over(w))
    in_island = Window.partitionBy("_p", *keys, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumn("_run", F.sum("_f").over(in_island))
    # of each partition and key: its rows, whether all are true, and the run it ends with
    summary = local.groupBy("_p", *keys).agg(
        F.max("_n").alias("_rows"), (F.min("_f") == 1).alias("_all"), F.max_by("_run", "_n").alias("_tail")
    )
    by_key = Window.partitionBy(*keys).orderBy("_p")
    chained = summary.withColumn("_g", F.sum((~F.col("_all")).cast("int")).over(by_key)).withColumn(
        "_after", F.sum(F.when(F.col("_all"), F.col("_rows")).otherwise(F.col("_tail"))).over(Window.partitionBy(*keys, "_g").orderBy("_p"))
    )
    carried = chained.select("_p", *keys, F.coalesce(F.lag("_after").over(by_key), F.lit(0)).alias("_carry"))
    whole = (F.col("_f") == 1) & (F.col("_run") == F.col("_n"))  # true since the partition began
    out = _attach(local, carried, ("_p", *keys)).withColumn("run", F.col("_run") + F.when(whole, F.col("_carry")).otherwise(0))
    return out.drop("_p", "_f", "_n", "_island", "_run", "_carry")


def cut_after(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], flag: Column, limit: int) -> DataFrame:
    """Rows of each key up to and with the one at which a run of ``limit`` true flags is full; the rest is not tried."""
    counted = runs(df.withColumn("_flag", flag), keys, order, F.col("_flag")).withColumn("_full", F.col("run") >= limit)
    first = counted.where("_full").groupBy(*keys).agg(F.min(F.struct(*order)).alias("_stop"))
    out = _attach(counted, first, keys, "left")
    return out.where(F.col("_stop").isNull() | (F.struct(*order) <= F.col("_stop"))).drop("_flag", "_full", "_stop")


def batches(df: DataFrame, order: tuple[str, ...], size: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Fixed-size batches in order within each key: row numbers of a partition plus the rows before it."""
    given = keys
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ("_all",)
    seg = segmented(df, keys, order)
    before = _before(seg.groupBy("_p", *keys).agg(F.count("*").alias("_c")), keys, "_c")
    numbered = seg.withColumn("_n", F.row_number().over(Window.partitionBy("_p", *keys).orderBy(*order)))
    numbered = _attach(numbered, before, ("_p", *keys))
    out = numbered.withColumn("batch", F.floor((F.col("_n") + F.col("_before") - 1) / size).cast("long")).drop("_p", "_n", "_before")
    return out if given else out.drop("_all")


def deltas(df: DataFrame, keys: tuple[str, ...], at: str, total: str) -> DataFrame:
    """Growth of a running total per second since the report before.

    Times are unique within a key. The row before a partition's first is the
    last one of the partitions before: one row per (partition, key).
    """
    seg = segmented(df, keys, (at,))
    w = Window.partitionBy("_p", *keys).orderBy(at)
    last = seg.groupBy("_p", *keys).agg(F.max_by(F.struct(at, total), at).alias("_last"))
    before = last.select("_p", *keys, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_p")).alias("_before"))
    out = _attach(seg.withColumn("_lag", F.lag(F.struct(at, total)).over(w)), before, ("_p", *keys), "left")
    previous = F.coalesce("_lag", "_before")
    seconds, grown = F.col(at) - previous[at], F.col(total) - previous[total]
    return out.withColumn("rate", F.when(seconds > 0, F.round(grown / seconds, 6))).drop("_p", "_lag", "_before")


def paced(df: DataFrame, keys: tuple[str, ...], at: str, order: tuple[str, ...], interval: float) -> DataFrame:
    """When each request of a key may start (``slot``) if starts are ``interval`` seconds apart at least.

    A request starts at its own time or one interval after the one before, so
    with n earlier requests the start less n intervals is the running maximum of
    the times less n intervals: a maximum within partitions and one over them.
    """
    seg = segmented(df, keys, (at, *order))
    w = Window.partitionBy("_p", *keys).orderBy(at, *order)
    before = _before(seg.groupBy("_p", *keys).agg(F.count("*").alias("_c")), keys, "_c")
    n = (F.row_number().over(w) - 1).alias("_n")
    free = _attach(seg.select("*", n), before, ("_p", *keys)).withColumn("_n", F.col("_n") + F.col("_before")).withColumn("_free", F.col(at) - F.col("_n") * interval)
    tops = free.groupBy("_p", *keys).agg(F.max("_free").alias("_top"))
    earlier = tops.select("_p", *keys, F.max("_top").over(Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    out = _attach(free.withColumn("_max", F.max("_free").over(w.rowsBetween(Window.unboundedPreceding, 0))), earlier, ("_p", *keys))
    return out.withColumn("slot", F.greatest("_max", "_earlier") + F.col("_n") * interval).drop("_p", "_n", "_before", "_free", "_max", "_earlier")


def totals_so_far(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], amount: str, name: str = "total") -> DataFrame:
    """Running sum of an amount in order within each key."""
    seg = segmented(df, keys, order)
    before = _before(seg.groupBy("_p", *keys).agg(F.sum(amount).alias("_s")), keys, "_s")
    out = _attach(seg.withColumn("_r", F.sum(amount).over(_local(keys, order))), before, ("_p", *keys))
    return out.withColumn(name, (F.col("_r") + F.col("_before")).cast("long")).drop("_p", "_r", "_before")


def shuffled(df: DataFrame, draw: Column, last: Column, limit: int = 0, id_: str = "id") -> DataFrame:
    """A work list in seeded pseudo-random order, rows of ``last`` behind all others, with their ``place`` from 0.

    With ``limit`` the first so many rows only (a limit of the whole list, not per key).
    """
    rows = df.withColumn("_last", last.cast("int")).withColumn("_draw", draw)
    out = batches(rows, ("_last", "_draw", id_), 1).withColumnRenamed("batch", "place").drop("_last", "_draw")
    return out.where(F.col("place") < limit) if limit else out


def running_share(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], amount: str) -> DataFrame:
    """Share of the key's total that stands before each row."""
    seg = segmented(df, keys, order)
    sums = seg.groupBy("_p", *keys).agg(F.sum(amount).alias("_s"))
    before = _before(sums, keys, "_s")
    total = sums.groupBy(*keys).agg(F.sum("_s").alias("_total"))
    out = _attach(_attach(seg.withColumn("_r", F.sum(amount).over(_local(keys, order))), before, ("_p", *keys)), total, keys)
    done = F.col("_before") + F.col("_r") - F.col(amount)
    return (
        out.withColumn("done_before", done.cast("long"))
        .withColumn("share_before", F.when(F.col("_total") > 0, F.round(done / F.col("_total"), 6)))
        .drop("_p", "_r", "_before", "_total")
    )


def per_key(df: DataFrame, keys: tuple[str, ...], order: tuple[Column | str, ...], n: int) -> DataFrame:
    """At most n rows per key in a given order (a stratified sample with a hashed order)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def rank_in(column: Column, values: tuple[str, ...]) -> Column:
    """Place in a custom order from 0; values not listed come last."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), column)
    return F.when(at == 0, F.lit(len(values))).otherwise(at - 1).cast("int")
