"""Per-key sums without stragglers, for keys of which a few hold most rows.

Method: dense accumulator arrays. Every input split (equal in bytes, whatever
its keys are) encodes its keys by a local dictionary and adds its rows into
dense arrays with ``numpy.bincount``; a key therefore leaves a split as one
array cell, however many rows it had. The arrays leave in blocks of keys, and
the blocks are summed in a distributed reduction: each level adds up at most
:data:`FAN_IN` partial blocks of one key range, until one is left.

Blocks are hash ranges of keys, and there are as many as the keys of the largest
split need, doubled for keys that only other splits have; so a block stays of
one size however many keys there are, and its sums are spread over all tasks.

Defined results: a null key is a key of its own; null measures add 0; sums are
64-bit and wrap around like Spark's own in non-ANSI mode; the empty input gives
no rows; the input may have further columns under any name but the ones asked
for, they are never read; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..session import ship, splits, stage

#: Partial blocks that one reduction adds up.
FAN_IN = 64
#: Keys in one block, about, so that a block's arrays stay a few MB.
BLOCK_KEYS = 1 << 16
#: Fine blocks that a split cuts its keys into; they are merged once the number of keys is known.
FINE = 1 << 12


def _fine_block(keys: list[str | None]) -> np.ndarray:
    """Hash range of each key: the same in every split, whatever else it holds."""
    import xxhash

    return np.fromiter((0 if k is None else xxhash.xxh32_intdigest(k.encode("utf-8", "surrogatepass")) % FINE for k in keys), np.int64, len(keys))


def _added(size: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Exact sums of integers by index: ``bincount`` of their halves, whose sums a double holds exactly."""
    low, high = values & 0xFFFFFFFF, values >> 32
    if len(values) < 1 << 20:
        parts = [(at, low, high)]
    else:
        parts = [(at[i : i + (1 << 20)], low[i : i + (1 << 20)], high[i : i + (1 << 20)]) for i in range(0, len(values), 1 << 20)]
    out = np.zeros(size, np.int64)
    for a, lo, hi in parts:
        out += np.bincount(a, lo, size).astype(np.int64) + (np.bincount(a, hi, size).astype(np.int64) << 32)
    return out


_PARTIAL = StructType([
    StructField("_block", IntegerType()),
    StructField("_part", IntegerType()),
    StructField("_n", LongType()),
    StructField("_keys", ArrayType(StringType())),
    StructField("_sums", ArrayType(LongType())),
])
_ARROW = pa.schema([("_block", pa.int32()), ("_part", pa.int32()), ("_n", pa.int64()), ("_keys", pa.list_(pa.string())), ("_sums", pa.list_(pa.int64()))])


def _rows(blocks: list[int], part: int, keys: pa.Array, sums: np.ndarray, cuts: list[np.ndarray]) -> pa.RecordBatch:
    """Blocks of one split as list columns over shared buffers; ``sums`` has a row per key."""
    order = np.concatenate(cuts) if cuts else np.zeros(0, np.int64)
    sizes = np.array([len(c) for c in cuts], np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(blocks, pa.int32()),
            pa.array(np.full(len(cuts), part), pa.int32()),
            pa.array(sizes, pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys.take(pa.array(order))),
            pa.ListArray.from_arrays(pa.array(ends * sums.shape[1], pa.int32()), pa.array(sums[order].ravel())),
        ],
        schema=_ARROW,
    )


def keyed_sums(df: DataFrame, key: str, measures: dict[str, F.Column]) -> DataFrame:
    """``key``, ``n_rows`` and the sum of each integer measure per key."""
    ship(df.sparkSession)
    names = list(measures)
    wide = len(names) + 1
    n_splits = splits(df)
    narrow = df.select(
        F.col(key).cast("string").alias("_key"),
        *[F.coalesce(m.cast("long"), F.lit(0)).alias(f"_m{i}") for i, m in enumerate(measures.values())],
        F.spark_partition_id().alias("_part"),
    )

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, int] = {}
        sums = np.zeros((1024, wide), np.int64)
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(wide)[0].as_py()
            codes = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            local = codes.dictionary.to_pylist()
            index = np.array([seen.setdefault(k, len(seen)) for k in local], np.int64)
            if len(seen) > len(sums):
                sums = np.concatenate([sums, np.zeros((max(len(seen), len(sums)), wide), np.int64)])
            at = codes.indices.to_numpy(zero_copy_only=False)
            size = len(local)
            sums[index, 0] += np.bincount(at, minlength=size)
            for i in range(1, wide):
                sums[index, i] += _added(size, at, batch.column(i).to_numpy(zero_copy_only=False))
        if seen:
            keys = list(seen)
            fine = _fine_block(keys)
            order = np.argsort(fine, kind="stable")
            cuts = np.split(order, np.flatnonzero(np.diff(fine[order])) + 1)
            yield _rows([int(fine[c[0]]) for c in cuts], part, pa.array(keys, pa.string()), sums, cuts)

    def merged(t: pa.Table) -> tuple[pa.Array, np.ndarray]:
        seen: dict[str | None, int] = {}
        flat = t.column("_keys").combine_chunks().flatten().to_pylist()
        at = np.array([seen.setdefault(k, len(seen)) for k in flat], np.int64)
        values = t.column("_sums").combine_chunks().flatten().to_numpy().reshape(-1, wide)
        order = np.argsort(at, kind="stable")  # sort and reduce: exact in 64 bits
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        return pa.array(list(seen), pa.string()), np.add.reduceat(values[order], first, axis=0)

    def partly(t: pa.Table) -> pa.Table:
        keys, sums = merged(t)
        block = t.column("_block")[0].as_py()
        part = t.column("_part")[0].as_py()
        return pa.Table.from_batches([_rows([block], part, keys, sums, [np.arange(len(keys))])])

    def finally_(t: pa.Table) -> pa.Table:
        keys, sums = merged(t)
        return pa.table([keys, *[pa.array(np.ascontiguousarray(sums[:, i])) for i in range(wide)]], names=[key, "n_rows", *names])

    partial = stage(narrow.mapInArrow(accumulate, _PARTIAL), "partial_sums")
    # as many blocks as the split with most keys needs: one number
    most = partial.groupBy("_part").agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = 1
    while blocks < FINE and blocks * BLOCK_KEYS < 2 * most:
        blocks *= 2
    partial = partial.withColumn("_block", (F.col("_block") % blocks).cast("int"))
    while n_splits > FAN_IN:
        n_splits = -(-n_splits // FAN_IN)
        partial = partial.withColumn("_part", (F.col("_part") % n_splits).cast("int")).groupBy("_block", "_part").applyInArrow(partly, _PARTIAL)
    out = StructType([StructField(key, StringType()), StructField("n_rows", LongType()), *[StructField(n, LongType()) for n in names]])
    return partial.groupBy("_block").applyInArrow(finally_, out)
