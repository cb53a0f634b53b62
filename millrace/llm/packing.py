"""Filling containers of fixed capacity with items, hardly any space unused.

Method: non-negative least squares on the histogram of item sizes. Shallow
combinations of at most four sizes that fill a window exactly are enumerated,
for every size in the histogram and with partners drawn in proportion to what is
left of each size; the repeat counts that reproduce the histogram best are
solved for and rounded, what they place is taken off, and the next round does
the same with the rest, until a round places hardly anything. If much is left then,
further rounds also take combinations that leave up to :data:`WINDOW` unused.
The residue is packed greedily, again by size only.

A combination of four items cannot fill a container that holds dozens, so
combinations fill the capacity, or its half, quarter and so on, down to about
twice the mean size; what halves and quarters there are fill containers among
themselves without loss.

The resulting recipe is as large as the number of distinct sizes allows, never
as the number of items, so it is solved on the driver and sent to the tasks,
which hand out container numbers: the k-th item of a size belongs to the
combination whose range of that size holds k.

Items larger than the capacity, and only they, are cut into full containers and
a rest that is packed like an item. Items of size 0 use no space; they are
put into container 0 so that every item is placed.

The k-th item of a size is counted within its input split, where it is read,
plus an offset per (split, size): items are not shuffled, and a size that a
third of all items share makes no large task.

Defined results: null sizes count as 0; an empty input gives no rows; items of
equal size keep the order of the input within a split; the same input in other
splits may give equal items other containers, with the same fill.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship, stage

#: Unused space a combination may leave, as a share of the capacity.
WINDOW = 0.01
#: Partners drawn for each size and window in a round, and combinations of a round from which it is fewer.
DRAWS, ROUND = 12, 400_000
#: Share of the items left up to which the residue is packed greedily once hardly anything fills exactly any more.
RESIDUE = 0.15
#: A round that places less than this share of what is left is the last of its kind.
LEAST_PROGRESS = 0.03
#: The solver stops when the error falls by less than this share in ten steps.
CONVERGED = 1e-3


def solve_nnls(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    """argmin |A x - target| over x >= 0 for a sparse A, by multiplicative updates to convergence.

    Errors are relative to the target, so that rare sizes are met as well.
    """
    if n == 0:
        return np.zeros(0)
    x = np.full(n, float(target.sum()) / max(1.0, float(vals.sum())))
    weight = 1.0 / np.maximum(target, 1.0)
    num = np.bincount(cols, vals * (weight * target)[rows], n)
    last = np.inf
    step = 0
    while True:
        fit = np.bincount(rows, vals * x[cols], len(target))
        if step % 10 == 0:
            error = float((weight * (fit - target) ** 2).sum())
            if error >= last * (1 - CONVERGED) or error < 1e-9:
                return x
            last = error
        den = np.bincount(cols, vals * (weight * fit)[rows], n)
        x *= num / np.maximum(den, 1e-12)
        step += 1


def windows_of(capacity: int, mean: float) -> list[int]:
    """The capacity and its halves down to twice the mean size."""
    out = [capacity]
    while out[-1] // 2 >= max(2 * mean, 8):
        out.append(capacity >> len(out))
    return out


def combinations(sizes: np.ndarray, counts: np.ndarray, fills: list[int], slack: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(fill window, up to four sizes, 0 for none) of shallow combinations, each window filled up to ``slack``.

    Every size is offered in the smallest window that holds it and the next
    larger one: repeated, and with one, two or three others.
    """
    top = int(fills[0])
    # largest size in the histogram that is not above a rest, 0 without one
    below = np.zeros(top + 1, np.int64)
    below[sizes[sizes <= top]] = sizes[sizes <= top]
    below = np.maximum.accumulate(below)
    share = counts / counts.sum()
    draws = max(2, min(DRAWS, ROUND // len(sizes)))
    found: list[np.ndarray] = []
    level: list[np.ndarray] = []
    ascending = np.array(fills[::-1])
    first = np.searchsorted(ascending, sizes)
    for up in (0, 1):
        at = np.minimum(first + up, len(ascending) - 1)
        if up and len(ascending) == 1:
            break
        fill = np.repeat(ascending[at], draws)
        s = np.repeat(sizes, draws)
        t = rng.choice(sizes, len(s), p=share)
        v = rng.choice(sizes, len(s), p=share)
        again = rng.random(len(s)) < 0.25
        t = np.where(again, s, t)  # a size beside itself
        for parts in ((s,), (s, t), (s, t, v)):
            rest = fill - sum(parts)
            ok = rest >= 0
            u = np.where(ok, below[np.maximum(rest, 0)], 0)
            ok &= rest - u <= slack
            full = [np.where(ok, x, 0) for x in parts] + [u * ok] + [np.zeros(len(s), np.int64)] * (3 - len(parts))
            keep = np.flatnonzero(ok)
            found.append(np.stack(full, 1)[keep])
            level.append(fill[keep])
        # one size as often as it fits, filled up by another
        own = ascending[at]
        m = own // sizes
        rest = own - m * sizes
        u = below[np.minimum(rest, top)]
        ok = (rest - u <= slack) & (m <= 3)
        full = np.stack([sizes, np.where(m > 1, sizes, 0), np.where(m > 2, sizes, 0), u], 1)
        found.append(full[ok])
        level.append(own[ok])
    parts = -np.sort(-np.concatenate(found), axis=1)
    both = np.unique(np.column_stack([np.concatenate(level), parts]), axis=0)
    return both[:, 0], both[:, 1:]


@dataclass
class Recipe:
    """``parts``: (window, ((size, multiplicity), ...), repeats), windows in falling order; ``by_greedy`` items were left to the greedy step."""

    capacity: int
    parts: list[tuple[int, tuple[tuple[int, int], ...], int]] = field(default_factory=list)
    by_greedy: int = 0
    items: int = 0

    def containers(self) -> int:
        return Assignment(self, 1).end - 1


def recipe(histogram: dict[int, int], capacity: int, greedy_only: bool = False) -> Recipe:
    """Repeats of combinations that use every item of the histogram exactly once."""
    left = {s: c for s, c in histogram.items() if 0 < s <= capacity and c > 0}
    plan = Recipe(capacity, items=sum(left.values()))
    if not left:
        return plan
    rng = np.random.default_rng(capacity)
    placed: dict[tuple[int, tuple[tuple[int, int], ...]], int] = {}
    slack = 0
    while left and not greedy_only:
        items = sum(left.values())
        fills = windows_of(capacity, sum(s * c for s, c in left.items()) / items)
        done = _round(left, fills, slack, rng, placed)
        if done < LEAST_PROGRESS * items:
            if slack or sum(left.values()) <= RESIDUE * plan.items:
                break
            slack = max(1, int(capacity * WINDOW))  # hardly anything fills exactly any more
        left = {s: c for s, c in left.items() if c}
    plan.parts = sorted(((f, p, r) for (f, p), r in placed.items()), key=lambda x: (-x[0], x[1]))
    # windows that do not make up a whole container go back to the residue
    deepest = max((_halvings(capacity, f) for f, _, _ in plan.parts), default=0)
    over = sum(r << deepest - _halvings(capacity, f) for f, _, r in plan.parts) % (1 << deepest)
    while over:
        f, p, r = plan.parts.pop()
        wide = 1 << deepest - _halvings(capacity, f)
        take = min(r, -(-over // wide))
        if take < r:
            plan.parts.append((f, p, r - take))
        for s, m in p:
            left[s] = left.get(s, 0) + m * take
        over -= take * wide
    plan.by_greedy = sum(left.values())
    plan.parts += [(capacity, p, r) for p, r in _greedy({s: c for s, c in left.items() if c}, capacity)]
    plan.parts.sort(key=lambda x: -x[0])
    return plan


def _halvings(capacity: int, fill: int) -> int:
    """How often the capacity was halved to give a window."""
    return (capacity // fill).bit_length() - 1


def _round(left: dict[int, int], fills: list[int], slack: int, rng: np.random.Generator, placed: dict) -> int:
    """Solve for the rest, round, and take off what is placed; returns the number of items placed."""
    sizes = np.array(sorted(s for s, c in left.items() if c))
    counts = np.array([left[int(s)] for s in sizes], float)
    level, parts = combinations(sizes, counts, fills, slack, rng)
    if not len(parts):
        return 0
    which, slot = np.nonzero(parts)
    rows = np.searchsorted(sizes, parts[which, slot])
    x = solve_nnls(rows, which, np.ones(len(rows)), counts, len(parts))
    # rounding running totals keeps the sum of repeats of neighbouring combinations
    order = np.lexsort((*parts.T[::-1], -level))
    ends = np.floor(np.cumsum(x[order]) + 0.5)
    repeats = np.diff(ends, prepend=0.0).astype(np.int64)
    done = 0
    chosen = np.flatnonzero(repeats)
    # combinations with large sizes first: what small ones lose to them is easy to place later
    for j in chosen[np.argsort(-parts[order[chosen], 0], kind="stable")].tolist():
        at = order[j]
        p: dict[int, int] = {}
        for s in parts[at].tolist():
            if s:
                p[s] = p.get(s, 0) + 1
        r = min(int(repeats[j]), *(left[s] // m for s, m in p.items()))
        if r > 0:
            key = (int(level[at]), tuple(p.items()))
            placed[key] = placed.get(key, 0) + r
            for s, m in p.items():
                left[s] -= m * r
                done += m * r
    return done


def _greedy(left: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Largest size first, each rest filled with the largest size that fits; equal containers at once."""
    out = []
    order = np.array(sorted(left))
    while len(order):
        free = capacity
        pattern: list[tuple[int, int]] = []
        i = len(order) - 1
        while i >= 0 and free >= order[0]:
            i = min(i, int(np.searchsorted(order, free, "right")) - 1)
            if i < 0:
                break
            s = int(order[i])
            m = min(left[s], free // s)
            pattern.append((s, m))
            free -= s * m
            i -= 1
        times = min(left[s] // m for s, m in pattern)
        out.append((tuple(pattern), times))
        emptied = False
        for s, m in pattern:
            left[s] -= m * times
            emptied |= not left[s]
        if emptied:
            order = np.array(sorted(s for s, c in left.items() if c), dtype=np.int64)
    return out


class Assignment:
    """Ranges of item ordinals by size: which container the k-th item of a size goes to.

    Filled windows stand one after the other, larger ones first, so none lies across the end of a container.
    """

    def __init__(self, plan: Recipe, first: int) -> None:
        per: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        self.first = first
        deepest = max((_halvings(plan.capacity, f) for f, _, _ in plan.parts), default=0)
        self.units = 1 << deepest
        at = 0
        for fill, pattern, repeats in plan.parts:
            wide = self.units >> _halvings(plan.capacity, fill)
            for s, m in pattern:
                per.setdefault(s, []).append((used.get(s, 0), at, m, wide))
                used[s] = used.get(s, 0) + m * repeats
            at += repeats * wide
        self.end = first + -(-at // self.units)
        self.table = {s: tuple(np.array(c, np.int64) for c in zip(*v)) for s, v in per.items()}

    def containers(self, size: np.ndarray, ordinal: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size), np.int64)
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        for part in np.split(order, cuts):
            if not len(part) or int(size[part[0]]) not in self.table:
                continue
            start, base, m, wide = self.table[int(size[part[0]])]
            k = ordinal[part]
            i = np.searchsorted(start, k, "right") - 1
            out[part] = self.first + (base[i] + (k - start[i]) // m[i] * wide[i]) // self.units
        return out


def pieces(items: DataFrame, windows: list[tuple[str, int]], key: str, size: str) -> DataFrame:
    """``w, item, piece, size``: every item for every window; items above a capacity cut into full pieces and a rest."""
    caps = F.array(*[F.struct(F.lit(i).alias("w"), F.lit(cap).cast("long").alias("cap")) for i, (_, cap) in enumerate(windows)])
    rows = items.select(F.col(key).alias("item"), F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("_size"), F.explode(caps).alias("_w"))
    n = F.greatest(F.ceil(F.col("_size") / F.col("_w.cap")), F.lit(1)).cast("long")
    return rows.select("_w", "item", "_size", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("_k")).select(
        F.col("_w.w").alias("w"), "item", F.col("_k").cast("int").alias("piece"), F.least(F.col("_w.cap"), F.col("_size") - F.col("_k") * F.col("_w.cap")).alias("size")
    )


def _numbered(parts: DataFrame, kind: str) -> DataFrame:
    """Pieces with their input split and ``k``, the number of earlier pieces of the same window and size in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            if not b.num_rows:
                continue
            both = b.column(3).to_numpy(zero_copy_only=False) << 16 | b.column(0).to_numpy(zero_copy_only=False)
            keys, code, n = np.unique(both, return_inverse=True, return_counts=True)
            order = np.argsort(code, kind="stable")
            k = np.empty(len(code), np.int64)
            k[order] = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
            k += np.array([seen.get(x, 0) for x in keys.tolist()], np.int64)[code]
            for x, more in zip(keys.tolist(), n.tolist()):
                seen[x] = seen.get(x, 0) + more
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k)], names=["w", "item", "piece", "size", "split", "k"])

    return parts.withColumn("split", F.spark_partition_id()).mapInArrow(run, f"w int, item {kind}, piece int, size long, split int, k long")


def pack_windows(items: DataFrame, windows: list[tuple[str, int]], key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """``window_name, item, piece, size, container`` of every item for every (name, capacity).

    Containers are numbered from 1
    in each window; container 0 holds the items of size 0.
    """
    return pack_by_recipes(items, windows, key, size)[0]


def pack_by_recipes(items: DataFrame, windows: list[tuple[str, int]], key: str = "doc_id", size: str = "n_tokens") -> tuple[DataFrame, list[Recipe]]:
    """The packed items of :func:`pack_windows` and the recipe of each window."""
    spark = items.sparkSession
    ship(spark)
    kind = items.schema[key].dataType.simpleString()
    parts = stage(_numbered(pieces(items, windows, key, size), kind), "pieces")
    # at most splits * capacity rows a window, whatever the number of items
    per_split = stage(parts.groupBy("w", "split", "size").agg(F.count("*").alias("n")), "sizes")
    histograms: list[dict[int, int]] = [{} for _ in windows]
    for r in per_split.groupBy("w", "size").agg(F.sum("n").alias("n")).collect():  # at most capacity + 1 rows a window
        histograms[r["w"]][r["size"]] = r["n"]
    recipes = [recipe(h, cap) for h, (_, cap) in zip(histograms, windows)]
    placed = [Assignment(r, 1) for r in recipes]
    offset = F.sum("n").over(Window.partitionBy("w", "size").orderBy("split")) - F.col("n")
    offsets = stage(per_split.select("w", "split", "size", offset.alias("offset")), "offsets")
    numbered = parts.join(offsets, ["w", "split", "size"]).select("w", "item", "piece", "size", (F.col("k") + F.col("offset")).cast("long").alias("k"))
    handed = spark.sparkContext.broadcast(placed)  # bounded by the capacities, not by the items
    names = [name for name, _ in windows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column(0).to_numpy(zero_copy_only=False)
            s = b.column(3).to_numpy(zero_copy_only=False)
            k = b.column(4).to_numpy(zero_copy_only=False)
            c = np.zeros(len(w), np.int64)
            for i in np.unique(w):
                at = w == i
                c[at] = handed.value[i].containers(s[at], k[at])
            label = pa.array(names, pa.string()).take(pa.array(w, pa.int32()))
            yield pa.RecordBatch.from_arrays([label, b.column(1), b.column(2), b.column(3), pa.array(c)], names=["window_name", "item", "piece", "size", "container"])

    return numbered.mapInArrow(run, f"window_name string, item {kind}, piece int, size long, container long"), recipes


def pack(items: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """``item, piece, size, container`` of every item for one capacity."""
    return pack_windows(items, [("", capacity)], key, size).drop("window_name")


def fill_windows(packed: DataFrame, windows: list[tuple[str, int]], recipes: list[Recipe]) -> DataFrame:
    """Per window: containers used, tokens in them, the least number possible, the share of space used,
    and the share of items (or pieces) that least squares placed.

    Containers are reduced to one row each before they are counted.
    """
    cap = F.create_map(*[F.lit(x) for w in windows for x in w])[F.col("window_name")]
    solved = F.create_map(*[F.lit(x) for (name, _), r in zip(windows, recipes) for x in (name, round(1 - r.by_greedy / max(1, r.items), 6))])[F.col("window_name")]
    per = packed.where("size > 0").groupBy("window_name", "container").agg(F.sum("size").alias("s"))
    return (
        per.groupBy("window_name")
        .agg(F.count("*").alias("containers"), F.sum("s").alias("tokens"))
        .select(
            "window_name",
            cap.alias("capacity"),
            "containers",
            "tokens",
            F.ceil(F.col("tokens") / cap).alias("least"),
            F.round(F.col("tokens") / (F.col("containers") * cap), 6).alias("used"),
            solved.alias("by_least_squares"),
        )
    )


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers used, tokens in them, the least number possible, and the share of space used."""
    return packed.where("size > 0").agg(
        F.count_distinct("container").alias("containers"),
        F.sum("size").alias("tokens"),
        F.ceil(F.sum("size") / capacity).alias("least"),
        F.round(F.sum("size") / (F.count_distinct("container") * capacity), 6).alias("used"),
    )
