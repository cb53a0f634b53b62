"""Alignment of renumbered ids with catalog entries: best constant shift and its ambiguity.

The share of every candidate shift is one value of the correlation of two 0/1
arrays (content entries and ids over the numbers they span), so all shifts of
a book come from one fast Fourier transform instead of all (id, entry) pairs.
A book is one catalog page and its ids, bounded by the size of that page; books
are spread over tasks by key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

MIN_EXACT = 0.995
#: Numbers a transform may span; wider books are matched shift by shift.
MAX_SPAN = 1 << 22

SCHEMA = "book string, n long, status string, shift long, exact_share double, stray long, shifts_matching long"


def shift_hits(content: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(candidate shifts in ascending order, ids each puts on a content entry).

    ``content`` and ``ids`` are sorted and without repeats. Candidates put the
    first id on some content entry.
    """
    shifts = np.sort(ids[0] - content)
    span = int(content[-1] - content[0] + ids[-1] - ids[0]) + 1
    if span > MAX_SPAN:
        return shifts, np.array([np.isin(ids - k, content, assume_unique=True).sum() for k in shifts], np.int64)
    size = 1 << span.bit_length()
    a, b = np.zeros(size), np.zeros(size)
    a[content - content[0]] = 1
    b[ids - ids[0]] = 1
    # entry d: pairs whose id offset minus entry offset is d, negative d from the end
    pairs = np.rint(np.fft.irfft(np.fft.rfft(b) * np.conj(np.fft.rfft(a)), size)).astype(np.int64)
    return shifts, pairs[(shifts - (ids[0] - content[0])) % size]


def _book(items: pa.Table, ids: pa.Table) -> pa.Table:
    def row(*values) -> pa.Table:
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.table([pa.array([v], t) for v, t in zip(values, types)], names=names)

    if not ids.num_rows:
        return row(None, 0, None, None, None, None, None).slice(0, 0)
    book, n = ids.column("book")[0].as_py(), ids.num_rows
    if not items.num_rows:
        return row(book, n, "no index", None, None, None, None)
    numbers = items.column("si").to_numpy()
    flags = np.array(items.column("content").to_pylist(), dtype=object) == True  # noqa: E712
    content = np.unique(numbers[flags])
    new = np.sort(ids.column("new_id").to_numpy())
    if not len(content):
        return row(book, n, "rejected", None, 0.0, n, 0)
    shifts, hits = shift_hits(content, np.unique(new))
    if len(np.unique(new)) != len(new):  # repeated ids count as often as they occur
        hits = np.array([np.isin(new - k, content).sum() for k in shifts], np.int64)
    share = hits / n
    best = int(np.argmax(share))  # the lowest of equal shifts
    good = int((share >= MIN_EXACT).sum())
    status = "aligned" if share[best] >= MIN_EXACT and good == 1 else "ambiguous" if good > 1 else "rejected"
    stray = int((~np.isin(new - shifts[best], numbers)).sum())
    return row(book, n, status, int(shifts[best]), round(float(share[best]), 4), stray, good)


def align(items: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per book with ids: ``n, status, shift, exact_share, stray, shifts_matching``.

    ``items``: ``book, si, content`` (boolean, null counts as false); ``ids``:
    ``book, new_id``. Every shift that puts the first id on a content entry is a
    candidate; its share is the part of the ids it puts on content entries.
    Books without entries are ``no index``, without content entries
    ``rejected``. Equal shares take the lowest shift; ``stray`` counts ids that
    fall outside the catalog or into its gaps.
    """
    ship(ids.sparkSession)
    left = items.select(F.col("book").cast("string").alias("book"), F.col("si").cast("long").alias("si"), F.col("content").cast("boolean").alias("content")).where("si is not null")
    right = ids.select(F.col("book").cast("string").alias("book"), F.col("new_id").cast("long").alias("new_id")).where("new_id is not null")
    return left.groupBy("book").cogroup(right.groupBy("book")).applyInArrow(_book, SCHEMA)
