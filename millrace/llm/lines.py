"""Lines repeated across the documents of one source.

Method: distributed PrefixSpan over the sequences of line identifiers of each
source. A sequence is a run of lines that directly follow each other (gap 0:
with gaps, a block of k repeated lines alone would have 2^k sequences); its
support is the number of distinct documents that hold it. Documents are spread
over chunks of one source, and each chunk mines its own sequences: frequent
lines first, then every frequent prefix is grown by the lines that follow its
end positions (the projected database, as arrays of positions) until none is
frequent. A sequence that is frequent in a source is frequent in at least one
of its chunks, so the chunks' sequences are all candidates there are. Their
counts add up exactly where every chunk listed them; where one did not and the
sequence can still be frequent, its documents are counted by a second pass.
Occurrences of frequent sequences, single lines included, are deleted from each
document.

A line that always follows one and the same frequent line starts no sequence of
its own: each such sequence is the tail of a listed one with the same support.
So a block of k lines costs k steps, not k^2. Where chunks of a source differ
in that, the source is mined again with these lines as starts.

A line's identifier is a 64-bit hash of its normal form (lower case, runs of
ASCII digits as one 0); a line repeated right after itself counts once. No task
holds more than one chunk, so a source with a third of all documents is as even
as the rest.

Defined results: documents without lines count in a source's total if they
have a body; rows of one document count once; a source with fewer than
``MIN_DOCS`` documents has no frequent line; ties need no order.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import site
from ..session import ship, spread, stage
from .html import render
from .pages import host_of, once, stored, text_of

MIN_DOCS = 5
MIN_SHARE = 0.25
#: Documents of one source in one chunk, about.
CHUNK_DOCS = 4096
#: Chunks list sequences from this share of their own least support on, so that counts of most
#: frequent sequences are complete after one pass.
SLACK = 0.8
#: A frequent line reaches this share of its source's rows in at least one split
#: unless a document is stored in over MIN_SHARE / HINT_SHARE splits on average.
HINT_SHARE = 0.05
#: Most frequent lines (8 bytes each) that are sent to every task; more go by a join.
SENT_LINES = 4_000_000

_DIGITS = re.compile(r"[0-9]+")


def normal(line: str) -> str:
    return _DIGITS.sub("0", line.lower())


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def line_id(norm: str) -> int:
    return signed(xxhash.xxh64_intdigest(norm))


def page_lines(html: str) -> list[str]:
    return [normal(s) for s in render(html).lines]


_SEQ = "host string, id long, seq array<long>, texts map<long,string>"


def sequences(pages: DataFrame) -> DataFrame:
    """``host, id, seq`` of stored rows, repeats within a batch left out, and, for lines
    common within the split, their text once per batch and host (``texts`` of one of its rows)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        gc.disable()
        rows: dict[tuple[str, int], list[int]] = {}
        support: dict[str, Counter] = defaultdict(Counter)
        words: dict[int, str] = {}
        size: Counter = Counter()
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for id_, url, body in zip(ids, urls, batch.column(2)):
                host = host_of(url)
                if (host, id_) in rows:
                    continue
                norms = page_lines(text_of(body.as_py()))
                seq = [line_id(s) for s in norms]
                words.update(zip(seq, norms))
                support[host].update(set(seq))
                size[host] += 1
                rows[host, id_] = seq
            if len(rows) >= 4_000:
                yield _flush(rows, support, words, size)
                rows, support, words, size = {}, defaultdict(Counter), {}, Counter()
        if rows:
            yield _flush(rows, support, words, size)

    return spread(stored(pages, "id", "url"), "id").mapInArrow(run, _SEQ)


def _flush(rows: dict[tuple[str, int], list[int]], support: dict[str, Counter], words: dict[int, str], size: Counter) -> pa.RecordBatch:
    told: set[str] = set()
    texts = []
    for host, _ in rows:
        if host in told:
            texts.append(None)
            continue
        told.add(host)
        least = HINT_SHARE * size[host]
        texts.append([(h, words[h]) for h, n in support[host].items() if n >= least])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([h for h, _ in rows], pa.string()),
            pa.array([i for _, i in rows], pa.int64()),
            pa.array(list(rows.values()), pa.list_(pa.int64())),
            pa.array(texts, pa.map_(pa.int64(), pa.string())),
        ],
        names=["host", "id", "seq", "texts"],
    )


# ------------------------------------------------------------------ mining


def mine(docs: list[np.ndarray], least: int, starts: frozenset[int] = frozenset()) -> list[tuple[list[int], int, int | None]]:
    """PrefixSpan on some documents: (sequence, documents that hold it, the line it always follows or ``None``).

    Lines that always follow one frequent line are listed but not grown, but for those in ``starts``.
    """
    n = len(docs)
    lengths = np.array([len(d) for d in docs], np.int64)
    if not lengths.sum():
        return []
    lines, code = np.unique(np.concatenate(docs), return_inverse=True)
    doc = np.repeat(np.arange(n), lengths)
    support = np.bincount(np.unique(code * n + doc) // n, minlength=len(lines))
    # every document between two marks -1, as are its lines that are not frequent
    at = np.arange(len(code)) + doc + 1
    a = np.full(len(code) + n + 1, -1, np.int64)
    a[at] = np.where(support[code] >= least, code, -1)
    of = np.zeros(len(a), np.int64)
    of[at] = doc
    where = np.flatnonzero(a >= 0)
    where = where[np.argsort(a[where], kind="stable")]
    found: list[tuple[list[int], int, int | None]] = []
    grow: list[tuple[list[int], np.ndarray]] = []
    for ends in np.split(where, np.flatnonzero(np.diff(a[where])) + 1):
        if not len(ends):
            continue
        x = int(lines[a[ends[0]]])
        before = a[ends - 1]
        left = int(lines[before[0]]) if before[0] >= 0 and (before == before[0]).all() else None
        found.append(([x], int(support[a[ends[0]]]), left))
        if left is None or x in starts:
            grow.append(([x], ends))
    while grow:
        prefix, ends = grow.pop()
        following = a[ends + 1]
        ends = ends[following >= 0] + 1
        if len(ends) < least:
            continue
        ends = ends[np.argsort(a[ends], kind="stable")]
        for part in np.split(ends, np.flatnonzero(np.diff(a[ends])) + 1):
            if len(part) < least:
                continue
            held = 1 + int(np.count_nonzero(np.diff(of[part])))
            if held >= least:
                longer = [*prefix, int(lines[a[part[0]]])]
                found.append((longer, held, None))
                grow.append((longer, part))
    return found


def holding(docs: list[np.ndarray], wanted: list[list[int]]) -> list[int]:
    """Documents that hold each of the given sequences."""
    n = len(docs)
    out = []
    flat = np.concatenate([np.zeros(0, np.int64), *docs])
    doc = np.repeat(np.arange(n), [len(d) for d in docs])
    for seq in wanted:
        at = np.flatnonzero(flat == seq[0])
        begin = doc[at]
        for k, x in enumerate(seq[1:], 1):
            ok = at + k < len(flat)
            at, begin = at[ok], begin[ok]
            ok = (flat[at + k] == x) & (doc[at + k] == begin)
            at, begin = at[ok], begin[ok]
        out.append(len(np.unique(begin)))
    return out


def _documents(t: pa.Table) -> list[np.ndarray]:
    """Distinct documents of a chunk, each line once where it follows itself."""
    seen: set[int] = set()
    out = []
    for id_, seq in zip(t.column("id").to_pylist(), t.column("seq")):
        if id_ in seen:
            continue
        seen.add(id_)
        x = seq.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        out.append(x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x)
    return out


_MINED = "host string, chunk int, spare long, seq array<long>, n long, after long"


def _mined(t: pa.Table, starts: frozenset[int] = frozenset()) -> pa.Table:
    """Sequences of one chunk, and one row with an empty sequence for the chunk itself."""
    docs = _documents(t)
    n, chunks = len(docs), t.column("chunks")[0].as_py()
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * n)) if chunks == 1 else max(1, math.ceil(SLACK * MIN_SHARE * n))
    rows = [([], n, None), *mine(docs, least, starts)] if n >= least else [([], n, None)]
    size = len(rows)
    return pa.table(
        [
            pa.array([t.column("host")[0].as_py()] * size, pa.string()),
            pa.array([t.column("chunk")[0].as_py()] * size, pa.int32()),
            pa.array([least - 1] * size, pa.int64()),
            pa.array([r[0] for r in rows], pa.list_(pa.int64())),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()),
        ],
        names=["host", "chunk", "spare", "seq", "n", "after"],
    )


class Miner:
    """Frequent sequences of all sources over staged ``host, id, seq`` rows."""

    def __init__(self, seqs: DataFrame) -> None:
        rows = seqs.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK_DOCS)
        self.large = stage(rows.select("host", F.ceil(F.col("n") / CHUNK_DOCS).cast("int").alias("chunks")), "large_hosts")
        self.docs = (
            seqs.select("host", "id", "seq")
            .join(self.large, "host", "left")
            .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
            .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        )

    def _for_chunks(self, rows: DataFrame) -> DataFrame:
        """Rows of large hosts, once for each of their chunks."""
        return rows.join(self.large, "host").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")

    def frequent(self) -> DataFrame:
        """``host, seq, n_docs, n_host`` of every frequent sequence, staged."""
        mined = stage(self.docs.groupBy("host", "chunk").applyInArrow(lambda t: _mined(t), _MINED), "mined")
        whole = self._whole(mined)
        if self.large.isEmpty():  # every source is one chunk, so its own counts are the whole ones
            return stage(whole.where(F.col("n") >= F.col("least")).select("host", "seq", F.col("n").alias("n_docs"), "n_host"), "frequent")
        known = (F.col("reported") == F.col("chunks")) & (F.col("n_follows") == F.col("reported")) & F.col("one_left")
        again = stage(whole.where((F.size("seq") == 1) & (F.col("n_follows") > 0) & ~known & F.col("possible")).select("host", F.element_at("seq", 1).alias("line_id")), "starts")
        if not again.isEmpty():
            mined = stage(self._mined_again(mined, again), "mined")
            whole = self._whole(mined)
        exact = F.col("reported") == F.col("chunks")
        sure = whole.where(exact & (F.col("n") >= F.col("least"))).select("host", "seq", F.col("n").alias("n_docs"), "n_host")
        open_ = stage(whole.where(~exact & F.col("possible")).select("host", "seq", "n_host", "least"), "open")
        if not open_.isEmpty():
            sure = sure.unionByName(self._counted(open_))
        return stage(sure, "frequent")

    def _whole(self, mined: DataFrame) -> DataFrame:
        """Chunks' figures added up by sequence, next to those of the source."""
        source = mined.where(F.size("seq") == 0).groupBy("host").agg(
            F.sum("n").alias("n_host"), F.count("*").alias("chunks"), F.sum("spare").alias("all_spare")
        )
        cand = mined.where(F.size("seq") > 0).groupBy("host", "seq").agg(
            F.sum("n").alias("n"), F.count("*").alias("reported"), F.sum("spare").alias("spare"),
            F.count("after").alias("n_follows"), F.coalesce(F.min("after") == F.max("after"), F.lit(False)).alias("one_left"),
        )
        least = F.greatest(F.lit(MIN_DOCS), F.ceil(F.lit(MIN_SHARE) * F.col("n_host"))).cast("long")
        return (
            cand.join(source, "host")
            .withColumn("least", least)
            .withColumn("possible", F.col("n") + F.col("all_spare") - F.col("spare") >= F.col("least"))
        )

    def _mined_again(self, mined: DataFrame, starts: DataFrame) -> DataFrame:
        """Sources whose chunks disagree on what a line follows, mined with these lines as starts."""
        hosts = starts.select("host").distinct()

        def run(docs: pa.Table, lines: pa.Table) -> pa.Table:
            if not docs.num_rows:
                return pa.schema([("host", pa.string()), ("chunk", pa.int32()), ("spare", pa.int64()), ("seq", pa.list_(pa.int64())), ("n", pa.int64()), ("after", pa.int64())]).empty_table()
            return _mined(docs, frozenset(lines.column("line_id").to_pylist()))

        docs = self.docs.join(hosts, "host", "left_semi")
        second = docs.groupBy("host", "chunk").cogroup(self._for_chunks(starts).groupBy("host", "chunk")).applyInArrow(run, _MINED)
        return mined.join(hosts, "host", "left_anti").unionByName(second)

    def _counted(self, open_: DataFrame) -> DataFrame:
        """Exact counts of sequences that some chunk did not list."""
        schema = "host string, seq array<long>, n long"

        def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
            if not docs.num_rows or not wanted.num_rows:
                return pa.schema([("host", pa.string()), ("seq", pa.list_(pa.int64())), ("n", pa.int64())]).empty_table()
            seqs = wanted.column("seq").to_pylist()
            return pa.table(
                [wanted.column("host"), pa.array(seqs, pa.list_(pa.int64())), pa.array(holding(_documents(docs), seqs), pa.int64())], names=["host", "seq", "n"]
            )

        docs = self.docs.join(open_.select("host").distinct(), "host", "left_semi")
        counts = docs.groupBy("host", "chunk").cogroup(self._for_chunks(open_.select("host", "seq")).groupBy("host", "chunk")).applyInArrow(run, schema)
        total = counts.groupBy("host", "seq").agg(F.sum("n").alias("n_docs"))
        return open_.join(total, ["host", "seq"]).where(F.col("n_docs") >= F.col("least")).select("host", "seq", "n_docs", "n_host")


def frequent_sequences(pages: DataFrame) -> DataFrame:
    """``host, seq, n_docs, length`` of every frequent sequence, single lines included."""
    found = Miner(stage(sequences(pages), "sequences")).frequent()
    return found.select("host", "seq", "n_docs", F.size("seq").alias("length"))


def lines_of(found: DataFrame) -> DataFrame:
    """``host, line_id``: the lines of frequent sequences."""
    return found.select("host", F.explode("seq").alias("line_id")).distinct()


def repeated_lines(pages: DataFrame) -> DataFrame:
    """``host, line`` of every line of a frequent sequence, over all pages."""
    seqs = stage(sequences(pages), "sequences")
    frequent = stage(lines_of(Miner(seqs).frequent()), "lines")
    texts = (
        seqs.where("texts is not null")
        .select("host", F.explode("texts").alias("line_id", "line"))
        .join(frequent, ["host", "line_id"], "left_semi")
        .groupBy("host", "line_id")
        .agg(F.min("line").alias("line"))
    )
    named = stage(frequent.join(texts, ["host", "line_id"], "left"), "named")
    lost = named.where("line is null")
    if lost.isEmpty():
        return named.select("host", "line")
    return named.where("line is not null").select("host", "line").unionByName(_spell(pages, seqs, lost))


def _spell(pages: DataFrame, seqs: DataFrame, lost: DataFrame) -> DataFrame:
    """Exact way for frequent lines common in no split: read them from one document each."""
    wanted = (
        seqs.select("host", "id", F.explode("seq").alias("line_id"))
        .join(lost.select("host", "line_id"), ["host", "line_id"], "left_semi")
        .groupBy("host", "line_id")
        .agg(F.min("id").alias("id"))
        .groupBy("id")
        .agg(F.collect_set("line_id").alias("wanted"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, lines = [], []
            for url, want, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                keep = set(want)
                for s in set(page_lines(text_of(body.as_py()))):
                    if line_id(s) in keep:
                        hosts.append(host_of(url))
                        lines.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(lines, pa.string())], names=["host", "line"])

    return stored(pages, "id", "url").join(wanted, "id").select("url", "wanted", "html").mapInArrow(run, "host string, line string").distinct()


# ---------------------------------------------------------------- cleaning


def pair_id(host: str, line: int) -> int:
    """64-bit identifier of a line of a host."""
    return signed(xxhash.xxh64_intdigest(f"{host}\n{line}"))


_CLEAN = "row long, host string, id long, lines array<string>, n_removed int"


def without_repeated(pages: DataFrame) -> DataFrame:
    """``host, id, lines, n_removed``: every document's lines without those of sequences frequent in its host.

    The identifiers of all frequent lines go to every task if there are at most
    :data:`SENT_LINES`; more are joined to the pages by host. Either way a page
    is filtered where it is rendered.
    """
    frequent = stage(lines_of(Miner(stage(sequences(pages), "sequences")).frequent()), "lines")
    spark = pages.sparkSession
    rows = spread(stored(pages, "id", "url"), "id").withColumn("row", F.monotonically_increasing_id())
    if frequent.count() <= SENT_LINES:
        pairs = np.array(sorted(pair_id(r["host"], r["line_id"]) for r in frequent.toLocalIterator()), np.int64)
        sent = spark.sparkContext.broadcast(pairs)  # at most SENT_LINES numbers
        narrow = rows.select("row", "id", "url", F.lit(None).cast("array<long>").alias("gone"), "html")
    else:
        sent = None
        by_host = frequent.groupBy("host").agg(F.collect_list("line_id").alias("gone"))  # at most the lines of a page / MIN_SHARE
        narrow = rows.withColumn("host", site("url")).join(by_host, "host", "left").select("row", "id", "url", "gone", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                hosts = [host_of(u) for u in part.column(2).to_pylist()]
                kept, removed = [], []
                for host, gone, body in zip(hosts, part.column(3).to_pylist(), part.column(4)):
                    lines = render(text_of(body.as_py())).lines
                    ids = [line_id(normal(s)) for s in lines]
                    if sent is None:
                        own = set(gone or ())
                        left = [s for s, x in zip(lines, ids) if x not in own]
                    elif ids and len(sent.value):
                        want = np.array([pair_id(host, x) for x in ids], np.int64)
                        i = np.minimum(np.searchsorted(sent.value, want), len(sent.value) - 1)
                        left = [s for s, hit in zip(lines, sent.value[i] == want) if not hit]
                    else:
                        left = lines
                    kept.append(left)
                    removed.append(len(lines) - len(left))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(hosts, pa.string()), part.column(1), pa.array(kept, pa.list_(pa.string())), pa.array(removed, pa.int32())],
                    names=["row", "host", "id", "lines", "n_removed"],
                )

    return once(stage(narrow.mapInArrow(run, _CLEAN), "clean"), "host", "id")
