"""Encoding texts with the byte-level BPE of a public tokenizer.

Method: hierarchical-bitmap rank queue. All distinct pre-tokens of a batch of
texts lie behind one another in one array of symbols with a doubly linked list
over it. Each merge rank has a bucket of list positions whose pair it merges; a
three-level bitmap over ranks tells which buckets are filled, find-first-set
gives the next rank, and entries whose pair has changed meanwhile are skipped.
Merging two symbols can only create pairs of higher rank (a merge of a symbol
comes after the merge that makes it), so every rank is taken once and all its
positions are merged together, left to right. Work is proportional to the bytes
whatever the length of a pre-token.

Defined results: null and empty texts have no ids (an empty list); strings of
special tokens are ordinary text; invalid surrogates are encoded as U+FFFD.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, spread

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"

#: The pre-token pattern of the public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens kept with their ids between batches of a worker.
CACHE = 400_000
#: Characters of text encoded together.
BATCH_CHARS = 6_000_000


class RankBitmap:
    """Set of ranks with find-first-set over three levels of 64-bit words."""

    def __init__(self, size: int) -> None:
        self.low = [0] * ((size >> 6) + 1)
        self.mid = [0] * ((size >> 12) + 1)
        self.top = 0

    def add(self, r: int) -> None:
        self.low[r >> 6] |= 1 << (r & 63)
        self.mid[r >> 12] |= 1 << ((r >> 6) & 63)
        self.top |= 1 << (r >> 12)

    def discard(self, r: int) -> None:
        self.low[r >> 6] &= ~(1 << (r & 63))
        if not self.low[r >> 6]:
            self.mid[r >> 12] &= ~(1 << ((r >> 6) & 63))
            if not self.mid[r >> 12]:
                self.top &= ~(1 << (r >> 12))

    def first(self) -> int:
        """Smallest member, -1 when empty."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        w = self.mid[a]
        b = (a << 6) + (w & -w).bit_length() - 1
        w = self.low[b]
        return (b << 6) + (w & -w).bit_length() - 1


def _byte_chars() -> dict[str, int]:
    """The printable characters a byte-level vocabulary file writes bytes with, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain}
    extra = 256
    for b in range(256):
        if b not in plain:
            chars[chr(extra)] = b
            extra += 1
    return chars


class Encoder:
    """Byte-level BPE with merges in rank order."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.split = regex.compile(PATTERN).findall
        self.byte_id = np.zeros(256, np.int64)
        for c, b in _byte_chars().items():
            self.byte_id[b] = vocab[c]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        key = left << 20 | right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.left, self.right, self.made = left, right, made
        self.known: dict[str, np.ndarray] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 without one."""
        key = a << 20 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; no merge crosses a piece's end."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        total = int(sizes.sum())
        if not total:
            return [np.zeros(0, np.int32) for _ in pieces]
        sym = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        ends = np.cumsum(sizes)
        # one sentinel in front and behind; links never leave a piece
        nxt = np.arange(1, total + 1)
        prv = np.arange(-1, total - 1)
        nonempty = sizes > 0
        nxt[ends[nonempty] - 1] = total
        prv[(ends - sizes)[nonempty]] = -1
        sym = np.append(sym, -1)
        alive = np.ones(total + 1, bool)
        buckets: dict[int, list[np.ndarray]] = {}
        filled = RankBitmap(len(self.made))

        def queue(at: np.ndarray) -> None:
            """Put positions into the buckets of their pair's rank."""
            at = at[nxt[at] < total]
            if not len(at):
                return
            r = self._rank(sym[at], sym[nxt[at]])
            keep = r >= 0
            at, r = at[keep], r[keep]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            starts = [0, *cuts.tolist()]
            stops = [*cuts.tolist(), len(r)]
            for s, e, k in zip(starts, stops, r[starts].tolist()):
                b = buckets.get(k)
                if b is None:
                    buckets[k] = [at[s:e]]
                    filled.add(k)
                else:
                    b.append(at[s:e])

        queue(np.arange(total))
        while (rank := filled.first()) >= 0:
            filled.discard(rank)
            entries = buckets.pop(rank)
            at = entries[0] if len(entries) == 1 else np.unique(np.concatenate(entries))
            a, b = int(self.left[rank]), int(self.right[rank])
            follow = nxt[at]
            fresh = alive[at] & (sym[at] == a) & (follow < total)
            fresh[fresh] &= sym[follow[fresh]] == b
            at = at[fresh]
            if not len(at):
                continue
            if a == b and len(at) > 1:
                # pairs that overlap: within a chain take every other one, from the left
                at = np.sort(at)
                linked = np.zeros(len(at), bool)
                linked[1:] = nxt[at[:-1]] == at[1:]
                start = np.maximum.accumulate(np.where(~linked, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            gone = nxt[at]
            sym[at] = self.made[rank]
            alive[gone] = False
            after = nxt[gone]
            nxt[at] = after
            inner = after < total
            prv[after[inner]] = at[inner]
            before = prv[at]
            queue(np.unique(np.concatenate([at, before[before >= 0]])))
        piece = np.repeat(np.arange(len(pieces)), sizes)[alive[:total]]
        ids = sym[:total][alive[:total]].astype(np.int32)
        return np.split(ids, np.searchsorted(piece, np.arange(1, len(pieces))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind one another, number of ids of each text)."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for words in split for w in words if w not in known})
        for at in range(0, len(new), 400_000):
            part = new[at : at + 400_000]
            known.update(zip(part, self.merge([w.encode("utf-8", "replace") if w.isascii() else _utf8(w) for w in part])))
        counts = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        for i, words in enumerate(split):
            if words:
                ids = np.concatenate([known[w] for w in words])
                counts[i] = len(ids)
                parts.append(ids)
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), counts


def _utf8(word: str) -> bytes:
    try:
        return word.encode("utf-8")
    except UnicodeEncodeError:
        return word.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode("utf-8")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t) if t else 0
        if chars > BATCH_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """``key, ids``: token ids of every text, without special tokens."""
    ship(df.sparkSession)
    path = os.path.join(folder, VOCABULARY)
    narrow = df.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _batches(texts):
                ids, counts = enc.encode(texts[a:b])
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=[key, "ids"]
                )

    return spread(narrow, key).mapInArrow(run, f"`{key}` long, ids array<int>")


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """``key, n_tokens`` of every text."""
    ship(df.sparkSession)
    path = os.path.join(folder, VOCABULARY)
    narrow = df.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _batches(texts):
                _, counts = enc.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts)], names=[key, "n_tokens"])

    return spread(narrow, key).mapInArrow(run, f"`{key}` long, n_tokens long")
