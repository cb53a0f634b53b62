"""Archive records, XML records, catalogs and robots rules from bytes and text."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.robotparser import RobotFileParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import batches
from ..session import ship


_GAP = b"\r\n\r\n"  # fixed value: ends a block of headers


def split_record(raw: bytes | None) -> tuple[str | None, bytes | None]:
    """(content type, body) of one compressed archive record; ``None`` where it is none.

    A record is the archive's headers, the response's headers and the payload,
    each ended by an empty line; a missing part is empty.
    """
    if raw is None:
        return None, None
    try:
        data = gzip.decompress(raw)
    except (OSError, EOFError, ValueError):
        return None, None
    start = data.find(_GAP)
    start = len(data) if start < 0 else start + len(_GAP)
    stop = data.find(_GAP, start)
    head, body = (data[start:], b"") if stop < 0 else (data[start:stop], data[stop + len(_GAP) :])
    fields = dict(line.lower().split(b":", 1)[:1] + [line.split(b":", 1)[1]] for line in head.splitlines()[1:] if b":" in line)
    named = {k.strip(): v.strip() for k, v in fields.items()}
    return named.get(b"content-type", b"").decode("latin-1"), body


def parse_records(df: DataFrame, raw: str, *keys: str) -> DataFrame:
    """``keys, ctype, body`` of a column of compressed records."""
    ship(df.sparkSession)
    narrow = df.select(*keys, raw)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [split_record(r) for r in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(n)], pa.array([p[0] for p in parsed], pa.string()), pa.array([p[1] for p in parsed], pa.binary())],
                names=[*keys, "ctype", "body"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:n])
    return narrow.mapInArrow(run, f"{schema}, ctype string, body binary")


def xml_records(text: Column, tag: str = "PubmedArticle", number: str = "PMID") -> Column:
    """Array of (number, record text) of the elements of one tag."""
    whole = F.regexp_extract_all(text, F.lit(rf"(?s)(<{tag}\b.*?</{tag}>)"), F.lit(1))
    return F.transform(whole, lambda r: F.struct(F.regexp_extract(r, rf"<{number}[^>]*>(\d+)</{number}>", 1).alias("number"), r.alias("record")))


def record_intake(wanted: DataFrame, answers: DataFrame, size: int) -> DataFrame:
    """``id, number, batch, kind, status, nbytes, record`` of every wanted record: stored if a batch's answer holds it, else not found.

    ``wanted``: ``id, number`` (string); ``answers``: texts of XML records, in any batches. Records nobody asked for are
    left out; of several records with one number the longest counts, ties by text.
    """
    asked = batches(wanted.where("number is not null"), ("number", "id"), size)
    got = answers.select(F.explode(xml_records(F.col("text"))).alias("x")).select("x.number", "x.record")
    best = got.groupBy("number").agg(F.max(F.struct(F.octet_length("record").alias("n"), "record")).alias("r"))
    hit = F.col("r").isNotNull()
    return asked.join(best, "number", "left").select(
        "id", "number", "batch", F.when(hit, "ok").otherwise("notfound").alias("kind"), F.when(hit, 200).otherwise(404).alias("status"),
        F.coalesce("r.n", F.lit(0)).cast("long").alias("nbytes"), F.col("r.record").alias("record"),
    )


# The element a catalog stands in, how its entries are named, and marks of links that lead to no chapter.
CATALOG = "catalog-content"
ENTRY = "si"
GROUP_LINK = "catalog_group"
NO_CHAPTER = ("_group", "quanben")


class Catalog(HTMLParser):
    """Numbered entries of a catalog page in document order, each with the address of its own chapter or ``None``.

    An entry is a list item named ``si<number>`` and lasts until the next one or
    the end of its list. Its chapter is the first link to an ``.html`` page
    without a fragment that is no heading of a group of entries.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.inside = False
        self.open = False
        self.entries: list[tuple[int, str | None]] = []
        self.linked = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = {k: v or "" for k, v in attrs}
        name = named.get("id", "")
        self.inside |= name == CATALOG
        if not self.inside:
            return
        if tag == "li" and name.startswith(ENTRY) and name[len(ENTRY) :].isascii() and name[len(ENTRY) :].isdigit():
            self.entries.append((int(name[len(ENTRY) :]), None))
            self.open, self.linked = True, False
        elif tag == "a" and self.open and not self.linked:
            address = named.get("href", "")
            if address.endswith(".html") and "#" not in address and not any(GROUP_LINK in v for v in named.values()):
                self.linked = True
                if not any(mark in address for mark in NO_CHAPTER):
                    self.entries[-1] = (self.entries[-1][0], address)

    def handle_endtag(self, tag: str) -> None:
        if tag == "ul":
            self.open = False


def parse_catalog(html: str | None) -> list[tuple[int, str | None]]:
    """Entries of one catalog page; none where there is no catalog."""
    if not html or CATALOG not in html:
        return []
    parser = Catalog()
    parser.feed(html)
    parser.close()
    return parser.entries


def catalog_entries(df: DataFrame, html: str, *keys: str) -> DataFrame:
    """``keys, pos, si, href`` of the catalog pages of a frame; ``pos`` numbers the entries of a page from 0."""
    ship(df.sparkSession)
    narrow = df.select(*keys, F.col(html).cast("string").alias("_html"))
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, pos, si, href = [], [], [], []
            for i, text in enumerate(b.column(n).to_pylist()):
                for k, (number, address) in enumerate(parse_catalog(text)):
                    row.append(i)
                    pos.append(k)
                    si.append(number)
                    href.append(address)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i).take(at) for i in range(n)], pa.array(pos, pa.int32()), pa.array(si, pa.int64()), pa.array(href, pa.string())], names=[*keys, "pos", "si", "href"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:n])
    return narrow.mapInArrow(run, f"{schema}, pos int, si long, href string")


def collections(text: Column, pattern: str) -> Column:
    """Names in a JSON list of collections that match a pattern as a whole, in order; none in what is no such list."""
    names = F.from_json(text, "array<struct<id: string>>")
    return F.filter(F.transform(F.coalesce(names, F.array().cast("array<struct<id: string>>")), lambda c: c.id), lambda x: F.coalesce(x.rlike(f"^(?:{pattern})$"), F.lit(False)))


def listing_lines(text: Column) -> Column:
    """Array of (ts, original) of a listing's lines; lines without a blank are none."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: x.contains(" "))
    return F.transform(lines, lambda x: F.struct(F.split(x, " ", 2)[0].alias("ts"), F.split(x, " ", 2)[1].alias("original")))


def robots_rules(df: DataFrame, rules: str, url: str, agent: str = "*") -> DataFrame:
    """Adds ``allowed`` and ``crawl_delay`` from each row's robots text; without rules everything is allowed at once.

    Rules that cannot be read allow everything.
    """
    ship(df.sparkSession)

    @F.pandas_udf("allowed boolean, crawl_delay double")
    def judged(text: pd.Series, u: pd.Series) -> pd.DataFrame:
        parsers: dict[str, RobotFileParser] = {}

        def one(t: str | None, a: str | None) -> tuple[bool, float | None]:
            if not t or a is None:
                return True, None
            p = parsers.get(t)
            if p is None:
                p = parsers[t] = RobotFileParser()
                p.parse(t.splitlines())
            delay = p.crawl_delay(agent)
            return p.can_fetch(agent, a), None if delay is None else float(delay)

        return pd.DataFrame([one(t, a) for t, a in zip(text, u)], columns=["allowed", "crawl_delay"])

    return df.withColumn("_r", judged(F.col(rules), F.col(url))).select("*", "_r.allowed", "_r.crawl_delay").drop("_r")
