"""Distributed passes over ``pages`` shared by the page operators.

Every pass reads only the columns it needs, renders each stored body once
inside an Arrow batch and returns narrow rows. Nothing is collected; a page is
a row, so no key can make one task larger than another.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship, spread, stage, table
from . import language, mainbody, markup, mojibake, residue
from .html import Page, render, to_text

#: Pages whose rows are held at once in a worker.
PAGES_AT_ONCE = 1000
#: Hosts on which a short body must recur to be a message.
MIN_HOSTS = 3

_HOST = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?")


def host_of(url: str | None) -> str:
    """Host name in lower case without user part, port and one leading ``www.``."""
    m = _HOST.match(url or "")
    h = (m.group(1) or "") if m else ""
    h = h.rpartition("@")[2]
    h = re.sub(r":[0-9]*$", "", h).lower()
    return h[4:] if h.startswith("www.") else h


def stored(pages: DataFrame, *columns: str) -> DataFrame:
    """Rows with a body; ``html`` last. Null bodies never leave the scan."""
    return pages.where(F.col("html").isNotNull()).select(*columns, F.col("html").cast("binary").alias("html"))


def text_of(body: bytes | None) -> str:
    return body.decode("utf-8", "replace") if body else ""


def map_pages(
    df: DataFrame,
    row: Callable[..., list[tuple]],
    schema: str,
    keys: int,
    finish: Callable[[list[tuple]], list[tuple]] | None = None,
) -> DataFrame:
    """Apply ``row(*key_values, html_text) -> rows`` to every page.

    ``df`` has ``keys`` leading columns and ``html`` last; the rows returned
    have the columns of ``schema``. ``finish`` turns the rows of up to
    :data:`PAGES_AT_ONCE` pages into the final ones, for steps that work on
    many pages as one matrix.
    """
    ship(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        gc.disable()  # trees of one page are freed by reference counts alone
        for batch in batches:
            if not batch.num_rows:
                continue
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                columns = [part.column(i).to_pylist() for i in range(keys)]
                out: list[tuple] = []
                for values in zip(*columns, part.column(keys)):
                    out.extend(row(*values[:-1], text_of(values[-1].as_py())))
                if finish is not None:
                    out = finish(out)
                if out:
                    cells = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cells, target)], schema=target)

    return spread(df, df.columns[keys - 1] if "id" not in df.columns else "id").mapInArrow(run, schema)


def once(rows: DataFrame, *keys: str) -> DataFrame:
    """The first row of each key of a staged frame that numbers its rows in ``row``.

    Only keys and row numbers are shuffled; the numbers of repeated rows, which
    are few, are staged, so that a broadcast of them is chosen by their measured
    size and other columns stay where they are. Null keys are equal.
    """
    narrow = rows.select(*keys, "row")
    first = narrow.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("row").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    later = stage(narrow.join(first, same).where("row > _first").select("row"), "later")
    return rows.join(later, "row", "left_anti").drop("row")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Staged with a number for each row in ``row``."""
    return stage(df.withColumn("row", F.monotonically_increasing_id()), name)


# ---------------------------------------------------------------- problem 2


def garbled_pages(pages: DataFrame) -> DataFrame:
    """``source, id`` of each page with garbled or lost text anywhere on it.

    Null bodies are no pages here; an empty body is clean. Copies of a pair count once.
    """

    def row(source: str, id_: int, html: str) -> list[tuple]:
        p = render(html)
        return [(source, id_)] if mojibake.garbled([p.raw_title, *p.raw])[0] else []

    return map_pages(stored(pages, "source", "id"), row, "source string, id long", 2).distinct()


def restored_pages(pages: DataFrame) -> DataFrame:
    """Every garbled page with its title and lines as they were: ``source, id, title, lines, n_restored, restorable``.

    ``restorable`` is false where characters stay lost after the best restoration.
    """

    def row(source: str, id_: int, html: str) -> list[tuple]:
        p = render(html)
        bad, changed = mojibake.garbled([p.raw_title, *p.raw], all_lines=True)
        if not bad:
            return []
        texts = [p.title, *p.lines]
        for i, text in changed:
            texts[i] = " ".join(text.split())
        left = any(mojibake._HARD_LOSS.search(s) for s in texts) or not changed
        return [(source, id_, texts[0], texts[1:], len(changed), not left)]

    schema = "source string, id long, title string, lines array<string>, n_restored int, restorable boolean"
    return once(numbered(map_pages(stored(pages, "source", "id"), row, schema, 2), "restored"), "source", "id")


# ------------------------------------------------------- problem 3 and bodies

FACTS = "source string, id long, host string, garbled boolean, residue boolean, body_hash long"


def page_facts(p: Page) -> tuple[bool, bool, int | None, int, list[int]]:
    """(garbled, residue by local rules, hash of a body short enough to be a message, headline, main blocks)."""
    head, body = mainbody.with_headline(p)
    bad, _ = mojibake.garbled([p.raw_title, *p.raw])
    case, h = _judged(p, body, head)
    return bad, case, h, head, body


def _judged(p: Page, body: list[int], head: int) -> tuple[bool, int | None]:
    """(a case whatever other pages say, masked hash of a body that must recur)."""
    kind, text = residue.judge(p, body, head)
    return kind in residue.SURE, residue.group_of(kind, text) if kind == "body" else None


def recurring_messages(facts: DataFrame, min_hosts: int = MIN_HOSTS) -> DataFrame:
    """Masked hashes of short bodies that recur on ``min_hosts`` hosts or more.

    ``facts`` has ``host`` and ``body_hash``. Pairs are made distinct before
    they are counted, so a host that shows one message a million times sends
    one row per input split.
    """
    return (
        facts.where("body_hash is not null")
        .select("body_hash", "host")
        .distinct()
        .groupBy("body_hash")
        .agg(F.count("*").alias("n_hosts"))
        .where(F.col("n_hosts") >= min_hosts)
    )


MESSAGES = "source string, id long, host string, hash long, kind string, text string"


def message_facts(pages: DataFrame) -> DataFrame:
    """One row per page row with residue or a short body: the masked text's hash, its class and a sample; staged."""

    def row(source: str, id_: int, url: str, html: str) -> list[tuple]:
        p = render(html)
        head, body = mainbody.with_headline(p)
        kind, text = residue.judge(p, body, head)
        return [(source, id_, host_of(url), residue.group_of(kind, text), kind, text)] if kind else []

    return stage(map_pages(stored(pages, "source", "id", "url"), row, MESSAGES, 3), "residue")


def messages(facts: DataFrame, min_hosts: int = MIN_HOSTS) -> DataFrame:
    """``hash, kind, n_hosts, n_pages, sample, is_residue``: exact groups of masked texts across hosts.

    A group is residue if a rule is sure of it or if it recurs on ``min_hosts``
    hosts. (hash, host) pairs are pre-aggregated, so a host that shows one
    message a million times sends one row per input split.
    """
    by_host = facts.groupBy("hash", "host").agg(F.min("kind").alias("kind"), F.count("*").alias("n"), F.min("text").alias("sample"))
    return (
        by_host.groupBy("hash")
        .agg(
            F.max(F.col("kind").isin(*sorted(residue.SURE))).alias("sure"),
            F.min("kind").alias("kind"),
            F.count("*").alias("n_hosts"),
            F.sum("n").alias("n_pages"),
            F.min("sample").alias("sample"),
        )
        .select("hash", "kind", "n_hosts", "n_pages", "sample", (F.col("sure") | (F.col("n_hosts") >= min_hosts)).alias("is_residue"))
    )


def residue_pages(facts: DataFrame) -> DataFrame:
    """``source, id`` of pages whose main body is or contains residue, from staged facts."""
    groups = messages(facts).where("is_residue").select("hash")
    return facts.select("source", "id", "hash").join(groups, "hash", "left_semi").select("source", "id").distinct()


# ---------------------------------------------------------------- problem 4


def body_facts(pages: DataFrame) -> DataFrame:
    """Facts and distinct main lines of every page that is no case by local rules, staged."""

    def row(source: str, id_: int, url: str, html: str) -> list[tuple]:
        p = render(html)
        bad, case, h, _, body = page_facts(p)
        if bad or case:
            return []
        lines = list(dict.fromkeys([p.lines[i] for i in body]))
        return [(source, id_, host_of(url) if h is not None else None, False, False, h, lines)]

    return numbered(map_pages(stored(pages, "source", "id", "url"), row, FACTS + ", lines array<string>", 3), "bodies")


def without_messages(facts: DataFrame) -> DataFrame:
    """Staged facts without the pages whose body turned out to be a recurring message.

    Only rows with a short body take part in the join; the rest pass by.
    """
    sure = facts.where("body_hash is null")
    doubtful = facts.where("body_hash is not null").join(recurring_messages(facts), "body_hash", "left_anti")
    return sure.unionByName(doubtful)


def main_lines(pages: DataFrame) -> DataFrame:
    """``source, id, line``: each distinct main line of pages that are no case of garbling or residue."""
    facts = body_facts(pages)  # lines are distinct within a row
    kept = without_messages(once(facts, "source", "id"))
    return kept.select("source", "id", F.explode("lines").alias("line"))


def main_texts(pages: DataFrame) -> DataFrame:
    """``source, id, text``: main body of each such page as one text, with its block spacing, lists and aligned table cells."""

    def row(source: str, id_: int, url: str, html: str) -> list[tuple]:
        p = render(html)
        bad, case, h, _, body = page_facts(p)
        return [] if bad or case else [(source, id_, host_of(url) if h is not None else None, False, False, h, to_text(p, body))]

    facts = numbered(map_pages(stored(pages, "source", "id", "url"), row, FACTS + ", text string", 3), "texts")
    return without_messages(once(facts, "source", "id")).select("source", "id", "text")


# ---------------------------------------------------------------- problem 5


def _languages(rows: list[tuple]) -> list[tuple]:
    """Classify the main lines of many pages as one matrix.

    In: (source, id, host, body_hash, declared, lines). Out: the same with a
    list of (line, language or None, confidence, is prose).
    """
    texts: list[str] = []
    plan: list[list[tuple[str, bool, int]]] = []
    for *_, lines in rows:
        prose = [language.running_text(s) for s in lines]
        only = any(prose)
        plan.append([])
        for s, p in zip(lines, prose):
            if p or not only and _ANY_LETTER.search(s) and not language._CODE.match(s):
                plan[-1].append((s, p, len(texts)))
                texts.append(s)
            else:
                plan[-1].append((s, False, -1))
    kinds, sure = language.classify(texts)
    return [(*r[:5], [(s, int(kinds[j]) if j >= 0 and kinds[j] != language.REST else -1, float(sure[j]) if j >= 0 else 0.0, p) for s, p, j in marked]) for r, marked in zip(rows, plan)]


_ANY_LETTER = re.compile(r"[^\W\d_]{2}|[㐀-鿿]")


def _language_row(source: str, id_: int, url: str, html: str) -> list[tuple]:
    p = render(html)
    bad, case, h, _, body = page_facts(p)
    if bad or case:
        return []
    host = host_of(url) if h is not None else None
    return [(source, id_, host, h, language.declared(html), [p.lines[i] for i in body])]


def page_languages(pages: DataFrame) -> DataFrame:
    """``source, id, lang``: languages of each page whose declared one is missing, wrong or not its only one."""

    def finish(rows: list[tuple]) -> list[tuple]:
        out = []
        for source, id_, host, h, said, lines in _languages(rows):
            found = language.page_languages([k for _, k, _, _ in lines], [p for *_, p in lines])
            wrong = bool(found) and found != [said]
            if wrong or h is not None:
                out.append((source, id_, host, False, False, h, found if wrong else []))
        return out

    schema = FACTS + ", langs array<string>"
    facts = numbered(map_pages(stored(pages, "source", "id", "url"), _language_row, schema, 3, finish), "languages")
    return without_messages(once(facts, "source", "id")).select("source", "id", F.explode("langs").alias("lang"))


def language_segments(pages: DataFrame) -> DataFrame:
    """Every segment of every page: ``source, id, segment, lang, confidence, n_lines, text``."""

    def finish(rows: list[tuple]) -> list[tuple]:
        out = []
        for source, id_, _, _, _, lines in _languages(rows):
            runs = language.segments([k for _, k, _, _ in lines], [c for _, _, c, _ in lines])
            for n, (a, b, k, c) in enumerate(runs):
                out.append((source, id_, n, language.LANGUAGES[k], round(c, 4), b - a + 1, "\n".join(s for s, *_ in lines[a : b + 1])))
        return out

    schema = "source string, id long, segment int, lang string, confidence double, n_lines int, text string"
    return once(numbered(map_pages(stored(pages, "source", "id", "url"), _language_row, schema, 3, finish), "segments"), "source", "id", "segment")


# ---------------------------------------------------------------- problem 6


def fit_sample(pages: DataFrame, n: int = markup.SAMPLE_PAGES, most_bytes: int = markup.SAMPLE_BYTES) -> list[str]:
    """Bodies of the ``n`` (source, id) pairs with the least hashes, in order, of bodies of up to ``most_bytes``.

    Whatever the order of the input, it is the same sample; at most ``n`` bodies come to the driver.
    """
    own = stored(pages.where(F.octet_length("html") <= most_bytes), "source", "id").select(F.xxhash64("source", "id").alias("h"), "html")
    last = own.select("h").distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if last is None:
        return []
    rows = own.where(F.col("h") <= last).groupBy("h").agg(F.first("html").alias("html")).orderBy("h").collect()
    return [text_of(bytes(r["html"])) for r in rows]


def node_classifier(pages: DataFrame) -> markup.Trees:
    """Ensemble fitted on the driver from :func:`fit_sample`."""
    return markup.fit([render(h) for h in fit_sample(pages)])


def _markup_row(source: str, id_: int, url: str, html: str) -> list[tuple]:
    """(source, id, host, body hash, page, feature rows) of pages with any markup in sight or a short body."""
    p = render(html)
    head, body = mainbody.with_headline(p)
    case, h = _judged(p, body, head)
    if case:
        return []
    seen = markup.screened(p) and not mojibake.garbled([p.raw_title, *p.raw])[0]
    if not seen and h is None:
        return []
    return [(source, id_, host_of(url) if h is not None else None, h, p, markup.features(p, head) if seen else None)]


def markup_facts(pages: DataFrame, with_text: bool) -> DataFrame:
    model = node_classifier(pages)

    def finish(rows: list[tuple]) -> list[tuple]:
        """The trees see the nodes of many pages as one matrix; decoding is by page."""
        have = [r[5] for r in rows if r[5] is not None]
        logp = model.log_probabilities(np.vstack(have)) if have else None
        out, at = [], 0
        for source, id_, host, h, p, x in rows:
            kinds: list[str] = []
            text = None
            if x is not None:
                blocks = markup.decode(p, logp[at : at + len(x)])
                at += len(x)
                kinds = markup.kinds_in([p.lines[i] for i in blocks if not markup.code_block(p, i)])
                if kinds and with_text:
                    text = markup.clean_text([p.lines[i] for i in blocks], kinds)
            if kinds or h is not None:
                out.append((source, id_, host, False, False, h, kinds, text))
        return out

    schema = FACTS + ", kinds array<string>, text string"
    facts = numbered(map_pages(stored(pages, "source", "id", "url"), _markup_row, schema, 3, finish), "markup")
    return without_messages(once(facts, "source", "id"))


def markup_pages(pages: DataFrame) -> DataFrame:
    """``source, id, markup``: each kind of markup that main lines of a page show as text."""
    return markup_facts(pages, False).select("source", "id", F.explode("kinds").alias("markup"))


def clean_markup(pages: DataFrame) -> DataFrame:
    """``source, id, text``: clean main text of each page with markup residue."""
    return markup_facts(pages, True).where(F.size("kinds") > 0).select("source", "id", "text")


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")
