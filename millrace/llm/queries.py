"""Queries of the training-data operators, by problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import abuse as A
from . import lines as L
from . import packing as K
from . import pages as P
from . import tokens as T
from .sqlparts import SQL  # noqa: F401  (read next to QUERIES)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return P.garbled_pages(P.load(spark, d))


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    return P.restored_pages(P.load(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return P.residue_pages(P.message_facts(P.load(spark, d)))


def p3_messages(spark: SparkSession, d: str) -> DataFrame:
    """Every group of masked residue or short bodies with its spread and verdict."""
    return P.messages(P.message_facts(P.load(spark, d)))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return P.main_lines(P.load(spark, d))


def p4_text(spark: SparkSession, d: str) -> DataFrame:
    """Main body of every page as one laid-out text."""
    return P.main_texts(P.load(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return P.page_languages(P.load(spark, d))


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    return P.language_segments(P.load(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return P.markup_pages(P.load(spark, d))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return P.clean_markup(P.load(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return L.repeated_lines(P.load(spark, d))


def p7_sequences(spark: SparkSession, d: str) -> DataFrame:
    return L.frequent_sequences(P.load(spark, d))


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every page without the lines repeated in its host: ``host, id, text, n_removed``."""
    return L.without_repeated(P.load(spark, d)).select("host", "id", F.array_join("lines", "\n").alias("text"), "n_removed")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return T.encode_texts(table(spark, d, "documents"))


def _windows(spark: SparkSession, d: str) -> list[tuple[str, int]]:
    """The context windows: a fixed handful of rows."""
    rows = table(spark, d, "context_windows").orderBy("capacity", "window_name").collect()
    return [(r["window_name"], int(r["capacity"])) for r in rows]


def p9_packing(spark: SparkSession, d: str) -> DataFrame:
    """``window_name, item, piece, size, container`` for every document and window."""
    return K.pack_windows(T.token_counts(table(spark, d, "documents")), _windows(spark, d))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, the least possible number, the share of space used and of items placed by least squares, per window."""
    windows = _windows(spark, d)
    packed, recipes = K.pack_by_recipes(T.token_counts(table(spark, d, "documents")), windows)
    return K.fill_windows(packed, windows, recipes)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return A.flagged(A.score_documents(table(spark, d, "documents")))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return A.score_documents(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return A.rates(A.score_documents(table(spark, d, "documents")))


QUERIES = {"p2_found": p2_found, "p2_restored": p2_restored, "p3_found": p3_found, "p3_messages": p3_messages, "p4_found": p4_found, "p4_text": p4_text, "p5_found": p5_found, "p5_segments": p5_segments, "p6_found": p6_found, "p6_clean": p6_clean,
    "p7_found": p7_found, "p7_sequences": p7_sequences, "p7_clean": p7_clean,
    "p8_ids": p8_ids, "p9_packing": p9_packing, "p9_fill": p9_fill, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates}
