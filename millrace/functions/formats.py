"""Numbers, sizes, times and labels as reports show them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped(n: Column) -> Column:
    """Whole number with commas between thousands."""
    return F.format_number(n, 0)


def size_text(n_bytes: Column) -> Column:
    """Bytes with two decimals, in GB from 2**30 on, else in MB."""
    gb = n_bytes >= 1 << 30
    return F.concat(F.format_string("%.2f", F.when(gb, n_bytes / (1 << 30)).otherwise(n_bytes / (1 << 20))), F.when(gb, " GB").otherwise(" MB"))


def time_text(seconds: Column, pattern: str = "yyyy-MM-dd HH:mm") -> Column:
    """Unix seconds as wall-clock time of UTC, whatever the session's zone."""
    at = F.timestamp_add("SECOND", F.floor(seconds).cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(at, pattern)


def labelled(code: Column, labels: dict[str, str]) -> Column:
    """Text of a code; a code without one stays as it is."""
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code), code)
