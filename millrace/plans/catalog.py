"""All queries of the core library and their SQL counterparts."""

from __future__ import annotations

from . import captures_q, io_q, lists_q, mapping_q, pages_q, pipelines_q, reports_q, skew, store_q, urls_q

MODULES = [skew, urls_q, pages_q, captures_q, mapping_q, reports_q, lists_q, pipelines_q, io_q, store_q]
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}
