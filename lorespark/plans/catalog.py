"""Every query of the core with its SQL counterpart."""

from __future__ import annotations

from lorespark.plans import q_ask, q_data, q_functions, q_more, q_records, q_sources, q_text

QUERIES: dict = {}
SQL: dict = {}
for _module in (q_ask, q_data, q_functions, q_records, q_text, q_more, q_sources):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
