"""All queries of the reference's operators, and their DuckDB twins, by name."""

from __future__ import annotations

from . import chain, codecs, files, keeper, node, receipts, state, stores, streams

QUERIES, ORACLES = {}, {}
for part in (receipts, stores, state, chain, codecs, node, keeper, files, streams):
    QUERIES |= part.QUERIES
    ORACLES |= part.ORACLES
