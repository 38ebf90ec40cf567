"""All queries over the test tables and their SQL."""

from . import aggregate_queries, corpus_queries, gate_queries, join_queries, order_queries, record_queries, rewrite_queries, sample_queries, state_queries, stream_queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
