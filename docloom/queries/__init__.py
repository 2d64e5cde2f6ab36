"""Importing this package registers every query."""

from docloom.queries import (  # noqa: F401
    chunk_queries,
    column_queries,
    evaluation_queries,
    retrieval_queries,
    sink_queries,
    source_queries,
    stream_queries,
)
from docloom.queries.registry import ORACLES, QUERIES  # noqa: F401
