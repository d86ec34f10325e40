"""All queries of this subpackage."""

from lodestrata.llm import corpus_queries, text_queries, token_queries  # noqa: F401
from lodestrata.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
