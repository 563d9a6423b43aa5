"""Importing this module registers every query of the subpackage."""

from devicepulse.llm import page_queries, text_queries
from devicepulse.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "page_queries", "text_queries"]
