"""Registered queries; importing this package registers them all."""

from . import check_queries, corpus_queries, dialogue_queries, planning_queries, text_queries, view_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "check_queries", "corpus_queries", "dialogue_queries", "planning_queries", "text_queries", "view_queries"]
