"""All registered queries and their check SQL."""

from tidepost.plans import lexicon_queries, model_queries, stream_queries, summary_queries, text_queries, stored_queries  # noqa: F401
from tidepost.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
