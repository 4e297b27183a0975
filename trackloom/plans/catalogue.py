"""All registered queries in one place."""

from trackloom.plans import (  # noqa: F401  (importing registers)
    audio_queries, config_queries, consensus_queries, record_queries, resume_queries, summary_queries, text_queries,
    track_queries,
)
from trackloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
