"""Composable Spark operators for event pipelines.

Every transform takes and returns a DataFrame, so the same code serves batch
tables and Structured Streaming.
"""

from millrace.session import build_session, materialise, shared_dir

__all__ = ["build_session", "materialise", "shared_dir"]
