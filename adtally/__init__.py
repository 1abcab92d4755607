"""Advertising-log analytics expressed as Spark DataFrame, SQL, streaming and ML jobs."""

from adtally.session import get_session

__all__ = ["get_session"]
