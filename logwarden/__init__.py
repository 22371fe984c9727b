"""Security-log analytics as Spark jobs."""

from logwarden.session import session

__all__ = ["session"]
