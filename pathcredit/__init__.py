"""Multi-touch attribution over versioned web-visit logs, as Spark DataFrame jobs."""

from pathcredit.config import local_session, materialize

__all__ = ["local_session", "materialize"]
