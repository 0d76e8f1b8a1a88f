"""Files that arrive over time."""

from paytally.streaming.ingest import ingest_available

__all__ = ["ingest_available"]
