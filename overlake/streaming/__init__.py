from overlake.streaming.bronze_stream import ingest_available
from overlake.streaming.changes import changes_of, follow_changes

__all__ = ["changes_of", "follow_changes", "ingest_available"]
