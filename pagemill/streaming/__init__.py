from pagemill.streaming.fetch import FetchLog, fetch_resumable
from pagemill.streaming.listing import ingest_batches, track_listing, tracked_breaks

__all__ = ["FetchLog", "fetch_resumable", "ingest_batches", "track_listing", "tracked_breaks"]
