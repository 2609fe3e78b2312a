"""feedlake: a PySpark-native engine for append-only market-data feeds.

Raw push frames are decoded into one message table (``symbol, ts, mt, m``) and
served through DataFrame operators: counts and rates, latest-k, gap, median and
duplicate reports, typed payload parsing, closed-hour Parquet export with an
export log, and reconciliation of exported files against their source. The same
operators run in batch and in Structured Streaming.
"""

from feedlake.session import get_session, prepare_session, shared_path

__all__ = ["get_session", "prepare_session", "shared_path"]
