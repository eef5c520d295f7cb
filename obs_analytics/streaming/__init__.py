"""Incremental ingest: the same cleaning and roll-ups over files arriving
in a folder, with Structured Streaming.

The reference is batch only. Because every cleaning step is a per-row
projection, the batch operators apply unchanged to a streaming DataFrame;
only the roll-ups need streaming state, kept as running sums and counts.
"""

from .observations import latest_rollup, observation_stream, start_rollups, streaming_rollups

__all__ = ["observation_stream", "streaming_rollups", "start_rollups", "latest_rollup"]
