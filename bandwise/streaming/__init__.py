"""Structured Streaming: fitted score bands applied to a stream of new scores.

The reference itself only reads batches; this package re-expresses the
test-set banding (train edges applied to new rows) over a streaming source.
"""

from bandwise.streaming.bands import band_monitor, stream_band_counts

__all__ = ["band_monitor", "stream_band_counts"]
