"""The detectors on a log that is still being written."""

from emberwall.streaming.detect import closed_windows, hot_sources, read_log_stream, window_stream

__all__ = ["closed_windows", "hot_sources", "read_log_stream", "window_stream"]
