from .load import StreamCounters, stream_load, stream_statements, stream_stats

__all__ = ["StreamCounters", "stream_load", "stream_statements", "stream_stats"]
