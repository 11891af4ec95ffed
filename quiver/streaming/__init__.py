"""Incremental (Structured Streaming) form of the follower count."""

from quiver.streaming.followers import follower_count_stream, start_follower_count

__all__ = ["follower_count_stream", "start_follower_count"]
