"""Structured Streaming: online learning and scoring on a stream (H1, H2)."""

from widetab.streaming.online_stream import (  # noqa: F401
    apply_batch, compact, latest_version, read_state, stream_fit, stream_score,
)
