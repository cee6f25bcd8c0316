"""The incremental form: Structured Streaming over the batch operators."""

from .streams import (
    StreamSink,
    read_stream,
    stream_dedup,
    stream_publish,
    transform_stream,
)

__all__ = ["StreamSink", "read_stream", "stream_dedup", "stream_publish", "transform_stream"]
