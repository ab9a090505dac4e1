from .releases import incremental_stream, keyed_stream

__all__ = ["incremental_stream", "keyed_stream"]
