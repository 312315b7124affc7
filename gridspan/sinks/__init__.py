from gridspan.sinks.store import Store

__all__ = ["Store"]
