"""Generic operators: sinks, control table, staging, set ops, quality, privacy."""

from dayledger.operators import privacy, quality, setops, sinks, staging, watermarks

__all__ = ["privacy", "quality", "setops", "sinks", "staging", "watermarks"]
