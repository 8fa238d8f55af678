"""Incremental upkeep of the aggregate analyses over a growing file folder."""

from tripscope.streaming.incremental import read_latest, read_trip_stream, start_incremental

__all__ = ["read_latest", "read_trip_stream", "start_incremental"]
