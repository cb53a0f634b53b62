"""Replay of a fetch log as a stream: per-minute counters and keyed state machines."""
