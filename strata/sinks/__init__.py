"""Sinks: layer writes, publishing, single-file export."""
