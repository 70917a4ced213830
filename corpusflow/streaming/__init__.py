"""The incremental state as streams."""
