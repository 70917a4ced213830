"""Operators over records: merging, joins, facets, incremental state, gates and samples."""
