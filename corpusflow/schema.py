"""Record types: every value of a paper is a string, lists are arrays, and `ord` keeps the order
of the input, which decides ties. Unknown fields of a record are kept in `extra`."""

from __future__ import annotations

from pyspark.sql import types as T

BASE_FIELDS = ("type", "key", "author", "booktitle", "title", "year", "abstract", "keywords", "url", "doi", "venue", "venue_track")
OPTIONAL_FIELDS = ("journal", "container", "source", "publisher", "openalex_id", "semantic_scholar_id")
FIELDS = (*BASE_FIELDS, *OPTIONAL_FIELDS)
LIST_FIELDS = ("labels", "pipeline_stages")
SOURCE_FIELDS = ("booktitle", "journal", "container", "source", "publisher")
LINK_FIELDS = ("url", "doi")

RAW = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
PAPER = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("map_key", T.StringType()),
        *RAW.fields,
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("pipeline_stages", T.ArrayType(T.StringType())),
        T.StructField("quality_flags", T.ArrayType(T.StringType())),
        T.StructField("relevance_level", T.StringType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)
STATE = T.StructType(
    [T.StructField(f, T.StringType()) for f in ("venue", "year", "source_type", "source", "track", "status", "last_attempt_at", "last_success_at", "rawdata_path", "sha256", "error")]
    + [T.StructField("record_count", T.LongType())]
)
ENTRY = T.StructType([T.StructField(f, T.StringType()) for f in ("title", "authors", "href", "doi")])
