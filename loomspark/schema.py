"""The record: what every source is normalized to. Ordinals make row order explicit."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))

#: Where a row stands: source in the configuration, file in the source, row in the file (1-based).
ORDINAL = ["source_index", "file_index", "row_offset"]

RECORD = T.StructType(
    [
        T.StructField("source_index", T.IntegerType()),
        T.StructField("file_index", T.IntegerType()),
        T.StructField("row_offset", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("messages", MESSAGES),
    ]
)

# Reject reasons, in the order in which they are decided.
REASONS = ["empty", "too_short", "too_long", "lock_file", "minified", "weird_chars", "binary_or_base64", "secret"]
NORMALIZE_FAILED, EMPTY_TOKENS = "normalize_failed", "empty_tokens"
