"""Declared schemas (no inference on the hot path)."""

from pyspark.sql import types as T

_S = T.StringType()

# Raw article: the wide form (title/pub_date are absent in the narrow form -> null).
RAW_FIELDS = ("title", "summary", "content", "pub_date", "category", "url", "source", "scraped_at")
RAW = T.StructType([T.StructField(f, _S) for f in RAW_FIELDS])
RAW_WITH_CORRUPT = T.StructType(RAW.fields + [T.StructField("_corrupt_record", _S)])
# fields whose text is cleaned: anything but a text or null there makes the row unusable
TEXT_FIELDS = ("title", "summary", "content")
