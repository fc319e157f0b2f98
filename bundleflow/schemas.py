"""Declared schemas of the tables the operators work on (never inferred)."""

from pyspark.sql import types as T

S = T.StringType()

REQUEST = T.StructType([
    T.StructField("name", S),
    T.StructField("orig_src", S),
    T.StructField("tx", S),
])

FILE_ENTRY = T.StructType([
    T.StructField("name", S),
    T.StructField("hash", S),
])

MANIFEST = T.StructType([
    T.StructField("job_id", S),
    T.StructField("name", S),
    T.StructField("source", S),
    T.StructField("type", S),
    T.StructField("files", T.ArrayType(FILE_ENTRY)),
])

MANIFEST_WITH_CORRUPT = T.StructType(MANIFEST.fields + [T.StructField("_corrupt_record", S)])

# Field order of one stage-log row, as written by both machines (fixed values).
LOG_FIELDS = ("ts", "tx", "name", "machine", "action", "status", "stage", "src", "dest", "msg")

LOG_RAW = T.StructType([T.StructField(f, S) for f in LOG_FIELDS])
LOG_RAW_WITH_CORRUPT = T.StructType(LOG_RAW.fields + [T.StructField("_corrupt_record", S)])

LEDGER = T.StructType([
    T.StructField("job_id", S),
    T.StructField("batch_id", T.LongType()),
])

ARRIVAL = T.StructType([
    T.StructField("path", S),
    T.StructField("is_dir", T.BooleanType()),
    T.StructField("event_kind", S),
    T.StructField("ts", T.TimestampType()),
])

SIZE_SAMPLE = T.StructType([
    T.StructField("target", S),
    T.StructField("ts", T.TimestampType()),
    T.StructField("size", T.LongType()),
])

FILE_LISTING = T.StructType([
    T.StructField("bundle", S),
    T.StructField("rel_path", S),
    T.StructField("path", S),
    T.StructField("length", T.LongType()),
    T.StructField("mtime", T.TimestampType()),
])
