"""Schemas, fixed values and key domains of the click log."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the original pipeline's values for equal
# results; they are stated here once, in natural order.
# ---------------------------------------------------------------------------
# Gap filler used when a key has no next click (seconds, added before the
# subtraction, so the last gap of a key is FILL_NEXT - epoch).
FILL_NEXT = 3_000_000_000
# Label / click id written on rows where the value does not exist.
MISSING = -1
# Label sentinel used by the early versions (uint8 255) and click id filler.
MISSING_LABEL_U8 = 255
MISSING_CLICK_ID_OLD = 999_999_999
# Bucket count of the hashed composite key.
HASH_BUCKETS = 2 ** 26
# Validation sizes used by the scripts (rows).
VAL_SIZE_FULL = 2_500_000
VAL_SIZE_DEBUG = 20_000
# Output float format of the submission file.
SUBMISSION_FLOAT_FORMAT = "%.9f"
# Threshold turning a probability into a hard label.
HARD_LABEL_THRESHOLD = 0.5
# Event type -> app code of the click view over the driver's `events` table.
APP_CODES = {"click": 0, "error": 1, "view": 2, "signup": 3}
APP_CODE_OTHER = 4
# ---------------------------------------------------------------------------

# Raw click log (train.csv / test.csv).  Spark has no unsigned types, so
# uint32 -> long, uint16 -> int.
TRAIN_SCHEMA = T.StructType([
    T.StructField("ip", T.LongType()),
    T.StructField("app", T.IntegerType()),
    T.StructField("device", T.IntegerType()),
    T.StructField("os", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("click_time", T.TimestampNTZType()),
    T.StructField("attributed_time", T.TimestampNTZType()),
    T.StructField("is_attributed", T.IntegerType()),
])

TEST_SCHEMA = T.StructType([
    T.StructField("click_id", T.LongType()),
    T.StructField("ip", T.LongType()),
    T.StructField("app", T.IntegerType()),
    T.StructField("device", T.IntegerType()),
    T.StructField("os", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
    T.StructField("click_time", T.TimestampNTZType()),
])

KEY_COLUMNS = ("ip", "app", "device", "os", "channel")
LABEL = "is_attributed"

# Largest number of distinct values a key column can take: calendar parts by
# construction, the id columns by the log's unsigned 16-bit contract (the
# source declares them uint16).  A key set whose
# domain product stays under the broadcast bound is joined by broadcast with
# a proven size; everything else is left to a shuffle join (AQE may still
# convert it at runtime once the real size is measured).
KEY_DOMAIN = {
    "app": 1 << 16, "device": 1 << 16, "os": 1 << 16, "channel": 1 << 16,
    "hour": 24, "day": 31, "minute": 60, "second": 60, "wday": 7,
}

# Broadcast bound in rows for a proven-small aggregate (a few MB).
MAX_BROADCAST_ROWS = 1 << 17
# At most this many hot keys are broadcast by the hot / cold split join, so
# the broadcast stays a fixed size however large the log grows.
MAX_HOT_KEYS = 1 << 17


def domain_rows(keys) -> int | None:
    """Upper bound of the number of groups for a key set, or None if unbounded."""
    total = 1
    for k in keys:
        d = KEY_DOMAIN.get(k)
        if d is None:
            return None
        total *= d
    return total
