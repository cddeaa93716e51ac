"""Names, labels, thresholds and patterns that results depend on.

Everything here is data, not logic. Changing a value changes results, so they are kept in one place.
"""

# Record fields in storage order: (name, stored type, required, must fit 32 bits).
RECORD_FIELDS = (
    ("question_id", "bigint", True, False),
    ("title", "string", True, False),
    ("link", "string", True, False),
    ("creation_date", "bigint", True, False),
    ("last_activity_date", "bigint", True, False),
    ("is_answered", "boolean", True, False),
    ("score", "bigint", True, True),
    ("answer_count", "bigint", True, True),
    ("view_count", "bigint", True, True),
    ("content_license", "string", False, False),
    ("closed_date", "bigint", False, False),
    ("closed_reason", "string", False, False),
    ("owner_user_id", "bigint", False, False),
    ("owner_display_name", "string", False, False),
)
INT32_MIN = -2147483648
INT32_MAX = 2147483647

# Epoch seconds that a record may carry: years 1 to 9999, what every store of timestamps can hold.
EPOCH_MIN = -62135596800
EPOCH_MAX = 253402300799
EPOCH_FIELDS = ("creation_date", "last_activity_date", "closed_date")

# Engagement labels and thresholds.
HIGH_ENGAGEMENT = "HIGH_ENGAGEMENT"
POSITIVE = "POSITIVE"
NEGATIVE = "NEGATIVE"
NEUTRAL = "NEUTRAL"
ENGAGEMENT_LABELS = (HIGH_ENGAGEMENT, POSITIVE, NEGATIVE, NEUTRAL)
HIGH_VIEWS = 1000
HIGH_ANSWERS = 5
POSITIVE_SCORE = 5

# Dead-letter reasons. The last four are this engine's own additions.
AVRO_ENCODE_FAILED = "avro_encode_failed"
PUBLISH_SCHEMA_REJECTED = "publish_schema_rejected"
PUBLISH_FAILED = "publish_failed"
MANUAL_BAD_MESSAGE = "manual_bad_message"
NORMALIZE_FAILED = "normalize_failed"
DECODE_FAILED = "decode_failed"
CONTRACT_FAILED = "contract_failed"
PAGE_MALFORMED = "page_malformed"

# Lower-cased error texts that mean "the topic rejected the schema": any group whose words all occur.
SCHEMA_REJECTION_WORDS = (
    ("schema", "validation"),
    ("invalid_binary_avro_message",),
    ("failed schema",),
)

# The injected bad record carries nothing but this title.
BAD_RECORD_TITLE = "bad message"

# Message id fallback prefix.
NO_ID_PREFIX = "no-id-"

# Lake partition columns, outermost first.
HOUR_COLUMNS = ("year", "month", "day", "hour")

# Row-count band accepted by the quality suites, and the tolerated non-null share when monitoring.
ROW_COUNT_MIN = 1
ROW_COUNT_MAX = 10_000_000
MONITORING_MOSTLY = 0.8

# Paging defaults.
DEFAULT_PAGE_SIZE = 10
DEFAULT_MAX_PAGES = 1000
