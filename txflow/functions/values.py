"""Fixed values.

These must equal the source pipeline's literals for the results to match, so they
are stated here plainly, in their natural order, in one place.
"""

# --- Fixed values: batch cleaning of raw transactions -------------------------
# city codes (after initcap) and their full names
CITY_NAMES = {
    "La": "Los Angeles",
    "Sf": "San Francisco",
    "Nyc": "New York",
}
# sentinels replaced by NULL in every string column, in this order
SENTINELS_FIRST = ["N/a\t", "Tech\t", "\t"]
SENTINELS = ["N/a", "Unknown\t", "Unknown", "NULL", "\t"]
# extra sentinels replaced by NULL in category only
CATEGORY_BLANKS = ["", " ", "\t"]
# category whitelist as written (mixed case)
VALID_CATEGORIES = ["Retail", "Tech", "Food", "Finance", "Unknown", "NoName", "\t"]
# fill values
UNKNOWN_LABEL = "Unknown"
EPOCH_TEXT = "1970-01-01 00:00:00"

# --- Fixed values: summing view ------------------------------------------------
# normalised categories that mean "no category"
NO_CATEGORY = ["", "N/A", "NULL"]
NO_CATEGORY_LABEL = "UNKNOWN"

# --- Fixed values: message producer ------------------------------------------
PRODUCER_CATEGORIES = ["electro", "food", "auto", "beauty"]
PRODUCER_TYPES = ["transfer", "refund", "purchase"]
PRODUCER_CLASSES = ["standart", "premium", "vip"]

# --- Fixed values: streaming job ---------------------------------------------
WATERMARK_DELAY = "15 minutes"
SLIDING_WINDOW = "10 minutes"
SLIDING_SLIDE = "1 minute"
SUMMING_BUCKET = "10 minutes"
MAX_OFFSETS_PER_TRIGGER = 10000
ALERT_THRESHOLD = 10000.0
BIG_AMOUNT_THRESHOLD = 15000.0

# --- Fixed values: table maintenance -----------------------------------------
TARGET_FILE_BYTES = 134217728
RETAIN_LAST_VERSIONS = 5
USER_BUCKETS = 16
