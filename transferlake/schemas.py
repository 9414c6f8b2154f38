"""Declared schemas and fixed values.

Fixed values (must equal the behaviour being rebuilt; kept together, in natural order):
  landing CSV columns (positional): tx_id, sender_id, receiver_id, amount, currency, status, timestamp
  topic payload: tx_id, status STRING, amount DOUBLE, timestamp LONG, receiver_id STRING, currency STRING
  (tx_id was INT; it is BIGINT here, since the publisher's running number has no upper end)
  status values replaced by 'Unknown' after trimming: '', 'N/A', 'NULL', 'null'
  status values the original job effectively replaces (its list runs after trimming, so its
  padded spellings never match): '', 'N/A', 'NULL'
  sliding window 10 minutes, slide 1 minute, watermark 15 minutes
  large-transfer alert threshold 50000
"""

LANDING_DDL = ("tx_id STRING, sender_id STRING, receiver_id STRING, amount STRING, "
               "currency STRING, status STRING, timestamp LONG")

EVENT_DDL = ("tx_id BIGINT, status STRING, amount DOUBLE, timestamp LONG, "
             "receiver_id STRING, currency STRING")

PUBLISHED_FIELDS = ["tx_id", "status", "amount", "timestamp", "receiver_id", "currency", "sender_id"]

GOOD_COLUMNS = ["tx_id", "sender_id", "receiver_id", "amount", "currency", "status", "timestamp"]

# Amounts are summed as DECIMAL(28, scale); anything from this bound on is rejected.
AMOUNT_BOUND = 1e24

UNKNOWN_STATUS = "Unknown"
STATUS_SENTINELS = ["", "N/A", "NULL", "null"]
ORIGINAL_EFFECTIVE_SENTINELS = ["", "N/A", "NULL"]

WINDOW_DURATION = "10 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK_DELAY = "15 minutes"
LARGE_TRANSFER_THRESHOLD = 50000.0

# Reject reasons, in the order they are reported.
REJECT_REASONS = [
    "amount_missing",
    "amount_unparsable",
    "amount_not_finite",
    "amount_not_positive",
    "amount_above_bound",
    "status_missing",
    "status_unknown",
    "timestamp_missing",
    "timestamp_not_after_epoch",
    "timestamp_after_bound",        # only with an explicit upper bound (off by default)
]

STATS_KEY = ["window_start", "window_end", "status", "currency"]

STATS_TABLE_DDL = ("window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, status STRING, "
                   "total_sum DOUBLE, tx_count BIGINT, currency STRING")
