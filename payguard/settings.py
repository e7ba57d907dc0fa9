"""Constants of the domain. Jobs take them as default arguments."""

from __future__ import annotations

# Statuses, messages, thresholds and names that results depend on.
ACCEPTED = "ACCEPTED"
REJECTED_DUPLICATE = "REJECTED_DUPLICATE"
REJECTED_INVALID = "REJECTED_INVALID"
DUPLICATE_REASON = "Duplicate idempotency key detected"
REGISTRY_PREFIX = "idem:"
TTL_SECONDS = 86_400
KEY_BUCKET_SECONDS = 300
TOPIC_RETENTION_SECONDS = 604_800
SLA_MS = 50
REVIEW_THRESHOLD = 3
RATE_BAND_RED = 16
RATE_BAND_YELLOW = 14
HISTOGRAM_BINS = 30
FLAGGED_TOP = 10
BRONZE_LABEL = "Bronze (Raw Events)"
SILVER_LABEL = "Silver (Decisions)"
PIPELINE_MERCHANT = "merchant_duplicate_rate_hourly"
PIPELINE_SLA = "sla_compliance_hourly"
PIPELINE_CUSTOMER = "customer_retry_patterns_daily"
PIPELINE_SYSTEM = "system_summary_daily"
PIPELINE_UNIQUES = "unique_counts_daily"
PIPELINES = (PIPELINE_MERCHANT, PIPELINE_SLA, PIPELINE_CUSTOMER, PIPELINE_SYSTEM)
# A micro-batch takes at most so much of a backlog.
MAX_MESSAGES_PER_TRIGGER = 2_000_000
MAX_FILES_PER_TRIGGER = 200
TOPIC_RAW = "payments.raw"
TOPIC_DECISIONS = "payments.decisions"
TOPIC_DEADLETTER = "payments.deadletter"

# Total order in which events of one key reached the engine. Columns a frame
# lacks are left out; payment_id makes the order total.
ARRIVAL_ORDER = ("ingested_at", "kafka_partition", "kafka_offset", "payment_id")

# A key with more rows than this is handled without ever gathering its rows. Below
# it a fold holds the rows of one key, and of up to 128 keys while it aggregates.
HOT_KEY_ROWS = 10_000
# A flagged-key table up to this many rows may be broadcast (about 100 bytes a row).
BROADCAST_ROWS = 200_000
# Buckets of the index of decided payment ids; thousands for a long history and small batches.
INDEX_BUCKETS = 64
# Rows of one key that the stateful job sorts in one batch; above it the registry job is the one to run.
STATE_ROWS_PER_KEY = 1_000_000
# State values of an operator of the stateful job, each with the entries of many keys; more for a long history and small batches.
STATE_BUCKETS = 4_096
