"""Configuration values.

The constants in the first block are FIXED VALUES: they must equal the values the
original pipeline uses, otherwise results differ. Everything else is a tunable default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline for identical results)
# ---------------------------------------------------------------------------
# Event names whose rows name a product directly (group 1) ...
GROUP1_EVENTS = (
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
)
# ... and the recommendation click, whose product is in viewing_product_id (group 2).
GROUP2_EVENTS = ("product_view_all_recommend_clicked",)
# Name used when a page has neither a heading span nor an og:title.
UNKNOWN_NAME = "Unknown name"
# Location fields holding one of these (exact case, after strip) are "missing".
LOCATION_MISSING_MARKERS = ("-", "", "n/a", "N/A")
# Country text returned for an address that cannot be looked up.
INVALID_ADDRESS_TEXT = "INVALID IP ADDRESS"
# Columns forced to string (null -> '') before export.
FORCE_STRING_COLUMNS = ("cat_id", "is_paypal")
# Part size of the incremental export and batch size of the capture loop.
EXPORT_CHUNK_SIZE = 250_000
CAPTURE_BATCH_SIZE = 100
# Insert batch of the IP job.
IP_INSERT_BATCH = 10_000
# Attempts per page and retry rounds of the capture loop.
MAX_ATTEMPTS = 3
MAX_ROUNDS = 3
# Outcome classes, in report order.
STATUSES = ("success", "err_404", "err_403", "err_429", "err_5xx", "err_network", "err_other")
# Statuses that finish an item: it is never fetched again.
FINAL_STATUSES = ("success", "err_404")
# Error messages per outcome class.
MSG_404 = "Page Not Found"
MSG_403 = "Forbidden"
MSG_429 = "Rate limit"
# Product data-quality reasons, in rule order.
PRODUCT_REASONS = ("missing_id", "missing_name", "missing_url", "valid")
# Location data-quality reasons, in rule order.
LOCATION_REASONS = ("missing_ip", "missing_location_info", "invalid_ip", "valid")
# ---------------------------------------------------------------------------


# Budget for broadcasting a key set checked by count (finished ids, merge source keys);
# bytes per key is a generous allowance for a short string key plus hash-table overhead.
BROADCAST_LIMIT_BYTES = 64 << 20
ID_BYTES = 64


@dataclass(frozen=True)
class CaptureConfig:
    """Parameters of candidate selection (event groups and test-site URL markers)."""

    group1: tuple[str, ...] = GROUP1_EVENTS
    group2: tuple[str, ...] = GROUP2_EVENTS
    # Case-sensitive substrings marking staging/test URLs. The original hard-codes two
    # site-specific host fragments; ours is a parameter, empty by default.
    url_markers: tuple[str, ...] = ()
    max_attempts: int = MAX_ATTEMPTS


@dataclass(frozen=True)
class ExportConfig:
    key: str = "_id"
    chunk_size: int = EXPORT_CHUNK_SIZE
    force_string: tuple[str, ...] = FORCE_STRING_COLUMNS
    # Range partitions used for ordered numbering; None = spark.sql.shuffle.partitions.
    num_partitions: int | None = None


@dataclass(frozen=True)
class ProfileConfig:
    key: str = "_id"
    blank_cols: tuple[str, ...] = ("user_id_db", "device_id")
    pct_cols: tuple[str, ...] = ("user_id_db",)
    distinct_cols: tuple[str, ...] = ("device_id", "store_id", "api_version")
    zero_cols: tuple[str, ...] = ("price",)
    approximate: bool = False
    # relative standard deviation of the HyperLogLog sketches when approximate
    rsd: float = 0.05
    extra: dict = field(default_factory=dict)


# Test-fixture URL markers (the staging and test hosts of FIXTURES.md).
FIXTURE_URL_MARKERS = ("stage.shop", "test.shop")
