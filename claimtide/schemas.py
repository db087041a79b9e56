"""Schemas, column types and the fixed business values of the claim model.

Everything here is plain data. The values under ``FIXED VALUES`` must equal
the ones of the source project, otherwise classifications, keys and report
orderings differ; they are listed as text, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column types
# --------------------------------------------------------------------------

#: trailer value after the safe numeric cast: 29 whole digits, 9 decimals.
VALUE_TYPE = T.DecimalType(38, 9)
#: values that Spark's own arithmetic keeps at scale 9: (28,9) x (18,9) ->
#: (38,9), (28,9) - (28,9) -> (29,9).  For wider ones see ``functions.money``.
NARROW_TYPE = T.DecimalType(28, 9)
#: currency conversion rate.
RATE_TYPE = T.DecimalType(18, 9)
#: value converted to USD (result type of VALUE_TYPE x RATE_TYPE).
USD_TYPE = T.DecimalType(38, 9)

# --------------------------------------------------------------------------
# Raw snapshot history
# --------------------------------------------------------------------------

#: the 19 source columns staging reads, in source order.  Read them as strings
#: (or as dates/numbers where the store has typed them); staging safe-casts.
RAW_COLUMNS = (
    "claim_number",
    "snapshot_date",
    "carrier_name",
    "country",
    "status",
    "reason",
    "results",
    "insurance_claims_results",
    "source",
    "trailer_license_plate",
    "trailer_number",
    "trailer_vin",
    "currency",
    "submitted",
    "date_of_loss",
    "dropped_off_date",
    "case_date_closed",
    "last_seen_date",
    "value_of_trailer",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

#: string dimensions that staging trims, in staged column order.
TEXT_DIMENSIONS = (
    "carrier_name",
    "country",
    "status",
    "reason",
    "results",
    "insurance_claims_results",
    "source",
    "trailer_license_plate",
    "trailer_number",
    "trailer_vin",
)

#: staged date columns and the raw column each is read from.
STAGED_DATES = (
    ("submitted_date", "submitted"),
    ("date_of_loss", "date_of_loss"),
    ("dropped_off_date", "dropped_off_date"),
    ("case_date_closed", "case_date_closed"),
    ("last_seen_date", "last_seen_date"),
)

STAGED_COLUMNS = (
    "claim_number",
    "snapshot_date",
    *TEXT_DIMENSIONS,
    "currency",
    *(name for name, _ in STAGED_DATES),
    "value_of_trailer",
)

CURRENCY_SCHEMA = T.StructType(
    [
        T.StructField("currency_code", T.StringType(), True),
        T.StructField("currency_name", T.StringType(), True),
        T.StructField("rate_to_usd", RATE_TYPE, True),
    ]
)

CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("sort_order", T.IntegerType(), True),
        T.StructField("display_label", T.StringType(), True),
        T.StructField("indent_level", T.IntegerType(), True),
        T.StructField("tier1_filter", T.StringType(), True),
        T.StructField("tier_match_value", T.StringType(), True),
    ]
)

#: metric-mart dimension columns after the period columns.
METRIC_DIMENSIONS = (
    "source",
    "carrier_name",
    "country",
    "status",
    "wbr_tier1",
    "wbr_tier2",
    "wbr_tier3",
)

# ==========================================================================
# FIXED VALUES — must equal the source project's values.
# ==========================================================================

STATUS_OPEN = "Open"
STATUS_CLOSED = "Closed"
ACCEPTED_STATUSES = ("Open", "Closed")

DEFAULT_CURRENCY = "USD"

# Tier 1 classes
TIER1_ACTIVE = "ACTIVE CASES"
TIER1_CLOSED = "CLOSED CASES"
TIER1_REOPENED = "RE-OPEN CLAIMS"
TIER1_VALUES = ("ACTIVE CASES", "CLOSED CASES", "RE-OPEN CLAIMS")

# Tier 2 classes
TIER2_REOPENED = "Re-Opened"
TIER2_WAITING = "Waiting For Reply From Insurance"
TIER2_IN_PROCESS = "In Process - Investigating"
TIER2_FOUND_RETURNED = "Found And Returned"
TIER2_NOT_FOUND = "Not Found"

# Tier 3 classes
TIER3_FOUND = "Found"
TIER3_POTENTIAL_CLAIM = "Not Found / Potential Claim"
TIER3_NOT_IN_NETWORK = "Not In Network"
TIER3_CARRIER_PICKED_UP = "Carrier Picked Up"
TIER3_TOWING_YARD = "Found -Sent To Towing Yard"
TIER3_RECOVERED = "Found - Recovered"
TIER3_NO_RESPONSE = "Not Liable Due To No Response"
TIER3_NOT_LIABLE = "Not Liable"
TIER3_LIABLE = "Liable"

# Source values that steer the classification
REASON_FOUND = "Found"
REASON_NO_DATA = "No Data Found On Amazon Network"
REASON_NOT_IN_NETWORK = "No Longer In Network"
ICR_WAITING = "Waiting For Reply"
ICR_NOT_LIABLE = "Amazon Not Liable"
RESULT_CARRIER_PICKED_UP = "Carrier Has & Picked Up"
RESULT_TOWING_YARD = "Found -Sent To Towing Yard"
RESULT_RECOVERED = "Found & Recovered"
RESULT_NO_RESPONSE = "No Response From Carrier To 10-Day Closing Letter"

# Transition types
NEW_CLAIM = "NEW_CLAIM"
NO_CHANGE = "NO_CHANGE"
OPEN_TO_CLOSED = "OPEN_TO_CLOSED"
CLOSED_TO_OPEN = "CLOSED_TO_OPEN"
STATUS_CHANGED = "STATUS_CHANGED"
TRANSITION_TYPES = ("NEW_CLAIM", "NO_CHANGE", "OPEN_TO_CLOSED", "CLOSED_TO_OPEN", "STATUS_CHANGED")
CHANGE_TRANSITION_TYPES = ("OPEN_TO_CLOSED", "CLOSED_TO_OPEN", "STATUS_CHANGED")

# Currency seed: code, name, rate to USD
CURRENCY_RATES = (
    ("USD", "US Dollar", "1.00"),
    ("CAD", "Canadian Dollar", "0.70"),
)

# Category hierarchy seed: sort_order, display_label, indent_level,
# tier1_filter, tier_match_value (None on tier-1 rows)
CATEGORY_HIERARCHY = (
    (1, "ACTIVE CASES", 0, "ACTIVE CASES", None),
    (2, "  In Process - Investigating", 1, "ACTIVE CASES", "In Process - Investigating"),
    (3, "  Waiting For Reply From Insurance", 1, "ACTIVE CASES", "Waiting For Reply From Insurance"),
    (4, "    Found", 2, "ACTIVE CASES", "Found"),
    (5, "    Not Found / Potential Claim", 2, "ACTIVE CASES", "Not Found / Potential Claim"),
    (6, "    Not In Network", 2, "ACTIVE CASES", "Not In Network"),
    (7, "CLOSED CASES", 0, "CLOSED CASES", None),
    (8, "  Found And Returned", 1, "CLOSED CASES", "Found And Returned"),
    (9, "    Carrier Picked Up", 2, "CLOSED CASES", "Carrier Picked Up"),
    (10, "    Found -Sent To Towing Yard", 2, "CLOSED CASES", "Found -Sent To Towing Yard"),
    (11, "    Found - Recovered", 2, "CLOSED CASES", "Found - Recovered"),
    (12, "    Not Liable Due To No Response", 2, "CLOSED CASES", "Not Liable Due To No Response"),
    (13, "  Not Found", 1, "CLOSED CASES", "Not Found"),
    (14, "    Not Liable", 2, "CLOSED CASES", "Not Liable"),
    (15, "    Liable", 2, "CLOSED CASES", "Liable"),
    (16, "RE-OPEN CLAIMS", 0, "RE-OPEN CLAIMS", None),
)

# Review waterfall: a node's order is its hierarchy sort_order x 100 and its
# indent the hierarchy indent_level (see ``waterfall_positions``).  Nodes that
# are not in the hierarchy fall back by their tier-1 class, else to 9000.
WATERFALL_ORDER_STEP = 100
WATERFALL_FALLBACK_ORDER = (
    ("ACTIVE CASES", 650),
    ("CLOSED CASES", 1550),
    ("RE-OPEN CLAIMS", 1700),
)
WATERFALL_UNKNOWN_ORDER = 9000
WATERFALL_INDENT_SPACES = 4
NBSP = " "
ROW_KEY_SEPARATOR = "|||"
SORT_KEY_SEPARATOR = "|"

# Display-name abbreviations kept upper case in extract headers
HEADER_ABBREVIATIONS = (("id", "ID"), ("usd", "USD"), ("vin", "VIN"), ("wbr", "WBR"))

# KPI cards: label, tier-1 class (None = claim value over all classes)
KPI_CARDS = (
    ("Active claims", "ACTIVE CASES"),
    ("Closed claims", "CLOSED CASES"),
    ("Re-opened claims", "RE-OPEN CLAIMS"),
)
KPI_VALUE_CARD = "Claim value"

# Surrogate-key placeholder for null parts (public generic-key convention)
SURROGATE_NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# The six marts and their table names
MART_TABLES = (
    ("current", "mart_claims_current"),
    ("weekly", "mart_claims_weekly"),
    ("weekly_transitions", "mart_claim_transitions_weekly"),
    ("weekly_metrics", "mart_claims_weekly_metrics"),
    ("monthly", "mart_claims_monthly"),
    ("monthly_metrics", "mart_claims_monthly_metrics"),
)

# Output columns of the transitions mart, in order
TRANSITION_COLUMNS = (
    "claim_snapshot_key",
    "claim_number",
    "snapshot_date",
    "week_start_date",
    "week_end_date",
    "report_year",
    "report_week",
    "previous_status",
    "current_status",
    "transition_type",
    "previous_wbr_tier1",
    "wbr_tier1",
    "wbr_tier2",
    "wbr_tier3",
    "country",
    "carrier_name",
    "source",
    "submitted_date",
    "case_date_closed",
    "previous_value_usd",
    "value_usd",
    "week_over_week_value_delta_usd",
)

# ==========================================================================
# End of fixed values
# ==========================================================================


def waterfall_positions() -> dict[str, tuple[int, int]]:
    """Node name -> (order, indent), derived from the category hierarchy."""
    positions = {}
    for sort_order, _label, indent, tier1, match in CATEGORY_HIERARCHY:
        positions[match if match is not None else tier1] = (
            sort_order * WATERFALL_ORDER_STEP,
            indent,
        )
    return positions
