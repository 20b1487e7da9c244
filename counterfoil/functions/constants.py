"""Fixed values that decide results: names, thresholds, defaults, model settings."""

# Model inputs, in the order the models see them.
FEATURE_COLUMNS = [
    "recency_days",
    "frequency_30d",
    "monetary_90d",
    "total_spend",
    "total_visits",
    "total_items",
    "avg_basket_value",
    "promo_ratio",
    "customer_segment_code",
]

# Customer segment -> ordinal code; any other segment gets UNKNOWN_SEGMENT.
SEGMENT_CODES = {
    "High Value": 3,
    "Frequent Shopper": 2,
    "Price Sensitive": 1,
    "Occasional": 0,
}
UNKNOWN_SEGMENT = -1

# Feature windows and the recency of a customer who never bought.
FREQUENCY_DAYS = 30
MONETARY_DAYS = 90
RECENCY_WITHOUT_HISTORY = 180

# Quadrants, decided by uplift first and control probability second.
PERSUADABLE = "Persuadal"
SLEEPING_DOG = "Sleeping Dog"
SURE_THING = "Sure Thing"
LOST_CAUSE = "Lost Cause"
UPLIFT_MARGIN = 0.05
SURE_PROBABILITY = 0.50

# Recommended actions.
DO_NOT_DISTURB = "SLEEPING DOG (DO NOT DISTURB)"
TARGET = "TARGET"
SKIP = "SKIP"

# Rounding of the published columns.
PROBABILITY_PLACES = 4
MONEY_PLACES = 2

# Campaign economics when nothing else is given.
DEFAULT_COGS_RATE = 0.60
DEFAULT_CAMPAIGN_COST = 0.50

# Hold-out shares, in percent.
TREATED_PERCENT = 80
TEST_PERCENT = 30

# Response window of a promotion and the size of the top-share policy.
LABEL_DAYS = 7
TOP_SHARE = "0.3"

# Model settings.
BOOSTED_TREES = {"maxIter": 100, "stepSize": 0.03, "maxDepth": 3, "seed": 42}
FOREST = {"numTrees": 100, "maxDepth": 4, "seed": 42}
