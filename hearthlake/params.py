"""Business parameters of the retail lakehouse.

Everything here is a plain value so callers can override it per run; the
functions in ``operators`` take these as keyword arguments with the values
below as defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must stay equal to the original business rules, or the
# datasets stop matching the published definitions.
# ---------------------------------------------------------------------------

# Review lexicon (a chunk matching any positive word scores +1, else any
# negative word -1, else 0; matching is an unanchored substring regex).
POSITIVE_WORDS = ("great", "excellent", "love", "amazing", "good", "friendly", "fresh", "delicious", "perfect", "best")
NEGATIVE_WORDS = ("bad", "terrible", "awful", "slow", "cold", "stale", "poor", "worst", "disappoint", "rude")

# Ingredient criticality (lower-cased ingredient name -> score); anything else scores 2.
CRITICAL_INGREDIENTS = ("cacao", "cocoa butter", "cane sugar", "vanilla", "oats")  # score 5
IMPORTANT_INGREDIENTS = ("almonds", "hazelnuts", "pecans", "pistachios", "coffee")  # score 3
CRITICAL_SCORE = 5
IMPORTANT_SCORE = 3
DEFAULT_CRITICALITY = 2

# Supplier risk thresholds.
MANY_DEPENDANTS = 3
FAR_DISTANCE_KM = 5000.0
EARTH_RADIUS_KM = 6371.0

# Country / continent canonicalisation.
UNITED_STATES_ALIASES = ("US", "USA")
UNITED_STATES = "United States"
CONTINENT_NAMES = (
    (("north america", "northamerica"), "North America"),
    (("south america",), "South America"),
    (("oceania",), "Oceania"),
    (("asia",), "Asia"),
    (("europe",), "Europe"),
    (("africa",), "Africa"),
)

# Supplier approval flag value (compared after upper(trim(...))).
APPROVED_STATUS = "Y"

# Masking.
MASK = "***"
PHONE_MASK = "****"
ADDRESS_VISIBLE_CHARS = 6
PII_VISIBLE_CHARS = 2

# Forecast job.
FORECAST_HORIZON_DAYS = 14
TEST_DAYS = 7
SHORT_SPAN_DAYS = 14  # spans up to this many days use a third of the span as holdout
MIN_HOLDOUT_DAYS = 3
RANDOM_SEED = 42

# Candidate grid of the tuning step, evaluated in this order; the first
# candidate with the strictly lowest holdout RMSE wins.
DEFAULT_CANDIDATES = (
    {"algorithm": "gbt", "maxIter": 120, "maxDepth": 4, "stepSize": 0.05, "maxBins": 64},
    {"algorithm": "gbt", "maxIter": 180, "maxDepth": 5, "stepSize": 0.03, "maxBins": 64},
    {"algorithm": "gbt", "maxIter": 140, "maxDepth": 6, "stepSize": 0.04, "maxBins": 128},
    {"algorithm": "rf", "numTrees": 250, "maxDepth": 8, "featureSubsetStrategy": "auto"},
    {"algorithm": "rf", "numTrees": 400, "maxDepth": 10, "featureSubsetStrategy": "sqrt"},
)

FEATURE_COLUMNS = (
    "store_id_ohe",
    "day_of_week",
    "day_of_month",
    "month",
    "week_of_year",
    "is_weekend",
    "trend_index",
    "lag_1",
    "lag_7",
    "rolling_mean_3",
    "rolling_mean_7",
    "rolling_std_7",
)

# ---------------------------------------------------------------------------
# Own values, free to change.
# ---------------------------------------------------------------------------

# A reduced grid with the same shape (both algorithms), for tests and smoke runs.
SMALL_CANDIDATES = (
    {"algorithm": "gbt", "maxIter": 8, "maxDepth": 3, "stepSize": 0.1, "maxBins": 32},
    {"algorithm": "rf", "numTrees": 8, "maxDepth": 5, "featureSubsetStrategy": "sqrt"},
)
