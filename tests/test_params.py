"""The business rules' fixed values, written out once more, so that a slip in ``params`` shows."""

from hearthlake import params


def test_fixed_values():
    # Fixed values.
    assert params.POSITIVE_WORDS == ("great", "excellent", "love", "amazing", "good", "friendly", "fresh", "delicious",
                                     "perfect", "best")
    assert params.NEGATIVE_WORDS == ("bad", "terrible", "awful", "slow", "cold", "stale", "poor", "worst", "disappoint",
                                     "rude")
    assert params.CRITICAL_INGREDIENTS == ("cacao", "cocoa butter", "cane sugar", "vanilla", "oats")
    assert params.IMPORTANT_INGREDIENTS == ("almonds", "hazelnuts", "pecans", "pistachios", "coffee")
    assert (params.CRITICAL_SCORE, params.IMPORTANT_SCORE, params.DEFAULT_CRITICALITY) == (5, 3, 2)
    assert (params.MANY_DEPENDANTS, params.FAR_DISTANCE_KM, params.EARTH_RADIUS_KM) == (3, 5000.0, 6371.0)
    assert params.UNITED_STATES_ALIASES == ("US", "USA") and params.UNITED_STATES == "United States"
    assert params.CONTINENT_NAMES == (
        (("north america", "northamerica"), "North America"), (("south america",), "South America"),
        (("oceania",), "Oceania"), (("asia",), "Asia"), (("europe",), "Europe"), (("africa",), "Africa"))
    assert params.APPROVED_STATUS == "Y"
    assert (params.MASK, params.PHONE_MASK, params.ADDRESS_VISIBLE_CHARS, params.PII_VISIBLE_CHARS) == ("***", "****", 6, 2)
    assert (params.FORECAST_HORIZON_DAYS, params.TEST_DAYS, params.SHORT_SPAN_DAYS, params.MIN_HOLDOUT_DAYS) == (14, 7, 14, 3)
    assert params.RANDOM_SEED == 42
    assert [tuple(sorted(c.items())) for c in params.DEFAULT_CANDIDATES] == [tuple(sorted(c.items())) for c in (
        {"algorithm": "gbt", "maxIter": 120, "maxDepth": 4, "stepSize": 0.05, "maxBins": 64},
        {"algorithm": "gbt", "maxIter": 180, "maxDepth": 5, "stepSize": 0.03, "maxBins": 64},
        {"algorithm": "gbt", "maxIter": 140, "maxDepth": 6, "stepSize": 0.04, "maxBins": 128},
        {"algorithm": "rf", "numTrees": 250, "maxDepth": 8, "featureSubsetStrategy": "auto"},
        {"algorithm": "rf", "numTrees": 400, "maxDepth": 10, "featureSubsetStrategy": "sqrt"})]
