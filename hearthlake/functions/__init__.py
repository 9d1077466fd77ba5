"""Column -> Column building blocks, all built from Spark's own functions."""

from hearthlake.functions.geo import haversine_km, normalize_continent, normalize_country
from hearthlake.functions.masking import mask_address, mask_email, mask_phone, mask_pii, register_sql_functions
from hearthlake.functions.text import chunk_sentences, clean_review_text, lexicon_score
from hearthlake.functions.dates import day_of, week_end, week_start

__all__ = [
    "haversine_km", "normalize_continent", "normalize_country",
    "mask_address", "mask_email", "mask_phone", "mask_pii", "register_sql_functions",
    "chunk_sentences", "clean_review_text", "lexicon_score",
    "day_of", "week_end", "week_start",
]
