"""Geography: name canonicalisation and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlake import params


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_country(c) -> Column:
    """'US'/'USA' (any case, padded) -> 'United States'; otherwise initcap(trim)."""
    trimmed = F.trim(_col(c))
    return (F.when(F.upper(trimmed).isin(*params.UNITED_STATES_ALIASES), F.lit(params.UNITED_STATES))
            .otherwise(F.initcap(trimmed)))


def normalize_continent(c) -> Column:
    """Known continent spellings to their canonical name; otherwise initcap(trim)."""
    trimmed = F.trim(_col(c))
    key = F.lower(trimmed)
    out = None
    for spellings, name in params.CONTINENT_NAMES:
        cond = key.isin(*spellings) if len(spellings) > 1 else key == spellings[0]
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.initcap(trimmed))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = params.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between two (lat, lon) points in degrees.

    The asin argument is clamped to 1 so antipodal points give pi*R instead
    of NaN from rounding noise; a NULL coordinate gives NULL (``least``
    would skip the NULL, so the clamp is a CASE).
    """
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    root = F.sqrt(a)
    return F.lit(2 * radius_km) * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))
