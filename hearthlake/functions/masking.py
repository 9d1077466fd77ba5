"""PII masking expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlake import params


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_email(c) -> Column:
    """Lower-case, keep the first character and everything from the last '@'.

    ``Ann@X.com`` -> ``a***@x.com``. A value without a character before an '@'
    comes back unchanged (only lower-cased).
    """
    return F.regexp_replace(F.lower(_col(c)), r"(^.).*(@.*$)", "$1" + params.MASK + "$2")


def mask_phone(c) -> Column:
    """Keep up to three leading and the two final digits of the last digit run."""
    return F.regexp_replace(_col(c), r"(\d{0,3})\d+(\d{2})$", "$1" + params.PHONE_MASK + "$2")


def mask_address(c) -> Column:
    """First six characters followed by the mask; NULL stays NULL."""
    return F.concat(F.substring(_col(c), 1, params.ADDRESS_VISIBLE_CHARS), F.lit(params.MASK))


def mask_pii(c, is_admin) -> Column:
    """Generic mask: admins see the value, everyone else two characters + mask.

    ``is_admin`` is a Python bool or a boolean Column (e.g. derived from the
    caller's group membership); group lookup itself is the platform's job.
    """
    value = _col(c)
    admin = is_admin if isinstance(is_admin, Column) else F.lit(bool(is_admin))
    return (F.when(admin, value)
            .when(value.isNull(), F.lit(None).cast("string"))
            .otherwise(F.concat(F.substring(value, 1, params.PII_VISIBLE_CHARS), F.lit(params.MASK))))


def register_sql_functions(spark) -> None:
    """Make ``mask_pii(value [, is_admin])`` callable from SQL.

    With one argument the session variable ``pii_admin`` decides (false unless
    the platform sets it for the user's group: ``SET VAR pii_admin = true``).
    A temporary SQL-bodied function: Spark inlines the body into the query
    plan (no Python in the loop), so SQL users get the same expression as
    ``mask_pii`` above.
    """
    spark.sql("DECLARE OR REPLACE VARIABLE pii_admin BOOLEAN DEFAULT false")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION mask_pii(value STRING, is_admin BOOLEAN DEFAULT CAST(NULL AS BOOLEAN))
        RETURNS STRING
        RETURN CASE WHEN coalesce(is_admin, session.pii_admin) THEN value
                    WHEN value IS NULL THEN NULL
                    ELSE concat(substr(value, 1, {params.PII_VISIBLE_CHARS}), '{params.MASK}') END""")
