"""Column masks. NULL stays NULL; every mask is a plain expression, so scans keep their pushdown."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# The masks' output formats.
HIDDEN = "****"
PHONE_PREFIX = "XXX-XXX-"
PHONE_HIDDEN = "XXX-XXX-XXXX"
POSTAL_SUFFIX = "***"


def mask_email(value: Column) -> Column:
    """Keep the domain of an address that has exactly one `@`."""
    text = value.cast("string")
    signs = F.length(text) - F.length(F.replace(text, F.lit("@"), F.lit("")))
    masked = F.concat(F.lit(f"{HIDDEN}@"), F.substring_index(text, "@", -1))
    return F.when(text.isNotNull(), F.when(signs == 1, masked).otherwise(HIDDEN))


def mask_phone(value: Column) -> Column:
    """Keep the last four characters."""
    text = value.cast("string")
    masked = F.concat(F.lit(PHONE_PREFIX), F.right(text, F.lit(4)))
    return F.when(text.isNotNull(), F.when(F.length(text) >= 4, masked).otherwise(PHONE_HIDDEN))


def mask_name(value: Column) -> Column:
    """Keep the first character."""
    return F.concat(F.left(value.cast("string"), F.lit(1)), F.lit(HIDDEN))


def mask_address(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit(HIDDEN))


def mask_postal_code(value: Column) -> Column:
    """Keep the first three characters of a code longer than three."""
    text = value.cast("string")
    masked = F.concat(F.left(text, F.lit(3)), F.lit(POSTAL_SUFFIX))
    return F.when(text.isNotNull(), F.when(F.length(text) > 3, masked).otherwise(HIDDEN))


MASKS = {
    "mask_email": mask_email,
    "mask_phone": mask_phone,
    "mask_name": mask_name,
    "mask_address": mask_address,
    "mask_postal_code": mask_postal_code,
}

# The same masks as SQL expressions over a parameter `v`, for use in SQL text.
_SQL_BODIES = {
    "mask_email": f"CASE WHEN v IS NULL THEN NULL WHEN length(v) - length(replace(v, '@', '')) = 1 "
    f"THEN '{HIDDEN}@' || substring_index(v, '@', -1) ELSE '{HIDDEN}' END",
    "mask_phone": f"CASE WHEN v IS NULL THEN NULL WHEN length(v) >= 4 "
    f"THEN '{PHONE_PREFIX}' || right(v, 4) ELSE '{PHONE_HIDDEN}' END",
    "mask_name": f"left(v, 1) || '{HIDDEN}'",
    "mask_address": f"CASE WHEN v IS NOT NULL THEN '{HIDDEN}' END",
    "mask_postal_code": f"CASE WHEN v IS NULL THEN NULL WHEN length(v) > 3 "
    f"THEN left(v, 3) || '{POSTAL_SUFFIX}' ELSE '{HIDDEN}' END",
}


def register_masks(spark: SparkSession) -> list[str]:
    """Create the masks as temporary SQL functions (expressions, not UDFs) and return their names."""
    for name, body in _SQL_BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS STRING RETURN {body}")
    return list(_SQL_BODIES)
