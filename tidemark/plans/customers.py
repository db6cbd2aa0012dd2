"""Customer dimension: source table -> standard form -> type 2 history -> current state -> summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.hashing import record_hash
from tidemark.operators.common import col
from tidemark.operators.latest import dedupe_by_key
from tidemark.operators.protection import MaskedColumn, Policy
from tidemark.operators.scd import current_dimension, fold_scd2

# Column lists, history exclusions, tags, masks and policies of the customer dimension.
SOURCE_COLUMNS = (
    "customerID",
    "first_name",
    "last_name",
    "email_address",
    "phone_number",
    "address",
    "city",
    "state",
    "country",
    "continent",
    "postal_zip_code",
    "gender",
)
BUSINESS_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "full_name",
    "email_address",
    "phone_number",
    "address",
    "city",
    "state",
    "country",
    "continent",
    "postal_zip_code",
    "gender",
)
LINEAGE_COLUMNS = ("environment_name", "source_table_name")
STREAM_HISTORY_EXCEPT = ("ingestion_ts", "record_hash", "environment_name", "source_table_name")
SNAPSHOT_HISTORY_EXCEPT = ("snapshot_ts", "record_hash", "environment_name", "source_table_name")
GOVERNED_TAGS = {
    "sensitivity": ("pii", "restricted", "confidential"),
    "pii_type": ("email", "phone", "name", "address", "postal_code", "identifier"),
    "geo_region": ("true",),
    "quality_tier": ("gold",),
}
TABLE_TAGS = {"sensitivity": "pii", "quality_tier": "gold"}
COLUMN_TAGS = {
    "email_address": {"pii_type": "email", "sensitivity": "restricted"},
    "phone_number": {"pii_type": "phone", "sensitivity": "restricted"},
    "address": {"pii_type": "address", "sensitivity": "restricted"},
    "full_name": {"pii_type": "name", "sensitivity": "restricted"},
    "first_name": {"pii_type": "name", "sensitivity": "restricted"},
    "last_name": {"pii_type": "name", "sensitivity": "restricted"},
    "postal_zip_code": {"pii_type": "postal_code", "sensitivity": "confidential"},
    "country": {"geo_region": "true"},
    "state": {"geo_region": "true"},
    "continent": {"geo_region": "true"},
    "customer_id": {"pii_type": "identifier", "sensitivity": "confidential"},
}
COLUMN_MASKS = {
    "email_address": "mask_email",
    "phone_number": "mask_phone",
    "full_name": "mask_name",
    "first_name": "mask_name",
    "last_name": "mask_name",
    "address": "mask_address",
    "postal_zip_code": "mask_postal_code",
}
SECURED_COLUMNS = tuple(MaskedColumn(name, mask, ("analysts",)) for name, mask in COLUMN_MASKS.items())
POLICIES = (
    *[
        Policy(
            name=f"{kind}_redaction",
            kind="mask",
            match=("pii_type", kind),
            mask=f"mask_{kind}",
            when=("sensitivity", "pii"),
            to=("analysts",),
            except_=("admins",),
        )
        for kind in ("email", "phone", "name", "address", "postal_code")
    ],
    Policy(
        name="region_isolation",
        kind="filter",
        match=("geo_region", None),
        when=("sensitivity", "pii"),
        to=("us_analysts", "eu_analysts"),
        except_=("admins",),
        on_column="country",
    ),
)


def bronze_customers(source: DataFrame, environment: str, source_table: str, extra: Sequence[str] = ()) -> DataFrame:
    """Bronze: the source columns with load time and lineage. Works on a table or its append stream.
    `extra` keeps further columns, such as a change sequence of the source."""
    return source.select(
        *map(col, [*SOURCE_COLUMNS, *extra]),
        F.current_timestamp().alias("ingestion_ts"),
        F.lit(environment).alias("environment_name"),
        F.lit(source_table).alias("source_table_name"),
    )


def _standard_columns() -> list[Column]:
    lower = lambda value: F.lower(F.trim(value))
    rules = {
        "first_name": F.trim,
        "last_name": F.trim,
        "email_address": lower,
        "phone_number": F.trim,
        "address": F.trim,
        "city": lambda value: F.initcap(F.trim(value)),
        "state": lambda value: F.upper(F.trim(value)),
        "country": F.trim,
        "continent": F.trim,
        "postal_zip_code": lambda value: value.cast("string"),
        "gender": lower,
    }
    return [col("customerID").cast("bigint").alias("customer_id")] + [
        rule(col(name)).alias(name) for name, rule in rules.items()
    ]


def standardize_customers(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rows with a key, in standard text forms; `carry` columns are kept as they are."""
    return bronze.where(col("customerID").isNotNull()).select(*_standard_columns(), *map(col, carry))


def with_full_name_and_hash(customers: DataFrame) -> DataFrame:
    named = customers.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))
    return named.withColumn("record_hash", record_hash(BUSINESS_COLUMNS))


def normalize_customers(bronze: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Silver of the incremental variant: every record, for the type 2 fold to de-duplicate."""
    return with_full_name_and_hash(standardize_customers(bronze, ["ingestion_ts", *LINEAGE_COLUMNS, *extra]))


def snapshot_customers(bronze: DataFrame, environment: str, source_table: str) -> DataFrame:
    """Silver of the snapshot variant: one row per customer, hashed and stamped."""
    single = dedupe_by_key(standardize_customers(bronze), ["customer_id"])
    return with_full_name_and_hash(single).select(
        "*",
        F.current_timestamp().alias("snapshot_ts"),
        F.lit(environment).alias("environment_name"),
        F.lit(source_table).alias("source_table_name"),
    )


def customer_history(normalized: DataFrame, sequence_by: str = "ingestion_ts", **options) -> DataFrame:
    """Type 2 history of normalized records. The sequence must order the changes of a customer: the load
    time does so only when a customer changes at most once per load."""
    options.setdefault("track_history_except", [c for c in STREAM_HISTORY_EXCEPT if c in normalized.columns])
    return fold_scd2(normalized, ["customer_id"], sequence_by, **options)


def current_customers(history: DataFrame) -> DataFrame:
    """Gold: open versions in the reporting shape of 17 columns, lineage last."""
    lineage = list(LINEAGE_COLUMNS)
    current = current_dimension(history, [*BUSINESS_COLUMNS, *lineage])
    return current.select(*[c for c in current.columns if c not in lineage], *lineage)


def geography_summary(current: DataFrame) -> DataFrame:
    """Gold: customers, distinct cities and latest change per continent, country and state."""
    return current.groupBy("continent", "country", "state").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.countDistinct("city").alias("distinct_city_count"),
        F.max("record_effective_from").alias("latest_dimension_change_ts"),
    )
