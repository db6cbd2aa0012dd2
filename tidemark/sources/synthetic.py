"""A synthetic change feed with planted defects, reproducible from a seed.

Every value is an expression over the row's number, so the feed is generated on the executors, is the
same on every run and partitioning, and needs no Python function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.position import POSITION, zip_rows

# Word lists, operation weights, share of missing ids, time format of the feed.
FIRST_NAMES = ("Ada", "Ben", "Chloe", "Dev", "Elif", "Femi", "Grace", "Hugo", "Ines", "Jun", "Kofi", "Lena")
LAST_NAMES = ("Abe", "Brown", "Costa", "Diaz", "Evans", "Fischer", "Garcia", "Haddad", "Ito", "Jones", "Kaya")
STREETS = ("Oak Street", "Mill Lane", "Station Road", "High Street", "Park Avenue", "Lake View")
OPERATION_WEIGHTS = (("APPEND", 0.5), ("DELETE", 0.1), ("UPDATE", 0.3), (None, 0.01))
MISSING_ID_SHARE = 0.02
EVENT_TIME_FORMAT = "MM-dd-yyyy HH:mm:ss"
FEED_START = "2026-01-01 00:00:00"
FEED_SECONDS = 30 * 24 * 3600


def _draw(number: Column, seed: int, what: str) -> Column:
    """A uniform number in [0, 1) that depends on the row, the seed and the purpose only: 32 bits of an MD5,
    which any engine computes alike and which reach every second of a century."""
    digest = F.md5(F.concat_ws(":", F.lit(what), F.lit(seed).cast("string"), number.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _choice(number: Column, seed: int, what: str, words: tuple[str, ...]) -> Column:
    at = F.floor(_draw(number, seed, what) * len(words)).cast("int") + 1
    return F.element_at(F.lit(list(words)), at)


def _operation(number: Column, seed: int) -> Column:
    total = sum(weight for _, weight in OPERATION_WEIGHTS)
    draw, reached, choice = _draw(number, seed, "operation"), 0.0, F
    for word, weight in OPERATION_WEIGHTS:
        reached += weight / total
        choice = choice.when(draw < reached, F.lit(word))
    return choice


def _event_time(number: Column, seed: int, what: str) -> Column:
    start = F.unix_timestamp(F.lit(FEED_START))
    at = start + F.floor(_draw(number, seed, what) * FEED_SECONDS)
    return F.from_unixtime(at, EVENT_TIME_FORMAT)


def _identifier(number: Column, seed: int, what: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(what), F.lit(seed).cast("string"), number.cast("string")))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in parts])


def row_numbers(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(0, rows).withColumnRenamed("id", "number")


def customer_changes(numbers: DataFrame, seed: int = 42, changes_per_customer: int = 1) -> DataFrame:
    """One customer change event per row of `numbers` (a frame with a unique `number` column).

    With more changes per customer, as many neighbouring numbers share an id, so that ids have histories.
    """
    n = F.col("number")
    who = F.floor(n / changes_per_customer).cast("long")
    first, last = _choice(n, seed, "first", FIRST_NAMES), _choice(n, seed, "last", LAST_NAMES)
    house = F.floor(_draw(n, seed, "house") * 999) + 1
    postal = F.lpad(F.floor(_draw(n, seed, "postal") * 100_000).cast("string"), 5, "0")
    address = F.concat(house.cast("string"), F.lit(" "), _choice(n, seed, "street", STREETS), F.lit("\n"), postal)
    return numbers.select(
        "number",
        F.when(_draw(n, seed, "missing") >= MISSING_ID_SHARE, _identifier(who, seed, "customer")).alias("id"),
        first.alias("firstname"),
        last.alias("lastname"),
        F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com"))).alias("email"),
        address.alias("address"),
        _operation(n, seed).alias("operation"),
        _event_time(n, seed, "changed").alias("operation_date"),
    )


def transaction_changes(numbers: DataFrame, customers: DataFrame, seed: int = 42) -> DataFrame:
    """One transaction change event per row. The row in place n, by number, is for the customer in place n."""
    n = F.col("number")
    events = numbers.select(
        "number",
        F.when(_draw(n, seed, "missing tx") >= MISSING_ID_SHARE, _identifier(n, seed, "transaction")).alias("id"),
        _event_time(n, seed, "bought").alias("transaction_date"),
        F.round(_draw(n, seed, "amount") * 1000).alias("amount"),
        F.round(_draw(n, seed, "items") * 10).alias("item_count"),
        _operation(n, seed + 1).alias("operation"),
        _event_time(n, seed, "tx changed").alias("operation_date"),
    )
    people = customers.select(F.col("number").alias("_customer"), F.col("id").alias("customer_id"))
    return zip_rows(events, people, ["number"], ["_customer"]).drop("_customer", POSITION)


def generate_cdc_feed(
    spark: SparkSession, customers: int = 100_000, transactions: int = 10_000, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two linked feeds: customer events, and transactions of the first customers among them."""
    people = customer_changes(row_numbers(spark, customers), seed)
    return people.drop("number"), transaction_changes(row_numbers(spark, transactions), people, seed).drop("number")
