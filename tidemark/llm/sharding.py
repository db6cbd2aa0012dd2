"""Shards by jump consistent hashing: no ring table, and appended shards take rows only into themselves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import ship

#: Factor of the linear congruential generator that the jump law is defined with (a fixed value).
FACTOR = 2862933555777941757
KEY_DIGITS, SPREAD_DIGITS = 15, 12  # hexadecimal digits of one MD5 digest: the jump's key, then the order in a shard
ROWS_PER_BUCKET = 50_000
COPIES_PER_TASK = 100_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to shards - 1) of every 64-bit key.

    A key jumps forward through ever larger shard counts, each time to the next count at which it would move; the
    last one below `shards` holds it. So a key moves only when it jumps to a new shard, in about ln(shards) steps.
    """
    if shards < 1:
        raise ValueError("there is at least one shard")
    state = np.array(keys, dtype=np.uint64)
    held = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    at = np.zeros(len(state), dtype=np.int64)
    while len(moving):
        held[moving] = at
        state[moving] = state[moving] * np.uint64(FACTOR) + np.uint64(1)
        draws = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        at = ((held[moving] + 1) * (float(1 << 31) / draws)).astype(np.int64)
        moving, at = moving[at < shards], at[at < shards]
    return held.astype(np.int32)


def _digest(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def _number(digest: Column, first: int, digits: int) -> Column:
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")


def shard_of(spark: SparkSession, key: Column, shards: int) -> Column:
    """The shard of a key column of any type; a null key counts as the empty text."""
    ship(spark)

    @F.pandas_udf("int")
    def law(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return law(_number(_digest(key), 1, KEY_DIGITS))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", into: str = "shard") -> DataFrame:
    """Add `into`, the shard of every row by its `key`; a column of that name is replaced, all others stay."""
    return docs.withColumn(into, shard_of(docs.sparkSession, F.col(key), shards))


def moved(docs: DataFrame, shards: int, more: int, key: str = "doc_id") -> DataFrame:
    """Only the rows that change their shard when there are `more` shards, with columns from_shard and to_shard."""
    both = assign(assign(docs, shards, key, "from_shard"), more, key, "to_shard")
    return both.where("from_shard <> to_shard")


def write_shards(docs: DataFrame, folder: str, shards: int, key: str = "doc_id", files: int = 1) -> None:
    """Write the rows as parquet, `files` files to each folder shard=<number>."""
    piece = F.pmod(F.xxhash64(*[F.col(c) for c in docs.columns if c != "shard"]), F.lit(files))
    rows = assign(docs, shards, key).withColumn("shard", F.col("shard"))
    rows.repartition(F.col("shard"), piece).write.partitionBy("shard").parquet(folder)


def with_slots(rows: DataFrame, key: str = "doc_id", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add `slot`, each row's place in its `shard`, gapless from 0; a column `slot` is replaced.

    Rows of a shard stand in the order of a digest of their key, then of all their columns. Ranges of that digest
    are counted and numbered apart, so no task holds a shard. Rows that are alike in every column are numbered by
    their count: however many there are, one row of them is shuffled from each task. Column types must be
    orderable. `rows` is read twice, so give it stored.
    """
    names = [c for c in rows.columns if c != "slot"]
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    packed = rows.select(F.struct(*names).alias("row")).select(
        F.col("row.shard").alias("shard"),
        _number(_digest(F.col(f"row.{key}")), KEY_DIGITS + 1, SPREAD_DIGITS).alias("spread"),
        "row",
    )
    bucket = F.floor(F.col("spread") / float(16**SPREAD_DIGITS) * buckets).alias("bucket")
    alike = packed.groupBy("shard", bucket, "spread", "row").agg(F.count("*").alias("copies"))
    counts = packed.groupBy("shard", bucket).agg(F.count("*").alias("held"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("spread", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        alike.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(starts, ["shard", "bucket"])
        .select("row", "copies", (F.col("start") + F.col("before")).alias("first"))
    )
    few = placed.where(F.col("copies") <= COPIES_PER_TASK).select("row", "first", F.col("copies").alias("n"))
    from_copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_PER_TASK))).alias("at")
    many = (
        placed.where(F.col("copies") > COPIES_PER_TASK)
        .select("row", "copies", "first", from_copy)
        .repartition("first", "at")
        .select(
            "row", (F.col("first") + F.col("at")).alias("first"), F.least(F.lit(COPIES_PER_TASK), F.col("copies") - F.col("at")).alias("n")
        )
    )
    one = few.unionByName(many).select("row", "first", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    return one.select("row.*", (F.col("first") + F.col("i")).alias("slot"))


def op11_sharding(spark: SparkSession, folder: str, shards: int = 24) -> DataFrame:
    """All documents in 24 shards by doc_id: where each stands, and its shard once there is one more."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    both = assign(assign(rows, shards), shards + 1, into="grown_shard")
    return with_slots(stored(both, "sharded")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
