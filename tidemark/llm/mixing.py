"""Mix sources to target weights: whole repetitions of each document, and one more by a seeded draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.names import set_aside, unused

WORD = r"[^\x20\x09-\x0D]+"
DRAW_DIGITS = 12  # hexadecimal digits of a draw: 48 bits
MADE = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    key = F.concat_ws("|", F.lit(seed), *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("double")
    return digits / float(16**DRAW_DIGITS)


def source_targets(sizes: DataFrame, weights: Sequence[int], most_repeats: int) -> DataFrame:
    """source, source_size and target of every source, from a table of (source, size).

    Sources in code-point order, null last, weigh `weights`, repeating. They share the total of all sizes; no
    target exceeds `most_repeats` times its source's size, and what is cut off goes to the others by weight
    until none is above. The targets that result are least(limit, level * weight) for one level: with sources
    in order of limit / weight, a first part is at its limit and the rest shares what is left.
    One row per source is ordered here; documents are only summed, on the map side first.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(place) - 1) % len(weights)
    weighted = by_source.withColumn("weight", F.element_at(F.lit(list(weights)), turn + 1).cast("long")).withColumn(
        "limit", F.col("source_size") * most_repeats
    )
    rising = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    shared = weighted.withColumn("level", left / F.sum("weight").over(after)).withColumn(
        "capped", F.col("level") * F.col("weight") > F.col("limit")
    )
    # behind the first source under its limit, levels only fall, as they count sources at a limit they do not reach
    level = F.coalesce(F.max(F.when(~F.col("capped"), F.col("level"))).over(everything), F.lit(0.0))
    target = F.least(F.col("limit").cast("double"), level * F.col("weight"))
    return shared.withColumn("target", target).select("source", "source_size", "target")


def repetitions(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most_repeats: int = 3, seed: str = "mix"
) -> DataFrame:
    """Every row of `docs` with size, source_size, target and copies (how often the mix holds it).

    A source's rate is target / source_size; a document is held floor(rate) times, and once more if its draw,
    seeded by its doc_id, is below the rest of the rate. Draws depend on nothing else, so reruns agree.

    The size of a null or blank text is 0. Sources of size 0 have target 0 and no copies. Rows that repeat a doc_id
    draw alike. A null doc_id draws as ''. Columns named size, source_size, target or copies are replaced; no other
    name clashes.
    """
    docs = docs.drop(*MADE).withColumn("size", word_count(F.col("text")))
    of = unused(docs.columns, "_of")
    targets = source_targets(docs.select(F.col("source").cast("string").alias("source"), "size"), weights, most_repeats)
    targets = targets.withColumnRenamed("source", of)
    # a source table small enough for the session's limit is broadcast by Spark; else its hot keys are split by AQE
    joined = docs.join(targets, F.col("source").cast("string").eqNullSafe(F.col(of))).drop(of)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    more = (draw(seed, F.col("doc_id")) < rate - F.floor(rate)).cast("int")
    return joined.withColumn("copies", (F.floor(rate) + more).cast("int"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as `repetitions` holds it, with the columns of `docs` as they were."""
    docs, back = set_aside(docs, MADE)
    held = repetitions(docs, **options).where("copies > 0")
    copy = unused(held.columns, "_copy")
    return held.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*back)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source: the words taken of each."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return repetitions(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, source_size * 3 AS cap
  FROM by_source
), shared AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), targets AS (
  SELECT source, source_size,
    least(cap::DOUBLE, coalesce(max(CASE WHEN level * weight > cap THEN NULL ELSE level END) OVER (), 0.0) * weight) AS target
  FROM shared
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
