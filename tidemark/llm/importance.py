"""Importance resampling: documents drawn by how much likelier the target's n-grams make them than the corpus's own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.mixing import draw
from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import ship
from tidemark.llm.text_arrays import bytes_of, sequence_hashes, slices, word_bounds, word_hashes

BUCKETS = 1 << 14
DIGITS = 1e-6  # keys are compared in millionths
STEP_BITS = 12


def hashed_grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, buckets of its words and word pairs) of every text, A-Z lower-cased. Null texts have none."""
    for first, piece in slices(texts):
        data, offsets = bytes_of(piece, lower=True)
        starts, ends, first_word = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        for i in range(len(piece)):
            words = hashes[first_word[i] : first_word[i + 1]]
            grams = np.concatenate([words, sequence_hashes(words, 2)]) if len(words) else words
            yield first + i, (grams % np.uint64(BUCKETS)).astype(np.int64)


def _counted():
    """Per batch: a row for each bucket, with its count in all texts and in those of the target."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            chosen = batch.column(1).to_pylist()
            for row, buckets in hashed_grams(batch.column(0)):
                counts = np.bincount(buckets, minlength=BUCKETS)
                raw += counts
                if chosen[row]:
                    target += counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"]
        )

    return work


def _weighed(ratios: bytes):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = np.frombuffer(ratios, dtype=np.float64)
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            for row, buckets in hashed_grams(batch.column(batch.num_columns - 1)):
                weights[row] = ratio[buckets].sum()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(weights)], names=[*batch.schema.names[:-1], "log_weight"]
            )

    return work


def gram_ratios(docs: DataFrame, labels: DataFrame, most_labels: int) -> tuple[np.ndarray, float]:
    """Log ratio of each bucket's probability in the target to that in the corpus; the labels' share of target rows.

    The corpus counts are sums over all documents. The target is the text of labelled documents of quality 1
    among the `most_labels` labels of smallest hash, a bounded sample that every task can hold. Each task adds
    up `BUCKETS` numbers; the driver receives as many. A document labelled more than once has its least quality.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    sample = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
    share = sample.agg(F.coalesce(F.avg("quality"), F.lit(1.0))).first()[0]
    target = sample.where("quality = 1").select(F.col("doc_id").alias("_labelled"))
    # at most most_labels numbers, whatever the size of the tables
    marked = docs.join(F.broadcast(target), F.col("doc_id") == F.col("_labelled"), "left")
    counts = (
        marked.select(F.col("text").cast("string").alias("text"), F.col("_labelled").isNotNull().alias("chosen"))
        .mapInArrow(_counted(), "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    raw, wanted = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in counts:
        raw[bucket] += r
        wanted[bucket] += t
    return np.log(wanted / wanted.sum()) - np.log(raw / raw.sum()), float(share)


def _least_of_top(keys: DataFrame, column: str, count: int) -> int:
    """The `count`-th largest value of a long column, by counting ranges that shrink by `STEP_BITS` bits a pass."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    wanted = count
    while low < high:
        width = max(1, -(-(high - low + 1) >> STEP_BITS))
        cells = (
            keys.where(F.col(column).between(low, high))
            .groupBy(F.floor((F.col(column) - low) / F.lit(width)).cast("long").alias("cell"))
            .count()
            .collect()
        )
        for cell, rows in sorted(cells, reverse=True):
            if rows >= wanted:
                low, high = low + cell * width, min(high, low + cell * width + width - 1)
                break
            wanted -= rows
    return low


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, most_labels: int = 20_000, seed: str = "resample"
) -> DataFrame:
    """The documents drawn, with doc_id, log_weight, gumbel_key and kept (true for every row).

    Words and word pairs are hashed into `BUCKETS`; a text's weight is the product of its n-grams' ratios of
    probability in the target to probability in the corpus. Drawing without replacement by weight is taking
    the largest keys log_weight + Gumbel noise, the noise seeded by doc_id. `share` of all rows are drawn
    (default: the share of target rows among the labels, which is what the corpus is expected to hold);
    equal keys are drawn by smaller doc_id. Counts and weights cover all documents; only the labels are a
    bounded sample (`most_labels`).

    Null or blank texts have weight 0 (log). Rows with a null doc_id are drawn like others, last among equals.
    Repeated rows have equal keys and are drawn together if they all fit. Empty tables give none; without labels
    all documents are drawn.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ratios, expected = gram_ratios(docs, labels, most_labels)
    weighed = docs.mapInArrow(_weighed(ratios.tobytes()), "doc_id long, log_weight double")
    noise = -F.log(-F.log((draw(seed, F.col("doc_id")) * (1 << 48) + 0.5) / float(1 << 48)))
    keyed = weighed.withColumn("gumbel_key", F.col("log_weight") + noise)
    keyed = stored(keyed.withColumn("_rank", F.round(F.col("gumbel_key") / DIGITS).cast("long")), "keys")
    rows = keyed.count()
    count = round(rows * (expected if share is None else share))
    last = F.coalesce(-F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))
    if count <= 0:
        chosen = keyed.where(F.lit(False))
    elif count >= rows:
        chosen = keyed
    else:
        edge = _least_of_top(keyed, "_rank", count)
        above = keyed.where(F.col("_rank") > edge).count()
        ties = keyed.where(F.col("_rank") == edge).withColumn("_last", last)
        if above + ties.count() > count:
            fence = _least_of_top(ties, "_last", count - above)
            chosen = keyed.where((F.col("_rank") > edge) | ((F.col("_rank") == edge) & (last >= fence)))
        else:
            chosen = keyed.where(F.col("_rank") >= edge)
    return chosen.drop("_rank").withColumn("kept", F.lit(True))


def op4_importance(spark: SparkSession, folder: str) -> DataFrame:
    """A resample of all documents toward those labelled good."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return resample(read("documents"), read("labels"))
