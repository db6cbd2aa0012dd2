"""Document fingerprints by winnowing: rolling k-gram hashes, the least of every window, positions kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.text_arrays import mix
from tidemark.operators.ranges import range_cuts, range_index

GRAM = 16
WINDOW = 16
_BASE = 0xD6E8FEB86659FD93  # odd
_STRETCH = 1 << 20
_powers: list[np.ndarray] = []


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _powers_of_base() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(_STRETCH + 1, base, dtype=np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The rolling hash of every run of `gram` values, by prefix sums of a polynomial, then mixed."""
    power, inverse = _powers_of_base()
    parts = []
    for first in range(0, max(1, len(points) - gram + 1), _STRETCH - gram + 1):
        some = points[first : first + _STRETCH]
        if len(some) >= gram:
            sums = np.zeros(len(some) + 1, dtype=np.uint64)
            np.cumsum((some.astype(np.uint64) + np.uint64(1)) * power[: len(some)], out=sums[1:])
            count = len(some) - gram + 1
            parts.append((sums[gram:] - sums[:-gram]) * inverse[:count])
    return mix(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _least_of_windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions chosen in windows of `window` hashes: the least hash, of equal ones the rightmost."""
    value, place = hashes, np.arange(len(hashes))
    covered = 1
    while covered < window:
        step = min(covered, window - covered)
        right = value[step:] <= value[: len(value) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        value = np.where(right, value[step:], value[: len(value) - step])
        covered += step
    return place


def fingerprint(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a text's fingerprints, by position.

    White space (space and U+0009 to U+000D) is left out and A-Z are lower-cased before hashing; positions are
    code points of the original text where the k-gram begins. Any passage of `gram + window - 1` characters
    (white space aside) that two texts share gives them a common fingerprint. A text with fewer k-grams than a
    window has one fingerprint, a text shorter than a k-gram has its own hash, an empty one has none.
    """
    kept = np.flatnonzero((points != 32) & ((points < 9) | (points > 13)))
    values = points[kept]
    values = np.where((values >= 65) & (values <= 90), values + 32, values)
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = gram_hashes(values, min(gram, len(values)))
    chosen = _least_of_windows(hashes, min(window, len(hashes)))
    chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
    return hashes[chosen], kept[chosen]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Shared share of two texts' distinct fingerprint hashes; 1 if neither has any."""
    a, b = np.unique(one), np.unique(two)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """A name of the whole fingerprint: SHA-256 over its hashes and positions."""
    return hashlib.sha256(hashes.astype("<u8").tobytes() + positions.astype("<u8").tobytes()).hexdigest()


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id and `prints`, an array of (hash, position) in text order, for the whole text of every row."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(code_points(text or ""), gram, window) for text in batch.column(1).to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(h) for h, _ in found)], dtype=np.int32))
            hashes = np.concatenate([h for h, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
            places = np.concatenate([p for _, p in found] or [np.zeros(0, np.int64)])
            pairs = pa.StructArray.from_arrays([pa.array(hashes), pa.array(places)], names=["hash", "position"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pairs)], names=["doc_id", "prints"]
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, prints array<struct<hash: long, position: long>>")


def with_next(docs: DataFrame, rows_per_range: int = 20_000) -> DataFrame:
    """Rows (part, doc_id, text, ahead) in partitions that hold ranges of doc_id in order.

    Texts move once. The first row of each range is also sent, marked `ahead`, to the end of the range before
    it, and the first of all to the end of the last, so every row meets its successor in its own partition.
    Rows that share a doc_id follow one another by text; a null doc_id comes first; null texts are ''.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    cuts = range_cuts(docs, "doc_id", rows_per_range)
    placed = docs.withColumn("part", range_index(F.col("doc_id"), cuts))
    # one row a range; the order of (is not null, doc_id) is that of ascending ids with nulls first
    order = F.struct(F.col("doc_id").isNotNull().alias("given"), F.col("doc_id").alias("doc_id"))
    heads = sorted(
        (row["part"], row["head"]["doc_id"]) for row in placed.groupBy("part").agg(F.min(order).alias("head")).collect()
    )
    if not heads:
        return placed.withColumn("ahead", F.lit(False)).select("part", "doc_id", "text", "ahead")
    to = {part: heads[i - 1][0] for i, (part, _) in enumerate(heads)}
    targets = docs.sparkSession.createDataFrame(
        [(part, to[part], doc_id) for part, doc_id in heads], "part int, target int, head long"
    )
    # as many rows as ranges, at most ranges.MOST_RANGES
    copies = placed.join(F.broadcast(targets), "part").where(F.col("doc_id").eqNullSafe(F.col("head")))
    first_text = copies.groupBy("target", "doc_id").agg(F.min("text").alias("text"))
    ahead = first_text.select(F.col("target").alias("part"), "doc_id", "text", F.lit(True).alias("ahead"))
    return (
        placed.select("part", "doc_id", "text", F.lit(False).alias("ahead"))
        .unionByName(ahead)
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "ahead", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """`text` with its last quarter (code points, rounded down) replaced by as much of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def edit_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and that of the next row (see `op2_winnowing`)."""
    ship(docs.sparkSession)
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_fingerprints long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, []

        def take(following: str, prints) -> None:
            doc_id, text, own = held
            changed = edited(text, following)
            theirs = own if changed == text else fingerprint(code_points(changed), gram, window)
            done.append(
                (
                    doc_id,
                    len(text),
                    hashlib.sha256(changed.encode()).hexdigest(),
                    digest(*own),
                    digest(*theirs),
                    likeness(own[0], theirs[0]),
                    likeness(own[0], prints[0]),
                    len(own[0]),
                )
            )

        def ready() -> pa.RecordBatch:
            rows = pa.Table.from_pylist([dict(zip(names, row, strict=True)) for row in done], arrow_schema)
            done.clear()
            return rows.combine_chunks().to_batches()[0] if len(rows) else pa.RecordBatch.from_pylist([], arrow_schema)

        for batch in batches:
            for doc_id, text, ahead in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                prints = fingerprint(code_points(text), gram, window)
                if held is not None:
                    take(text, prints)
                held = None if ahead else (doc_id, text, prints)
            yield ready()

    arrow_schema = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[p.split()[1]]) for n, p in zip(names, schema.split(", "), strict=True)]
    )
    return with_next(docs).mapInArrow(work, schema)


def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and of their successors."""
    return edit_likeness(spark.read.parquet(f"{folder}/documents.parquet"))
