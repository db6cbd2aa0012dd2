"""What each filter of a chain removes in every order, from sorted posting lists of failing rows."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shared_files import stored
from tidemark.llm.shipping import ship

ROWS_PER_RANGE = 1 << 16
STRETCH = 1024
TEXT_STRETCH = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def gallop(among: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each of the sorted `wanted` would go into the sorted `among`.

    A frontier moves through `among`: its step doubles until it has passed a stretch of `wanted`, and only that
    window is searched. Long runs that hold nothing wanted are leapt over.
    """
    places = np.empty(len(wanted), dtype=np.int64)
    at = 0
    for first in range(0, len(wanted), STRETCH):
        part = wanted[first : first + STRETCH]
        step = 1
        while at + step < len(among) and among[at + step] < part[-1]:
            step *= 2
        found = np.searchsorted(among[at : at + step + 1], part)
        places[first : first + len(part)] = at + found
        at += int(found[-1])
    return places


def outside(wanted: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of `wanted` are not in `among`, where they would go)."""
    places = gallop(among, wanted)
    missing = np.ones(len(wanted), dtype=bool)
    near = np.flatnonzero(places < len(among))
    missing[near] = among[places[near]] != wanted[near]
    return missing, places


def union(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The sorted union of two sorted lists; the shorter one gallops through the longer."""
    short, long = sorted((one, two), key=len)
    missing, places = outside(short, long)
    return np.insert(long, places[missing], short[missing])


def _lists(width: int, rows_per_range: int):
    """Posting lists of each part and id range: places of the rows that have bit 0, 1, ... of `bits`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count = None, [], 0

        def flush():
            bits = np.concatenate(held)
            lists = [np.flatnonzero(bits >> np.uint64(i) & np.uint64(1)).astype("<u4").tobytes() for i in range(width)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([len(bits)], pa.int64()), pa.array([lists], pa.list_(pa.binary()))],
                names=["part", "rows", "lists"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = pc.run_end_encode(batch.column(0))
            bits, first = batch.column(1).to_numpy().view(np.uint64), 0
            for value, end in zip(parts.values.to_pylist(), parts.run_ends.to_pylist(), strict=True):
                if count and value != part:
                    yield flush()
                    held, count = [], 0
                part = value
                while first < end:
                    stop = min(end, first + rows_per_range - count)
                    held.append(bits[first:stop])
                    count, first = count + stop - first, stop
                    if count == rows_per_range:
                        yield flush()
                        held, count = [], 0
        if count:
            yield flush()

    return work


def failing_lists(
    rows: DataFrame, filters: Sequence[str], part: str, order: Sequence[str], marks: Sequence[str] = (), rows_per_range: int | None = None
) -> DataFrame:
    """part, rows, lists: for each part and range of ids, one sorted list per filter and per mark.

    `filters` and `marks` are boolean columns of `rows`; TRUE in a filter's column is a row that fails it, NULL counts
    as FALSE. Rows are cut into ranges by `part` and the `order` columns. Inside a range an id is the row's place in that
    order, so rows that repeat an id, or have none, are rows of their own. A null part is the part ''.
    """
    ship(rows.sparkSession)
    width = len(filters) + len(marks)
    if width > 62:
        raise ValueError("at most 62 filters and marks")
    bits = F.lit(0).cast("long")
    for i, name in enumerate([*filters, *marks]):
        bits = bits + F.when(F.col(name), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    packed = rows.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        bits.alias("bits"),
        *[F.col(c).alias(f"by{i}") for i, c in enumerate(order)],
    )
    by = ["part", *[f"by{i}" for i in range(len(order))]]
    ranged = packed.repartitionByRange(*by).sortWithinPartitions(*by).select("part", "bits")
    return ranged.mapInArrow(_lists(width, rows_per_range or ROWS_PER_RANGE), "part string, rows long, lists array<binary>")


def _merged(filters: int, marks: int):
    """For every range: each filter behind each set of others - what it removes, what is left to it, what is lost."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, lists in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = [np.frombuffer(x, "<u4") for x in lists]
                failed = {0: ids[0][:0]}
                out = []
                for before in range(1 << filters):
                    if before:
                        low = (before & -before).bit_length() - 1
                        failed[before] = union(failed[before & (before - 1)], ids[low])
                    for i in range(filters):
                        if not before >> i & 1:
                            missing, _ = outside(ids[i], failed[before])
                            new = ids[i][missing]
                            lost = [len(new) - int(outside(new, ids[filters + m])[0].sum()) for m in range(marks)]
                            out.append((before, i, len(failed[before]), len(new), len(ids[i]) - len(new), lost))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(out), pa.string()),
                        pa.array([rows] * len(out), pa.int64()),
                        *[pa.array(c, pa.int32()) for c in columns[:2]],
                        *[pa.array(c, pa.int64()) for c in columns[2:5]],
                        pa.array(columns[5], pa.list_(pa.int64())),
                    ],
                    names=["part", "rows", "before", "filter", "failed", "removed", "redundant", "lost"],
                )

    return work


def interactions(lists: DataFrame, filters: int, marks: int = 0) -> DataFrame:
    """part, before (bits of the filters applied before), filter (its number) and sums over all ranges.

    rows; failed: rows that fail one of those before; removed: fail this filter and none before; redundant: fail it
    and one before; lost: of those removed, how many have each mark. One row for each part, filter and set of others.
    """
    if filters > 12:
        raise ValueError("at most 12 filters: their subsets are counted one by one")
    ship(lists.sparkSession)
    kinds = "part string, rows long, before int, filter int, failed long, removed long, redundant long, lost array<long>"
    sums = [F.sum(c).alias(c) for c in ("rows", "failed", "removed", "redundant")]
    sums += [F.sum(F.col("lost")[m]).alias(f"lost{m}") for m in range(marks)]
    return lists.mapInArrow(_merged(filters, marks), kinds).groupBy("part", "before", "filter").agg(*sums)


def audit(
    rows: DataFrame, filters: Mapping[str, str], part: str, order: Sequence[str], marks: Mapping[str, str] | None = None
) -> DataFrame:
    """part, filter_order, step and counts for every order of the filters and every step of it.

    `filters` maps one-letter names to boolean columns, `marks` maps result columns to boolean columns. kept: rows left
    behind the step; removed: taken out by it; redundant: fail its filter but went before; unique_fails: fail no other
    filter; each mark: rows removed here that have it; shapley: rows its filter removes, summed over all orders.
    An empty table has no parts, so no rows come back.
    """
    names, marks = list(filters), dict(marks or {})
    lists = stored(failing_lists(rows, list(filters.values()), part, order, list(marks.values())), "posting-lists")
    sums = interactions(lists, len(names), len(marks))
    steps = []
    for chain in itertools.permutations(range(len(names))):
        before = 0
        for step, i in enumerate(chain, 1):
            steps.append(("".join(names[k] for k in chain), step, before, i))
            before |= 1 << i
    chains = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, filter int")
    own = Window.partitionBy("part", "filter")
    last = F.col("step") == len(names)
    return sums.join(chains, ["before", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - F.col("failed") - F.col("removed")).alias("kept"),
        "removed",
        "redundant",
        F.max(F.when(last, F.col("removed"))).over(own).alias("unique_fails"),
        *[F.col(f"lost{m}").alias(name) for m, name in enumerate(marks)],
        F.sum("removed").over(own).alias("shapley"),
    )


def word_counts(data: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text's bytes; words are maximal runs without white space."""
    if len(data) <= TEXT_STRETCH:
        words = data.split()
        return len(words), len(set(words))
    count, seen, at = 0, set(), 0
    while at < len(data):
        end = _SPACE.search(data, at + TEXT_STRETCH)
        stop = end.start() if end else len(data)
        words = data[at:stop].split()
        count, at = count + len(words), stop
        seen.update(words)
    return count, len(seen)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(2), "")
        points = pc.utf8_length(texts).to_pylist()
        fails, digests = [[], [], [], []], []
        for data, length in zip(texts.cast(pa.binary()), points, strict=True):
            data = data.as_py()
            words, kinds = word_counts(data)
            fails[0].append(words < 100)
            fails[1].append(100 * kinds < 80 * words)
            fails[2].append(100 * (len(data) - len(data.translate(None, _UPPER))) > 10 * length)
            fails[3].append(len(data.translate(None, _MARKS)) < len(data))
            digests.append(hashlib.blake2b(data, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), *[pa.array(f, pa.bool_()) for f in fails]],
            names=["doc_id", "part", "digest", "a", "b", "c", "d"],
        )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (of the whole text) and which rules a row fails: a, b, c, d, and e (a smaller doc_id has its text).

    a: under 100 words; b: fewer than 80 % distinct words; c: over 10 % capitals; d: one of #$%&*|. A null text is empty, a
    null lang is the part ''. A null doc_id is neither smaller nor larger than another, so its row never fails e.
    Texts are compared by 128-bit digests.
    """
    ship(docs.sparkSession)
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    kinds = "doc_id long, part string, digest binary, a boolean, b boolean, c boolean, d boolean"
    rows = stored(chosen.mapInArrow(_judged, kinds), "judged")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
    # a row is the first of its text if it is in `firsts`; joined by both columns, copies of one text meet in no one task
    found = rows.join(firsts.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    return found.withColumn("e", F.col("doc_id").isNotNull() & F.col("first").isNull()).drop("first")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five rules over all documents, in all orders, per language."""
    rows = judged(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return audit(
        rows.join(labels, "doc_id", "left"),
        {name: name.lower() for name in "ABCDE"},
        part="part",
        order=["doc_id", "digest"],
        marks={"good_lost": "good", "toxic_lost": "toxic"},
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), counted AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS fails
  FROM counted LEFT JOIN marks USING (doc_id)
), classes AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing GROUP BY part, fails
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), orders AS (
  SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z WHERE (v.bit | w.bit | x.bit | y.bit | z.bit) = 31
), steps AS (
  SELECT filter_order, step::INTEGER AS step, letters.bit,
    (SELECT coalesce(sum(earlier.bit), 0) FROM letters earlier
     WHERE position(earlier.letter IN filter_order) < step)::INTEGER AS before
  FROM orders, range(1, 6) steps(step), letters WHERE letters.letter = substr(filter_order, step::INTEGER, 1)
), summed AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & bit <> 0 AND fails & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & bit <> 0 AND fails & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & bit <> 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & bit <> 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost
  FROM classes, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM summed
"""
