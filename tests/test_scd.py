"""Type 1 and type 2 folds: hand-checked fixture, and agreement with a plain Python fold."""

import pytest
from helpers import COLUMNS as SCHEMA
from helpers import COMMON, random_events, rows
from pyspark.sql import functions as F

from tidemark.operators.common import END_AT, START_AT
from tidemark.operators.position import with_position
from tidemark.operators.scd import fold_scd1, fold_scd2, fold_versions, prepare_events
from tidemark.operators.skew import SEGMENTS_A_LIMIT, add_segments, hot_keys, segment_cuts, split_hot

EVENTS = [
    (1, "Ann", "n1", "APPEND", 10),
    (1, "Ann", "n2", "UPDATE", 20),
    (1, "Bea", "n3", "UPDATE", 40),
    (1, "Ann", "n4", "UPDATE", 30),
    (2, "Cy", "c1", "APPEND", 10),
    (2, None, None, "DELETE", 20),
    (2, "Cy", "c2", "APPEND", 30),
    (3, "Di", "d1", "DELETE", 15),
    (3, "Di", "d0", "APPEND", 10),
    (4, "Ed", "e2", "DELETE", 5),
    (5, None, "x", "APPEND", 1),
    (5, "Flo", "y", "UPDATE", 2),
    (5, None, "z", "UPDATE", 3),
]

def test_scd1_fixture(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    assert rows(fold_scd1(df, **COMMON)) == [(1, "Bea", "n3"), (2, "Cy", "c2"), (5, None, "z")]
    kept = fold_scd1(df, ignore_null_updates=True, **COMMON)
    assert rows(kept) == [(1, "Bea", "n3"), (2, "Cy", "c2"), (5, "Flo", "z")]


def test_scd2_fixture(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    every = [
        (1, "Ann", "n1", 10, 20),
        (1, "Ann", "n2", 20, 30),
        (1, "Ann", "n4", 30, 40),
        (1, "Bea", "n3", 40, None),
        (2, "Cy", "c1", 10, 20),
        (2, "Cy", "c2", 30, None),
        (3, "Di", "d0", 10, 15),
        (5, None, "x", 1, 2),
        (5, "Flo", "y", 2, 3),
        (5, None, "z", 3, None),
    ]
    assert rows(fold_scd2(df, **COMMON)) == sorted(every, key=repr)
    tracked = [(1, "Ann", "n4", 10, 40), *every[3:]]
    assert rows(fold_scd2(df, track_history=["name"], **COMMON)) == sorted(tracked, key=repr)
    assert rows(fold_scd2(df, track_history_except=["note"], **COMMON)) == sorted(tracked, key=repr)


def expected_fold(events, tracked, ignore_nulls):
    """A plain sequential fold: {key: [[payload..., start, end], ...]}."""
    versions = {}
    by_key = {}
    for key, name, note, operation, seq in events:
        by_key.setdefault(key, {}).setdefault(seq, []).append((operation == "DELETE", name, note))
    for key, by_seq in by_key.items():
        out, open_, before, filled = [], None, None, (None, None)
        for seq in sorted(by_seq):
            tied = by_seq[seq]
            if ignore_nulls:
                deleted = any(t[0] for t in tied)
                new = [max((t[i] for t in tied if t[i] is not None), default=None) for i in (1, 2)]
                filled = (None, None) if deleted else tuple(n if n is not None else f for n, f in zip(new, filled))
                event = (deleted, *filled)
            else:
                event = max(tied, key=lambda t: (t[0], *[(v is not None, v or "") for v in t[1:]]))
            deleted, payload = event[0], event[1:]
            if deleted:
                if open_:
                    open_[-1] = seq
                open_ = None
            else:
                same = tracked is not None and open_ and all(open_[i] == payload[i] for i in tracked)
                if same:
                    open_[0:2] = payload
                else:
                    if open_:
                        open_[-1] = seq
                    open_ = [*payload, seq, None]
                    out.append(open_)
        for version in out:
            versions.setdefault(key, []).append(tuple(version))
    return sorted([(key, *v) for key, vs in versions.items() for v in vs], key=repr)


@pytest.mark.parametrize("hot_rows", [10, 1_000_000], ids=["segmented", "whole"])
@pytest.mark.parametrize("ignore_nulls", [False, True])
@pytest.mark.parametrize("tracked", [None, ["name"], ["name", "note"], []], ids=str)
def test_scd2_agrees_with_sequential_fold(spark, hot_rows, ignore_nulls, tracked):
    events = random_events(seed=len(tracked or "none") * 2 + ignore_nulls)
    df = spark.createDataFrame(events, SCHEMA).repartition(5)
    got = fold_scd2(df, track_history=tracked, ignore_null_updates=ignore_nulls, hot_rows=hot_rows, **COMMON)
    places = None if tracked is None else [["name", "note"].index(c) for c in tracked]
    assert rows(got) == expected_fold(events, places, ignore_nulls)


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_scd1_is_the_open_part_of_scd2(spark, ignore_nulls):
    df = spark.createDataFrame(random_events(seed=7), SCHEMA)
    one = fold_scd1(df, ignore_null_updates=ignore_nulls, **COMMON)
    two = fold_scd2(df, ignore_null_updates=ignore_nulls, **COMMON)
    assert rows(one) == rows(two.where(F.col(END_AT).isNull()).drop(START_AT, END_AT))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(12,3)", "struct"])
def test_sequence_types_in_segments(spark, kind):
    events = random_events(seed=11)
    df = spark.createDataFrame(events, SCHEMA)
    start = F.lit("2024-03-30").cast("date")
    sequence = {
        "timestamp": F.timestamp_seconds(F.col("seq") * 1800 + 1_711_800_000),
        "timestamp_ntz": F.timestamp_seconds(F.col("seq") * 1800 + 1_711_800_000).cast("timestamp_ntz"),
        "date": F.date_add(start, F.col("seq")),
        "struct": F.struct((F.col("seq") / 7).cast("int").alias("a"), (F.col("seq") % 7).alias("b")),
    }.get(kind)
    if sequence is None:
        sequence = F.col("seq").cast(kind)
    options = {**COMMON, "sequence_by": sequence, "track_history": ["name"]}
    assert rows(fold_scd2(df, hot_rows=10, **options)) == rows(fold_scd2(df, **options))


def test_text_sequence_is_refused(spark):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    with pytest.raises(TypeError, match="parse it"):
        fold_scd2(df, ["id"], F.col("seq").cast("string"))


def test_null_keys_and_null_sequences(spark):
    events = [(None, "a", "x", "APPEND", i) for i in range(40)] + [(1, "a", "x", "APPEND", None)]
    df = spark.createDataFrame(events, SCHEMA)
    assert rows(fold_scd1(df, **COMMON)) == [(None, "a", "x")]
    assert rows(fold_scd2(df, track_history=["name"], hot_rows=5, **COMMON)) == [(None, "a", "x", 0, None)]


@pytest.mark.parametrize("struct", [False, True], ids=["number", "struct"])
def test_segments_bound_the_rows_of_a_hot_key(spark, struct):
    """Half of the rows have one key and a burst of close sequences, or structs alike in their first field; copies of one
    row do not matter."""
    df = spark.range(0, 20_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN NULL ELSE id END AS id",
        "CASE WHEN id < 18000 THEN 1000.0 + id / 1e6 ELSE id * 1e6 END AS seq",
        "'v' AS name",
    )
    df = df.unionByName(spark.range(0, 9_000).selectExpr("NULL AS id", "5.0 AS seq", "'copy' AS name"))
    if struct:
        df = df.withColumn("seq", F.struct(F.lit(1).alias("a"), F.col("seq").alias("b")))
    events = prepare_events(df, ["id"], "seq")
    hot = hot_keys(events, ["id"], hot_rows=2000)
    assert [tuple(r) for r in hot.collect()] == [((None,), 2000)]
    cold, numbered = split_hot(events, ["id"], hot)
    assert cold.count() == 10_000 and numbered.count() == 19_000
    cuts = segment_cuts(numbered)
    sizes = [r["count"] for r in add_segments(numbered.drop("_limit").distinct(), cuts).groupBy("_segment").count().collect()]
    assert sum(sizes) == 10_001 and max(sizes) <= 2 * 2000 / SEGMENTS_A_LIMIT
    assert hot_keys(cold, ["id"], hot_rows=1).count() == 0


def jobs_of(spark, build):
    """Number of jobs that `build` runs."""
    group = f"jobs-{build.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_while_folds_and_positions_are_built(spark):
    df = spark.createDataFrame(random_events(seed=7), SCHEMA)

    def history():
        return fold_scd2(df, track_history=["name"], hot_rows=10, **COMMON)

    def positions():
        return with_position(df, ["seq"])

    def counted():
        return df.count()

    assert jobs_of(spark, history)[0] == 0 and jobs_of(spark, positions)[0] == 0
    assert jobs_of(spark, counted)[0] > 0  # the count of jobs does see them


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line), plan


def test_scd2_shuffles_and_sorts_once(spark):
    """Windows of a fold share one shuffle and one sort; without hot keys nothing else is left of the executed plan."""
    df = spark.createDataFrame(EVENTS, SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        count, plan = exchanges(fold_versions(prepare_events(df, **COMMON), ["id"], ["name"], hot_rows=None))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert count == 1, plan
    assert plan.count("Sort [") == 1, plan
    whole = fold_scd2(df, track_history=["name"], **COMMON)
    whole.collect()
    final = exchanges(whole)[1].split("Initial Plan")[0]
    assert "Union" not in final and "Join" not in final, final
    assert final.count("Sort [") == 1 and final.count("Window [") <= 4, final
