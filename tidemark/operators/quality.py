"""Named row rules. A rule passes only when its condition is TRUE; NULL fails it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.common import all_of, as_predicate

Rules = Mapping[str, str]


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that pass every rule: one filter over this frame's (output) columns, for batch and stream."""
    return df.where(all_of([F.expr(f"({condition})") for condition in rules.values()]))


def rejected_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows `expect_or_drop` leaves out, with the names of the rules each one failed."""
    failed = [F.when(~as_predicate(condition), F.lit(name)) for name, condition in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failed))).where(F.size("failed_rules") > 0)


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, passed, failed) for every rule, from one aggregation over the data.

    A row that fails two rules counts against both.
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(as_predicate(rules[name])).alias(f"_passed_{i}") for i, name in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"_passed_{i}").alias("passed"),
            (F.col("_rows") - F.col(f"_passed_{i}")).alias("failed"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*lines)))


def observe_expectations(df: DataFrame, rules: Rules, observation: str | Observation) -> DataFrame:
    """The same frame, reporting failures per rule while it runs: no extra pass over the data.

    Batch: give an `Observation` and read it after the action. Stream: give a name and read
    `query.lastProgress["observedMetrics"]` or a listener.
    """
    failures = [F.count_if(~as_predicate(condition)).alias(name) for name, condition in rules.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *failures)


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, rule, passed, failed) of every micro-batch that a stream has checked and written to `folder`."""
    kinds = "rule string, passed long, failed long, batch long"
    return spark.read.schema(kinds).parquet(folder).select("batch", "rule", "passed", "failed")
