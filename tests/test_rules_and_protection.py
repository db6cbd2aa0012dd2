"""Quality rules, masks, policies, audit; sources and the synthetic feed."""

import pytest
from helpers import rows
from pyspark.sql import Observation, functions as F, types as T

from tidemark.functions.hashing import record_hash
from tidemark.functions.masks import MASKS, register_masks
from tidemark.operators.protection import (
    AUDIT_COLUMNS,
    Control,
    MaskedColumn,
    Policy,
    apply_column_masks,
    apply_policies,
    apply_row_filter,
    audit_summary,
    protection_audit,
    secured_view,
)
from tidemark.operators.quality import expect_or_drop, expectation_metrics, observe_expectations, rejected_rows
from tidemark.plans import changes, customers, trips
from tidemark.sources import synthetic
from tidemark.sources.files import read_csv, read_json
from tidemark.sources.schemas import evolve_schema, infer_schema, merge_schema_hints

RULES = {"has_id": "id IS NOT NULL", "known": "op IN ('A', 'B')", "positive": "n > 0"}


@pytest.fixture
def judged(spark):
    return spark.createDataFrame(
        [(1, "A", 1), (None, "A", 1), (2, None, 1), (None, "C", 0), (3, "B", None), (4, "B", 5)],
        "id int, op string, n int",
    )


def test_rules(judged):
    kept, rejected = expect_or_drop(judged, RULES), rejected_rows(judged, RULES)
    assert rows(kept) == [(1, "A", 1), (4, "B", 5)]
    assert kept.count() + rejected.count() == judged.count()
    assert {tuple(r["failed_rules"]) for r in rejected.collect()} == {
        ("has_id",),
        ("known",),
        ("positive",),
        ("has_id", "known", "positive"),
    }
    assert rows(expectation_metrics(judged, RULES)) == [("has_id", 4, 2), ("known", 4, 2), ("positive", 4, 2)]
    seen = Observation("rules")
    expect_or_drop(observe_expectations(judged, RULES, seen), RULES).collect()
    assert seen.get == {"rows": 6, "has_id": 2, "known": 2, "positive": 2}
    assert rows(expect_or_drop(judged, {"a": "id = 1 OR id = 4", "b": "n > 1"})) == [(4, "B", 5)]


MASK_CASES = {
    "mask_email": [
        ("a@b.com", "****@b.com"),
        ("ab", "****"),
        ("a@b@c", "****"),
        ("", "****"),
        ("@x", "****@x"),
        ("a@", "****@"),
        (None, None),
    ],
    "mask_phone": [
        ("555-123-9876", "XXX-XXX-9876"),
        ("1234", "XXX-XXX-1234"),
        ("12", "XXX-XXX-XXXX"),
        ("", "XXX-XXX-XXXX"),
        (None, None),
    ],
    "mask_name": [("Ann", "A****"), ("É", "É****"), ("", "****"), (None, None)],
    "mask_address": [("1 Oak", "****"), ("", "****"), (None, None)],
    "mask_postal_code": [("94105", "941***"), ("123", "****"), ("", "****"), (None, None)],
}


@pytest.mark.parametrize("name", list(MASK_CASES))
def test_masks(spark, name):
    df = spark.createDataFrame(MASK_CASES[name], "v string, expected string")
    register_masks(spark)
    both = df.select("expected", MASKS[name](F.col("v")).alias("a"), F.expr(f"{name}(v)").alias("b"))
    assert all(r["a"] == r["expected"] == r["b"] for r in both.collect())


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann@x.org", "FR", "Ann"), (2, None, "US", ""), (3, "bo@y.org", "US", "Bo")],
        "id int, email string, country string, name string",
    )


def test_masks_by_group(people):
    bindings = {"email": "mask_email", "name": MASKS["mask_name"]}
    assert apply_column_masks(people, bindings, ["admins"]) is people
    hidden = [(1, "****@x.org", "FR", "A****"), (2, None, "US", "****"), (3, "****@y.org", "US", "B****")]
    assert rows(apply_column_masks(people, bindings, ["analysts"])) == hidden
    view = [MaskedColumn("email", "mask_email", ("analysts",)), MaskedColumn("name", "mask_name", ("analysts",))]
    assert rows(secured_view(people, view, ["analysts"])) == hidden
    assert rows(secured_view(people, view, [])) == hidden
    assert rows(secured_view(people, view, ["guests"], deny_by_default=False)) == rows(people)
    assert rows(secured_view(people, view, ["analysts", "admins"])) == rows(people)
    with pytest.raises(ValueError, match="no such column"):
        apply_column_masks(people, {"nope": "mask_name"})
    with pytest.raises(ValueError, match="unknown mask"):
        apply_column_masks(people, {"email": "nope"})


def test_row_filter(spark, people):
    assert [r[0] for r in rows(apply_row_filter(people, "country", ["US"]))] == [2, 3]
    grants = spark.createDataFrame([("FR",), ("FR",), (None,)], "country string")
    assert [r[0] for r in rows(apply_row_filter(people, "country", grants))] == [1]
    assert apply_row_filter(people, "country", []).count() == 0
    assert apply_row_filter(people, "country", grants.where("false")).count() == 0


def test_policies(people):
    tags = {
        "email": {"pii_type": "email"},
        "name": {"pii_type": "name"},
        "country": {"geo_region": "true"},
        "id": {"pii_type": "identifier"},
    }
    table = {"sensitivity": "pii"}

    def run(groups, **options):
        return rows(
            apply_policies(
                people, table, tags, customers.POLICIES, groups, ["US"], customers.GOVERNED_TAGS, **options
            )
        )

    assert run(["analysts"]) == [(2, None, "US", "****"), (3, "****@y.org", "US", "B****")]
    assert run(["admins"]) == rows(people)
    assert len(run(["analysts"], deny_by_default=False)) == 3
    assert run(["us_analysts"], deny_by_default=False) == [(2, None, "US", ""), (3, "bo@y.org", "US", "Bo")]
    assert rows(apply_policies(people, {}, tags, customers.POLICIES, [], ["US"])) == rows(people)
    with pytest.raises(ValueError, match="allowed values"):
        apply_policies(people, {"sensitivity": "odd"}, tags, [], [], governed_tags=customers.GOVERNED_TAGS)
    region = Policy("region", "filter", ("geo_region", None))
    two = {**tags, "name": {"geo_region": "true"}}
    with pytest.raises(ValueError, match="name one column"):
        apply_policies(people, table, two, [region], [])
    clash = [Policy("a", "mask", ("pii_type", "email"), "mask_email"), Policy("b", "mask", ("pii_type", "email"), "mask_name")]
    with pytest.raises(ValueError, match="differently"):
        apply_policies(people, table, tags, clash, [])


def test_masked_plan_has_no_python_and_filter_reaches_scan(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    shown = apply_column_masks(apply_row_filter(stored, "country", ["US"]), {"email": "mask_email"})
    plan = shown.select("id", "email")._jdf.queryExecution().executedPlan().toString()
    assert "PythonEval" not in plan and "EqualTo(country,US)" in plan and "name" not in plan.split("ReadSchema")[1]


def test_audit(people):
    controls = [
        Control("column_mask", "email", "MASK email", mask="mask_email"),
        Control("column_mask", "name", "MASK name", mask=lambda c: c),
        Control("row_filter", "country", "KEEP US", keep="country = 'US'"),
    ]
    audit = protection_audit(people, controls, "demo")
    assert tuple(audit.columns) == AUDIT_COLUMNS and all(kind == "string" for _, kind in audit.dtypes)
    lines = {r["target"]: (r["status"], r["message"]) for r in audit.collect()}
    assert lines == {
        "email": ("OK", "rows seen 3, masked 2 of 2"),
        "name": ("FAIL", "rows seen 3, masked 0 of 3"),
        "country": ("OK", "rows seen 3, hidden 1 of 3"),
    }
    assert rows(audit_summary(audit)) == [("column_mask", "FAIL", 1), ("column_mask", "OK", 1), ("row_filter", "OK", 1)]


def test_bad_records(spark, tmp_path):
    lines = ['{"id":1,"op":"A","extra":{"x":1}}', "{bad", '{"id":"zz","op":"B"}']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{tmp_path}/j")
    got = rows(read_json(spark, f"{tmp_path}/j", T.StructType.fromDDL("id int, op string")))
    unknown = '{"extra":"{\\"x\\":1}"}'  # a field without a column is kept as text
    assert got == sorted([(1, "A", unknown), (None, None, "{bad"), (None, "B", lines[2])], key=repr)
    spark.createDataFrame([("a,b\n1,2\nx,4\n5,6,7",)], "value string").coalesce(1).write.text(f"{tmp_path}/c")
    got = rows(read_csv(spark, f"{tmp_path}/c", T.StructType.fromDDL("a int, b int")))
    assert got == sorted([(1, 2, None), (None, 4, "x,4"), (5, 6, "5,6,7")], key=repr)


def test_schemas(spark, tmp_path):
    spark.range(50).selectExpr("id", "'2024-01-01' AS day").write.json(f"{tmp_path}/one")
    known = infer_schema(spark, f"{tmp_path}/one", "json", sampling_ratio=0.5)
    assert known.simpleString() == "struct<day:string,id:bigint>"
    hinted = merge_schema_hints(known, "DAY DATE, later INT")
    assert hinted.simpleString() == "struct<day:date,id:bigint,later:int>"
    seen = T.StructType.fromDDL("id string, more double")
    assert evolve_schema(known, seen).simpleString() == "struct<day:string,id:bigint,more:double>"
    spark.range(3).write.option("header", "true").csv(f"{tmp_path}/csv")
    assert infer_schema(spark, f"{tmp_path}/csv", "csv").simpleString() == "struct<id:int>"


def test_trips_survive_bad_values(spark):
    names = [name for name, _, _ in trips.TRIP_COLUMNS]
    good = dict.fromkeys(names, "1.0") | {
        "tpep_pickup_datetime": "2019-01-01 00:10:00",
        "tpep_dropoff_datetime": "2019-01-01 00:20:00",
        "fare_amount": "7.25",
    }
    data = [good, good | {"fare_amount": "8.26"}, good | {"VendorID": "x"}, good | {"fare_amount": "-1"}]
    raw = trips.raw_trips(spark.createDataFrame([tuple(d[n] for n in names) for d in data], names))
    clean = trips.clean_trips(raw)
    assert clean.columns == [out for _, out, _ in trips.TRIP_COLUMNS] + ["_ingested_at", "_processed_at"]
    summary = trips.daily_summary(clean).collect()
    assert [tuple(r)[1:] for r in summary] == [(2, 7.76, 1.0, 1.0)]


def test_customer_normalisation(spark):
    source = spark.createDataFrame(
        [(1, " Ann ", None, " A@X.ORG", "1", " s ", "new YORK ", "ny", " US", "NA", 123, " F")],
        ", ".join(f"{c} {'bigint' if c in ('customerID', 'postal_zip_code') else 'string'}" for c in customers.SOURCE_COLUMNS),
    )
    silver = customers.normalize_customers(customers.bronze_customers(source, "dev", "src"))
    row = silver.collect()[0]
    assert (row["city"], row["state"], row["email_address"], row["gender"]) == ("New York", "NY", "a@x.org", "f")
    assert row["full_name"] == "Ann" and row["postal_zip_code"] == "123"
    text = "1||Ann||||Ann||a@x.org||1||s||New York||NY||US||NA||123||f"
    assert row["record_hash"] == spark.sql(f"SELECT sha2('{text}', 256)").first()[0]
    assert silver.select(record_hash(["last_name"]).alias("h")).first()[0] == spark.sql("SELECT sha2('', 256)").first()[0]


def test_synthetic_feed(spark):
    people, bought = synthetic.generate_cdc_feed(spark, customers=20_000, transactions=2_000, seed=1)
    again, _ = synthetic.generate_cdc_feed(spark, customers=20_000, transactions=2_000, seed=1)
    assert people.exceptAll(again.repartition(3)).isEmpty()
    total, missing, no_operation, deletes = people.agg(
        F.count("*"),
        *[F.expr(f"count_if({what})") for what in ("id IS NULL", "operation IS NULL", "operation = 'DELETE'")],
    ).first()
    assert total == 20_000 and 0.015 < missing / total < 0.025
    assert 0.007 < no_operation / total < 0.016 and 0.09 < deletes / total < 0.13
    assert bought.count() == 2_000
    known = people.select("id").where("id IS NOT NULL").distinct()
    assert bought.where("customer_id IS NOT NULL").join(known, bought["customer_id"] == known["id"], "left_anti").isEmpty()
    clean = changes.clean_changes(people, rescued=False)
    assert clean.where(changes.event_time().isNull()).isEmpty()
