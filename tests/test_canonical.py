"""MAP and VARIANT payloads in folds, de-duplication, change feeds and reconciliation; scopes of policies."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.canonical import orderable, restored
from tidemark.operators.latest import dedupe_by_key
from tidemark.operators.pairing import change_feed, reconcile
from tidemark.operators.protection import Policy, apply_policies
from tidemark.operators.scd import fold_scd1, fold_scd2

KIND = "id int, seq int, m map<string,int>, n struct<a: array<map<int,string>>, b: int>"


def table(spark, rows):
    return spark.createDataFrame(rows, KIND)


def test_forms_do_not_depend_on_entry_order_and_come_back(spark):
    nested = ([{2: "y", 1: "x"}, None, {}], 3)
    df = table(spark, [(1, 1, {"b": 2, "a": 1}, nested), (1, 1, {"a": 1, "b": 2}, ([{1: "x", 2: "y"}, None, {}], 3)), (2, 1, None, None)])
    formed, kinds = orderable(df)
    assert formed.distinct().count() == 2 and sorted(kinds) == ["m", "n"]
    back = restored(formed, kinds)
    assert back.schema["m"].dataType == df.schema["m"].dataType
    assert [r.m for r in back.orderBy("id").collect()] == [{"a": 1, "b": 2}, {"a": 1, "b": 2}, None]
    assert back.where("id = 1").first().n.a == [{1: "x", 2: "y"}, None, {}]
    plain = spark.range(3)
    assert orderable(plain)[0] is plain


def test_folds_carry_maps(spark):
    rows = [(1, 1, {"a": 1}, None), (1, 2, {"b": 1, "a": 2}, ([{1: "p"}], 1)), (1, 2, {"a": 2, "b": 1}, ([{1: "p"}], 1)), (2, 1, {}, None), (2, 3, None, None)]
    events = table(spark, rows)
    one = {r.id: r.m for r in fold_scd1(events, ["id"], "seq", except_columns=["seq"]).collect()}
    assert one == {1: {"a": 2, "b": 1}, 2: None}
    kept = {r.id: r.m for r in fold_scd1(events, ["id"], "seq", except_columns=["seq"], ignore_null_updates=True).collect()}
    assert kept == {1: {"a": 2, "b": 1}, 2: {}}
    for hot_rows in (1_000_000, 1):
        two = fold_scd2(events, ["id"], "seq", except_columns=["seq"], track_history=["m"], hot_rows=hot_rows).collect()
        assert sorted((r.id, r["__START_AT"], r["__END_AT"], str(r.m)) for r in two if r["__END_AT"]) == [
            (1, 1, 2, "{'a': 1}"),
            (2, 1, 3, "{}"),
        ]
        assert len(two) == 4


def test_deletes_may_look_into_maps(spark):
    events = table(spark, [(1, 1, {"gone": 0}, None), (1, 2, {"gone": 1}, None), (2, 1, {"gone": 0}, None)])
    assert [r.id for r in fold_scd1(events, ["id"], "seq", "m['gone'] = 1", ["seq"]).collect()] == [2]


def test_other_operators_take_maps(spark):
    old = table(spark, [(1, 1, {"a": 1, "b": 2}, None), (2, 1, {"a": 1}, None), (2, 0, {"z": 1}, None)])
    new = table(spark, [(1, 1, {"b": 2, "a": 1}, None), (2, 1, {"a": 2}, None), (2, 0, {"z": 1}, None)])
    assert dedupe_by_key(old, ["id"], ["seq"]).where("id = 2").first().m == {"a": 1}
    status = {(r.id, r.seq): r.status for r in reconcile(old, new, ["id", "seq"]).collect()}
    assert status == {(1, 1): "matched", (2, 1): "different", (2, 0): "matched"}
    feed = change_feed(old, new, ["id", "seq"]).collect()
    assert sorted((r._change_type, str(r.m)) for r in feed) == [("update_postimage", "{'a': 2}"), ("update_preimage", "{'a': 1}")]


def test_variants_fold(spark):
    rows = spark.createDataFrame([(1, 1, '{"b":1,"a":[2]}'), (1, 2, '{"a":"x"}'), (2, 1, None)], "id int, seq int, j string")
    events = rows.select("id", "seq", F.parse_json("j").alias("v"))
    found = fold_scd1(events, ["id"], "seq", except_columns=["seq"])
    assert found.schema["v"].dataType.simpleString() == "variant"
    assert {r.id: r.t for r in found.select("id", F.to_json("v").alias("t")).collect()} == {1: '{"a":"x"}', 2: None}


def test_scopes_are_names_not_prefixes(spark):
    policy = Policy("p", "mask", ("pii_type", "email"), "mask_email", scope="main.gold")
    assert policy.covers("Main.Gold.customers") and policy.covers("main.gold")
    assert not policy.covers("main.golden.customers") and not policy.covers("main")
    assert Policy("q", "mask", ("a", None)).covers(None)
    df = spark.createDataFrame([("a@b.c",)], "e string")
    with pytest.raises(ValueError):
        apply_policies(df, {}, {"e": {"pii_type": "email"}}, [policy], ["x"])
    assert apply_policies(df, {}, {"e": {"pii_type": "email"}}, [policy], ["x"], table="main.gold.t").first().e == "****@b.c"
    assert apply_policies(df, {}, {"e": {"pii_type": "email"}}, [policy], ["x"], table="main.silver.t").first().e == "a@b.c"
