"""Landing folders: headers, nested fields, ledgers."""

import gzip
import json
import os

import pytest
from pyspark.sql import types as T

from tidemark.sources.files import ingest_json, read_csv, read_json
from tidemark.sources.landing import FileLedger, append_csv, header_groups, infer_csv_schema, list_files
from tidemark.sources.schema_store import SchemaStore
from tidemark.sources.schemas import infer_schema
from tidemark.streaming.append import run_append

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    return path


def read(spark, folder, **options):
    return sorted((tuple(r) for r in read_csv(spark, str(folder), SCHEMA, **options).collect()), key=repr)


def test_columns_are_found_by_name(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "a,b\n1,2\n")
    put(tmp_path / "in", "2.csv", "b,a\n20,10\n")
    put(tmp_path / "in", "3.csv.gz", '﻿A,"n,o",B\n100,x,200\n101,,201\n')
    put(tmp_path / "in", "4.csv", "b\n7\n")
    put(tmp_path / "in", "5.csv", "")
    put(tmp_path / "in", "6.csv", "a,b,a\n5,6,55\n")
    found = read(spark, tmp_path / "in")
    assert found == sorted(
        [(1, 2, None), (10, 20, None), (100, 200, '{"n,o":"x"}'), (101, 201, None), (None, 7, None), (5, 6, '{"a#3":"55"}')], key=repr
    )


def test_records_that_do_not_fit_stay_whole(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "b,a,c\n1,2,3\nx,4,5\n1,2,3,4\n")
    found = read(spark, tmp_path / "in")
    assert (2, 1, '{"c":"3"}') in found and (4, None, "x,4,5") in found and (2, 1, "1,2,3,4") in found
    assert read(spark, tmp_path / "in", rescue=False)[0][:1] and len(read(spark, tmp_path / "in", rescue=False)[0]) == 2


def test_empty_folder_other_separator_and_no_header(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert read(spark, tmp_path / "none") == []
    put(tmp_path / "in", "1.csv", "b;a\n1;2\n")
    assert read(spark, tmp_path / "in", sep=";") == [(2, 1, None)]
    put(tmp_path / "plain", "1.csv", "1,2\n")
    assert read(spark, tmp_path / "plain", header="false") == [(1, 2, None)]


def test_types_of_all_headers_are_inferred(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "a,b,t\n1,2,x\n")
    put(tmp_path / "in", "2.csv", "b,c,a\n2.5,z,9999999999\n")
    put(tmp_path / "in", "3.csv", "t,a\n5,3\n")
    assert infer_schema(spark, str(tmp_path / "in"), "csv").simpleString() == "struct<a:bigint,b:double,t:string,c:string>"
    files = [r.path for r in list_files(spark, str(tmp_path / "in"), "1.csv").collect()]
    assert infer_csv_schema(spark, files).simpleString() == "struct<a:int,b:int,t:string>"
    assert list(header_groups(spark, files)) == [("a", "b", "t")]


def test_stream_takes_each_file_once_and_tells_rewritten_ones(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "ck"))

    def run():
        return append_csv(spark, landing, table, checkpoint, SCHEMA, max_files_per_trigger=1)

    put(tmp_path / "in", "1.csv", "a,b\n1,2\n")
    put(tmp_path / "in", "2.csv", "b,a\n4,3\n")
    run()
    put(tmp_path / "in", "3.csv", "b,x\n6,y\n")
    put(tmp_path / "in", "1.csv", "a,b\n1000,2000\n")
    ledger = run()
    got = sorted((tuple(r) for r in spark.read.parquet(table).drop("batch").collect()), key=repr)
    assert got == sorted([(1, 2, None), (3, 4, None), (None, 6, '{"x":"y"}')], key=repr)
    os.remove(tmp_path / "in" / "2.csv")
    put(tmp_path / "in", "4.csv", "a,b\n0,0\n")
    status = {r.path[-5:]: r.status for r in ledger.compare(list_files(spark, landing)).collect()}
    assert status == {"1.csv": "rewritten", "2.csv": "gone", "3.csv": "unchanged", "4.csv": "new"}
    assert FileLedger(spark, str(tmp_path / "nowhere")).compare(list_files(spark, landing)).where("status = 'new'").count() == 3


NESTED = "a STRUCT<x: INT, in: STRUCT<p: STRING>>, l ARRAY<STRUCT<k: INT>>, m ARRAY<INT>, s STRING"
RECORDS = [
    ({"a": {"x": 1, "y": 2}}, {"a.y": "2"}),
    ({"a": {"x": 1, "in": {"p": "q", "r": [1, {"z": 2}]}}, "new": {"k": 1}}, {"new": '{"k":1}', "a.in.r": '[1,{"z":2}]'}),
    ({"l": [{"k": 1}, {"k": 2, "w": "v"}, None, {"u": 1}]}, {"l[1].w": "v", "l[3].u": "1"}),
    ({"l": [], "m": [1, 2], "s": "t"}, None),
    ({"a": None, "l": None}, None),
    ({"s": "x"}, None),
]


def kept(df):
    return sorted((None if r._rescued_data is None else json.loads(r._rescued_data) for r in df.collect()), key=repr)


@pytest.mark.parametrize("whole", [False, True])
def test_nested_unknown_fields_are_rescued(spark, tmp_path, whole):
    records = [record for record, _ in RECORDS]
    if whole:
        put(tmp_path / "in", "1.json", "\n " + json.dumps(records[:4], indent=2))
        put(tmp_path / "in", "2.json", json.dumps(records[4], indent=2))
        put(tmp_path / "in", "3.json", json.dumps(records[5:]))
    else:
        put(tmp_path / "in", "1.json", "\n".join(map(json.dumps, records)))
    options, schema = {"multiLine": "true"} if whole else {}, T.StructType.fromDDL(NESTED)
    batch = read_json(spark, str(tmp_path / "in"), schema, **options)
    wanted = sorted((unknown for _, unknown in RECORDS), key=repr)
    assert kept(batch) == wanted
    assert {r.a.x for r in batch.collect() if r.a} == {1}
    run_append(ingest_json(spark, str(tmp_path / "in"), schema, **options), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert kept(spark.read.parquet(str(tmp_path / "out"))) == wanted


def test_multi_line_files_that_do_not_parse_are_kept(spark, tmp_path):
    put(tmp_path / "in", "1.json", '[{"s": "x"},\n {"s": {"t": 1}}, 5]')
    put(tmp_path / "in", "2.json", "{broken\n")
    found = read_json(spark, str(tmp_path / "in"), T.StructType.fromDDL("s STRING"), multiLine="true").collect()
    assert ("x", None) in [(r.s, r._rescued_data) for r in found]
    assert {"5", "{broken\n"} <= {r._rescued_data for r in found}


def test_stored_schema_grows_from_new_files_only(spark, tmp_path):
    landing = tmp_path / "in"
    first = put(landing, "1.json", '{"a": 1, "s": {"x": 1}, "l": [{"k": 1}]}\n')
    store = SchemaStore(spark, str(tmp_path / "schema"), "json")
    assert store.schema() == T.StructType() and store.grow(str(landing)) == [first.as_uri().replace("file:///", "file:/")]
    before = store.schema()
    first.unlink()
    second = put(landing, "2.json", '{"a": 2.5, "b": "t", "s": {"y": true}, "l": [{"k": "z"}]}\n')
    opened = SchemaStore(spark, str(tmp_path / "schema"), "json").grow(str(landing))
    assert [os.path.basename(p) for p in opened] == [second.name]
    assert before.simpleString() == "struct<a:bigint,l:array<struct<k:bigint>>,s:struct<x:bigint>>"
    assert store.schema().simpleString() == (
        "struct<a:double,l:array<struct<k:string>>,s:struct<x:bigint,y:boolean>,b:string>"
    )
    assert store.grow(str(landing)) == [] and store.versions() == [1, 2]
    put(landing, "3.json", '{"a": 1}\n')
    assert len(store.grow(str(landing))) == 1 and store.versions() == [1, 2]


def test_stored_csv_schema(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "a,b\n1,2\n")
    store = SchemaStore(spark, str(tmp_path / "schema"), "csv")
    store.grow(str(tmp_path / "in"))
    put(tmp_path / "in", "2.csv", "c,a\nx,y\n")
    store.grow(str(tmp_path / "in"))
    assert store.schema().simpleString() == "struct<a:string,b:int,c:string>"
