"""Types found from all rows, and gzip files without their suffix."""

import datetime as dt
import gzip
import os
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

import tessera as ts
from tessera.session import first_file, unique_name
from tessera.sources.detect import column_types, json_types
from tessera.sources.external import detect_schema


def types_of(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    return column_types(df)["v"].dataType.simpleString()


@pytest.mark.parametrize("values,expected", [
    (["1", "-5", None, ""], "bigint"), (["1", "2.50"], "decimal(2,1)"), (["9223372036854775807"], "bigint"),
    (["1", "9223372036854775808"], "decimal(19,0)"), (["12345678901234567890", "0.000001"], "decimal(26,6)"),
    (["9" * 30, "0." + "1" * 9], "string"), (["1", "1e5"], "double"), (["1.5", "NaN"], "double"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-01-05", "2024-02-29"], "date"),
    (["2024-01-05", "2023-02-29"], "string"), (["2024-01-05", "2024-01-05 10:00:00"], "timestamp_ntz"),
    (["2024-01-05T10:00:00.123456"], "timestamp_ntz"), (["2024-01-05T10:00:00Z", "2024-01-05 10:00:00+02:00"], "timestamp"),
    (["2024-01-05T10:00:00Z", "2024-01-05 10:00:00"], "string"), ([None, "", " "], "string"), (["x", "1"], "string"),
    (["+007", "7"], "bigint"), ([".5", "5."], "decimal(2,1)"), (["0"], "bigint"), (["0.0"], "decimal(1,0)"),
    (["9" * 38], "decimal(38,0)"), (["9" * 39], "string"), (["-0.10"], "decimal(1,1)")])
def test_types_of_texts(spark, values, expected):
    assert types_of(spark, *values) == expected


def test_no_rows_and_no_columns(spark):
    assert column_types(spark.createDataFrame([], "a string, b string")).simpleString() == "struct<a:string,b:string>"
    assert json_types(spark.createDataFrame([], "value string")).fields == []
    assert column_types(spark.range(3).select()).fields == []


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(allow_nan=False, allow_infinity=False, places=None, min_value=Decimal(-10) ** 21, max_value=Decimal(10) ** 20)
                .map(lambda d: f"{d:f}").filter(lambda s: len(s) < 37), min_size=1, max_size=12))
def test_decimals_keep_every_digit(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = column_types(df)["v"].dataType
    if not isinstance(found, T.StringType):
        back = [r[0] for r in df.selectExpr(f"cast(trim(v) as {found.simpleString()})").collect()]
        assert [Decimal(b) for b in back] == [Decimal(v) for v in values]


def test_formats_of_the_reader(spark):
    df = spark.createDataFrame([("31/12/2020", "31.12.2020 10:05")], "d string, t string")
    found = column_types(df, {"dateFormat": "dd/MM/yyyy", "timestampFormat": "dd.MM.yyyy HH:mm"})
    assert [f.dataType.simpleString() for f in found.fields] == ["date", "timestamp_ntz"]


def text_file(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_a_rare_wide_value_counts(spark, scratch):
    path = scratch("wide")
    for i in range(4):
        text_file(spark, path, [f"{i},{i}.5,2024-01-0{i + 1}"] * 50)
    text_file(spark, path, ["99999999999999999999,0.123456789012,2024-01-09 08:00:00"])
    df = ts.read_external(spark, ts.ExternalData([path], "CSV", autodetect=True))
    assert dict(df.dtypes) == {"_c0": "decimal(20,0)", "_c1": "decimal(13,12)", "_c2": "timestamp_ntz"}
    assert df.where("_c0 > 5").collect()[0]["_c1"] == Decimal("0.123456789012") and df.count() == 201


def test_nested_json(spark, scratch):
    path = text_file(spark, scratch("nested"), [
        '{"id":1,"s":{"d":"2024-01-05","x":1.50,"deep":[{"t":"2024-01-05 10:00:00","k":"a"}]},"n":null,"days":["2024-01-01"]}',
        '{"id":12345678901234567890,"s":{"d":"2024-02-05","deep":[]},"days":[],"mixed":1}',
        '{"s":{"x":100,"deep":[{"t":"2024-01-06 10:00:00"}]},"days":["2024-01-01","2024-05-05"],"mixed":"one"}'])
    found = detect_schema(spark, ts.ExternalData([path], "JSON", autodetect=True))
    want = {"days": "array<date>", "mixed": "string", "n": "string"}
    got = {f.name: f.dataType.simpleString() for f in found.fields}
    assert {k: got[k] for k in want} == want
    assert got["s"].startswith("struct<d:date,deep:array<struct<k:string,t:timestamp_ntz>>,x:decimal(")
    df = ts.read_external(spark, ts.ExternalData([path], "JSON", autodetect=True))
    rows = sorted(df.collect(), key=lambda r: r["id"] or 0)
    assert rows[2]["id"] == 12345678901234567890 and rows[1]["s"]["d"] == dt.date(2024, 1, 5)
    assert rows[0]["days"] == [dt.date(2024, 1, 1), dt.date(2024, 5, 5)] and rows[1]["s"]["x"] == Decimal("1.50")


def test_broken_json_does_not_decide(spark, scratch):
    path = text_file(spark, scratch("broken"), ['{"a":1}', "{oops", '{"a":2}'])
    ext = ts.ExternalData([path], "JSON", autodetect=True, max_bad_records=1)
    assert sorted(r["a"] for r in ts.read_external(spark, ext).collect()) == [1, 2]


def test_registered_types_are_kept(spark, scratch):
    path = text_file(spark, scratch("reg"), ["1,2024-01-05", "2,2024-01-06"])
    name = unique_name("auto")
    ts.define_external_table(spark, name, ts.ExternalData([path], "CSV", autodetect=True))
    assert dict(spark.table(name).dtypes) == dict(ts.read_table(spark, name).dtypes) == {"_c0": "bigint", "_c1": "date"}
    text_file(spark, path, ["x,2024-01-07"])
    with pytest.raises(Exception, match="bad record"):
        ts.read_table(spark, name).collect()


# -------------------------------------------------------------------------- gzip

def gzip_file(path, name, lines, end="\n"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as f:
        for part in (lines[:1], lines[1:]):      # two members
            f.write(gzip.compress("".join(x + end for x in part).encode()))
    return path


@pytest.mark.parametrize("budget", [0, 1, None])
@pytest.mark.parametrize("fmt,lines", [("CSV", ["1,a", "2,b"]), ("JSON", ['{"k":1,"v":"a"}', '{"k":2,"v":"b"}'])])
def test_gzip_without_suffix(spark, scratch, fmt, lines, budget):
    path = gzip_file(scratch("odd"), "part", lines)
    gzip_file(path, "more.gz", [lines[0].replace("1", "3")])
    ext = ts.ExternalData([path], fmt, schema="k int, v string", compression="GZIP", max_bad_records=budget)
    df = ts.read_external(spark, ext)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a"), (2, "b"), (3, "a")]
    assert df.count() == 3 and ts.read_external(spark, ext).where("k = 2").select("v").collect()[0][0] == "b"


def test_gzip_rules_hold(spark, scratch):
    path = gzip_file(scratch("bad"), "part", ["k,v", "1,a", "x,b", "", "3,c,d"], end="\r\n")
    read = lambda **kw: ts.read_external(spark, ts.ExternalData(
        [path], "CSV", schema="k int, v string", compression="GZIP", options={"header": "true"}, **kw))
    assert [tuple(r) for r in read(max_bad_records=2).collect()] == [(1, "a")]
    with pytest.raises(Exception, match="bad record"):
        read().collect()
    assert sorted(tuple(r) for r in read(max_bad_records=1, ignore_unknown_values=True).collect()) == [(1, "a"), (3, "c")]


def test_gzip_in_partition_folders(spark, scratch):
    path = scratch("hivegz")
    gzip_file(f"{path}/p=01", "a", ["1", "2"])
    gzip_file(f"{path}/p=02", "b.gz", ["3"])
    for mode, want in (("STRINGS", {("01", 1), ("01", 2), ("02", 3)}), ("AUTO", {(1, 1), (1, 2), (2, 3)})):
        ext = ts.ExternalData([path], "CSV", schema="k int", compression="GZIP", hive_partitioning=ts.HivePartitioning(path, mode))
        assert {(r["p"], r["k"]) for r in ts.read_external(spark, ext).collect()} == want


def test_gzip_types_are_found(spark, scratch):
    path = gzip_file(scratch("autogz"), "data", ["id,price", "1,2.50", "2,1000000.125"])
    ext = ts.ExternalData([path], "CSV", autodetect=True, compression="GZIP", options={"header": "true"})
    assert dict(ts.read_external(spark, ext).dtypes) == {"id": "bigint", "price": "decimal(10,3)"}
    assert ts.read_external(spark, ext).count() == 2


def test_what_is_not_gzip_is_refused(spark, scratch):
    path = text_file(spark, scratch("plain"), ["1,a"])
    ext = ts.ExternalData([path], "CSV", schema="k int, v string", compression="GZIP", max_bad_records=None)
    with pytest.raises(Exception, match="declared GZIP"):
        ts.read_external(spark, ext).collect()
    with pytest.raises(ValueError, match="without the .gz suffix"):
        ts.define_external_table(spark, unique_name("nogz"), ext)
    with pytest.raises(ValueError, match="not compressed as a whole"):
        ts.read_external(spark, ts.ExternalData([path], "PARQUET", compression="GZIP"))
    with pytest.raises(ValueError, match="line by line"):
        ts.read_external(spark, ts.ExternalData([path], "CSV", schema="k int", compression="GZIP", options={"multiLine": "true"}))


def test_first_file_of_many(spark, scratch):
    path = text_file(spark, scratch("first"), ["a"])
    assert first_file(spark, [path]).rsplit("/", 1)[-1].startswith("part-")
    assert first_file(spark, [f"{path}/part-*", path]) and first_file(spark, [path + "_none", path + "/x*"]) is None
