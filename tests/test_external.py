"""External files: schema, bad-record budget, unknown values, compression,
Hive folders, decimal targets, catalog registration and write refusal."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.session import unique_name
from tessera.sources import TooManyBadRecords


def lines(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    return path


CSV_ROWS = ["1,a", "2,b", "x,c", "3,d,extra", "4"]


def test_csv_budget(spark, scratch):
    path = lines(spark, scratch("csv"), CSV_ROWS)
    strict = ts.ExternalData([path], "CSV", schema="a int, b string", max_bad_records=3)
    got = sorted(tuple(r) for r in ts.read_external(spark, strict).collect())
    assert got == [(1, "a"), (2, "b")]          # broken type, extra token, short row: bad
    with pytest.raises(TooManyBadRecords):
        ts.read_external(spark, ts.ExternalData([path], "CSV", schema="a int, b string",
                                                max_bad_records=2))
    # the verdict does not depend on which columns the caller reads
    only_a = ts.read_external(spark, strict).select("a")
    assert sorted(r["a"] for r in only_a.collect()) == [1, 2]


def test_csv_ignore_unknown_values(spark, scratch):
    path = lines(spark, scratch("csv"), CSV_ROWS)
    ext = ts.ExternalData([path], "CSV", schema="a int, b string", max_bad_records=1,
                          ignore_unknown_values=True)
    got = sorted(tuple(r) for r in ts.read_external(spark, ext).collect())
    assert got == [(1, "a"), (2, "b"), (3, "d"), (4, None)]


def test_json_unknown_keys(spark, scratch):
    path = lines(spark, scratch("json"), ['{"a": 1, "b": "x"}', '{"a": 2, "b": "y", "c": 1}',
                                          '{"a": "bad"}', "not json", ""])
    ext = ts.ExternalData([path], "NEWLINE_DELIMITED_JSON", schema="a int, b string",
                          max_bad_records=3)
    assert [tuple(r) for r in ts.read_external(spark, ext).collect()] == [(1, "x")]
    tolerant = ts.ExternalData([path], "NEWLINE_DELIMITED_JSON", schema="a int, b string",
                               max_bad_records=2, ignore_unknown_values=True)
    assert sorted(tuple(r) for r in ts.read_external(spark, tolerant).collect()) == \
        [(1, "x"), (2, "y")]
    # no budget: nothing runs on reading, the first action meets the bad record
    none_allowed = ts.read_external(spark, ts.ExternalData([path], "JSON", schema="a int, b string"))
    with pytest.raises(Exception, match="bad record"):
        none_allowed.collect()


def test_autodetect_and_schema_required(spark, scratch):
    path = scratch("auto")
    spark.createDataFrame([(1, 2.5)], "a int, b double").write.option("header", True).csv(path)
    df = ts.read_external(spark, ts.ExternalData([path], "CSV", autodetect=True,
                                                 options={"header": "true"}))
    assert dict(df.dtypes) == {"a": "bigint", "b": "decimal(2,1)"}
    with pytest.raises(ValueError):
        ts.read_external(spark, ts.ExternalData([path], "CSV"))


def test_gzip_hive_strings(spark, scratch):
    path = scratch("hive")
    df = spark.createDataFrame([(1, "01"), (2, "02")], "a int, p string")
    df.write.partitionBy("p").option("compression", "gzip").csv(path)
    auto = ts.read_external(spark, ts.ExternalData(
        [path], "CSV", schema="a int", compression="GZIP",
        hive_partitioning=ts.HivePartitioning(path, "AUTO")))
    assert dict(auto.dtypes)["p"] == "int"
    strings = ts.read_external(spark, ts.ExternalData(
        [path], "CSV", schema="a int", compression="GZIP",
        hive_partitioning=ts.HivePartitioning(path, "STRINGS")))
    assert sorted(tuple(r) for r in strings.collect()) == [(1, "01"), (2, "02")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_decimal_targets(spark, scratch):
    path = lines(spark, scratch("dec"), ["1,1.5,1.1234567891", "2,2.25,3"])
    ext = ts.ExternalData([path], "CSV", schema="k int, n decimal(38,18), w decimal(38,18)",
                          decimal_target_types=["NUMERIC", "BIGNUMERIC", "STRING"])
    df = ts.read_external(spark, ext)
    assert dict(df.dtypes) == {"k": "int", "n": "decimal(38,9)", "w": "decimal(38,18)"}
    assert df.orderBy("k").first()["w"] == Decimal("1.1234567891")
    path2 = lines(spark, scratch("dec2"), ["1,123456789012345678901234567890.5"])
    df2 = ts.read_external(spark, ts.ExternalData(
        [path2], "CSV", schema="k int, n decimal(38,18)",
        decimal_target_types=["BIGNUMERIC", "STRING"]))
    assert dict(df2.dtypes)["n"] == "string"


def test_external_table_refuses_writes(spark, scratch):
    path = scratch("ext")
    spark.createDataFrame([(1, "a")], "a int, b string").write.json(path)
    name = unique_name("ext")
    ext = ts.ExternalData([path], "NEWLINE_DELIMITED_JSON", schema="a int, b string")
    assert ts.define_external_table(spark, name, ext, description="files", labels={"k": "v"})
    assert not ts.define_external_table(spark, name, ext)
    res = ts.write_table(spark.createDataFrame([(2, "b")], "a int, b string"), name,
                         mode="append")
    assert res.status == "skipped_external"
    assert [tuple(r) for r in ts.read_table(spark, name).collect()] == [(1, "a")]
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]


def test_json_parse_options_apply(spark, scratch):
    path = lines(spark, scratch("jsonopt"), ['{"a": 1, "t": "05/01/2024 10:30"}'])
    ext = ts.ExternalData([path], "JSON", schema="a int, t timestamp_ntz",
                          options={"timestampNTZFormat": "dd/MM/yyyy HH:mm"})
    import datetime as dt
    assert ts.read_external(spark, ext).first()["t"] == dt.datetime(2024, 1, 5, 10, 30)


def test_several_source_uris(spark, scratch):
    a = lines(spark, scratch("uri_a"), ["1,a", "2,b"])
    b = lines(spark, scratch("uri_b"), ["3,c", "bad,row"])
    ext = ts.ExternalData([a, b], "CSV", schema="k int, v string", max_bad_records=1)
    assert sorted(tuple(r) for r in ts.read_external(spark, ext).collect()) == [
        (1, "a"), (2, "b"), (3, "c")]
    jext = ts.ExternalData([lines(spark, scratch("uj_a"), ['{"k": 1}']),
                            lines(spark, scratch("uj_b"), ['{"k": 2}'])], "JSON", schema="k int")
    assert sorted(r["k"] for r in ts.read_external(spark, jext).collect()) == [1, 2]
