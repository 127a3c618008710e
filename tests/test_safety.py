"""Rows that must not get lost: partition values, lifetimes, failed jobs, settings, external rules."""

import datetime as dt
import os
import threading

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.operators.tables import apply_column_overrides, table_layout, table_properties
from tessera.session import scratch_path, unique_name

MONTH = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, d date")


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


@pytest.fixture()
def zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", old)


# -------------------------------------------------------------- partition values

def test_null_partition_is_replaced_alone(spark, table_name):
    df = months(spark, (1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5)), (3, None))
    ts.write_table(df, table_name, partitioning=MONTH)
    ts.replace_partition(months(spark, (9, None)), table_name, None)
    assert sorted(r["k"] for r in ts.read_table(spark, table_name).collect()) == [1, 2, 9]
    assert [r["k"] for r in ts.read_table(spark, table_name, partition_value=None).collect()] == [9]
    ts.replace_partition(months(spark).limit(0), table_name, None)
    assert sorted(r["k"] for r in ts.read_table(spark, table_name).collect()) == [1, 2]


def test_empty_replace_empties_one_partition(spark, table_name, scratch):
    df = months(spark, (1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5)))
    ts.write_table(df, table_name, partitioning=MONTH, path=scratch("empties"))
    ts.replace_partition(df.limit(0), table_name, dt.date(2024, 1, 1))
    ts.write_table(months(spark, (7, dt.date(2024, 1, 9))), table_name, mode="append")
    assert sorted(r["k"] for r in ts.read_table(spark, table_name).collect()) == [2, 7]


@pytest.mark.parametrize("unit", ["HOUR", "DAY", "MONTH", "YEAR"])
def test_timestamp_partitions_are_utc(spark, zone, unit):
    zone("America/New_York")
    rows = [(i, f"2024-01-{d:02d} {h:02d}:30:00+00:00") for i, (d, h) in enumerate([(1, 0), (1, 3), (2, 23), (31, 23)])]
    df = spark.createDataFrame(rows, "k int, s string").select("k", F.col("s").cast("timestamp").alias("t"))
    name = unique_name("utc")
    ts.write_table(df, name, partitioning=ts.PartitionSpec("t", "timestamp", ts.TimePartitioning(unit)))
    for z in ("Asia/Tokyo", "UTC"):
        zone(z)
        got = ts.read_table(spark, name, between=(dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 2, 23, 30)))
        assert sorted(r["k"] for r in got.collect()) == [1, 2]
        aware = dt.timezone(dt.timedelta(hours=-5))
        got = ts.read_table(spark, name, between=(dt.datetime(2023, 12, 31, 22, tzinfo=aware),
                                                  dt.datetime(2024, 1, 2, 18, 30, tzinfo=aware)))
        assert sorted(r["k"] for r in got.collect()) == [1, 2]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(-2**63, 2**63 - 2), st.integers(1, 2**63 - 1), st.integers(1, 2**40),
       st.lists(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=20))
def test_range_buckets_are_exact(spark, start, width, interval, keys):
    spec = ts.PartitionSpec("k", "int64", ts.RangePartitioning(start, min(start + width, 2**63 - 1), interval))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = df.select("k", spec.derive(F.col("k"), T.LongType()).alias("b")).collect()
    assert [(r["k"], r["b"]) for r in got] == [(k, spec.derive_python(k)) for k in keys]


def test_dotted_names(spark, table_name):
    spec = ts.PartitionSpec("a.b", "date", ts.TimePartitioning("DAY"))
    df = spark.createDataFrame([(1, dt.date(2024, 1, 5))], "k int, `a.b` date")
    ts.write_table(df, table_name, partitioning=spec, clustering=["k"])
    day = dt.date(2024, 1, 5)
    assert ts.read_table(spark, table_name, between=(day, day)).count() == 1


# ---------------------------------------------------------------------- lifetimes

def test_expired_rows_stay_away(spark, table_name, scratch):
    path = scratch("expiry")
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH", 86_400_000))
    old, new = dt.date(2024, 1, 5), dt.date(2030, 1, 5)
    ts.write_table(months(spark, (1, old), (2, new)), table_name, partitioning=spec, path=path)
    assert ts.expire_partitions(spark, table_name, dt.datetime(2025, 1, 1)) == ["2024-01-01"]
    assert len(files(path)) == 1
    ts.write_table(months(spark, (3, old)), table_name, mode="append")
    assert sorted(r["k"] for r in ts.read_table(spark, table_name).collect()) == [2, 3]


def test_expired_table_leaves_no_files(spark, table_name, scratch):
    path = scratch("gone")
    ts.write_table(spark.range(3), table_name, path=path, expiration_time=1)
    assert files(path)
    assert any(table_name in t for t in ts.expire_tables(spark, 2))
    assert not files(path)


# ------------------------------------------------------------------- failed jobs

def failing(spark):
    return spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("boom")).cast("bigint"))
                                   .otherwise(F.col("id")).alias("id"))


@pytest.mark.parametrize("with_path", [True, False])
def test_failed_overwrite_keeps_rows(spark, table_name, scratch, with_path):
    path = scratch("over") if with_path else None
    ts.write_table(spark.range(100), table_name, path=path)
    with pytest.raises(Exception, match="boom"):
        ts.write_table(failing(spark), table_name)
    assert spark.table(table_name).count() == 100
    ts.write_table(spark.table(table_name).where("id < 10"), table_name)   # reads what it replaces
    assert spark.table(table_name).count() == 10
    home = table_layout(spark, table_name)["location"].split(":", 1)[-1]
    assert [d for d in os.listdir(os.path.dirname(home)) if d.startswith(os.path.basename(home) + "__")] == []


def test_partitioned_overwrite_replaces_all(spark, table_name, scratch):
    ts.write_table(months(spark, (1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5))), table_name,
                   partitioning=MONTH, path=scratch("parts"))
    ts.write_table(months(spark, (3, dt.date(2024, 2, 6)), (4, dt.date(2024, 3, 5))), table_name)
    assert sorted(r["k"] for r in spark.table(table_name).collect()) == [3, 4]
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table_name}").collect()) == [
        "d__month=2024-02-01", "d__month=2024-03-01"]


def test_failed_refresh_keeps_rows(spark, table_name):
    src = unique_name("src")
    spark.createDataFrame([("1",), ("2",)], "s string").write.saveAsTable(src)
    ts.create_materialized_view(spark, table_name, f"SELECT cast(s as int) AS k FROM {src}")
    spark.createDataFrame([("x",)], "s string").write.mode("append").saveAsTable(src)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ts.refresh_materialized_view(spark, table_name)
    assert spark.table(table_name).count() == 2


def test_failed_rewrite_keeps_the_table(spark, table_name, scratch):
    path = scratch("rw")
    df = spark.createDataFrame([(1, "5"), (2, "x")], "k int, s string")
    ts.write_table(df, table_name, path=path)
    target = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.IntegerType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ts.update_table_schema(spark, table_name, target)
    assert spark.table(table_name).count() == 2
    wider = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    ts.update_table_schema(spark, table_name, wider)
    assert dict(spark.table(table_name).dtypes) == {"k": "bigint", "s": "string"}
    assert not files(path)


def test_rewrite_keeps_options_and_raw_types(spark, table_name, scratch):
    spark.sql("select 1")
    df = spark.createDataFrame([(1, "a,b")], "k int, v string")
    ts.create_table(spark, table_name, df.schema, format="csv", path=scratch("csvopt"),
                    options={"delimiter": ",", "nullValue": "a,b", "quote": "'"},
                    column_overrides=[{"name": "v", "max-length": "5"}])
    before = table_layout(spark, table_name)["options"]
    wider = T.StructType([T.StructField("k", T.LongType()), spark.table(table_name).schema["v"]])
    ts.update_table_schema(spark, table_name, wider)
    assert table_layout(spark, table_name)["options"] == before
    types = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {table_name}").collect()}
    assert types["v"] == "varchar(5)" and types["k"] == "bigint"


# ----------------------------------------------------------------------- settings

def test_settings_reach_an_existing_table(spark, table_name):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    ts.write_table(df, table_name)
    ts.write_table(df, table_name, description="D", labels={"team": "x"}, clustering=["k"],
                   column_overrides=[{"name": "v", "description": "the v"}])
    props = table_properties(spark, table_name)
    assert props["label.team"] == "x" and "k" in props["tessera.clustering"]
    assert table_layout(spark, table_name)["description"] == "D"
    assert spark.table(table_name).schema["v"].metadata["comment"] == "the v"
    with pytest.raises(TypeError, match="nonsense"):
        ts.write_table(df, table_name, nonsense=1)


def test_options_reach_an_existing_table(spark, table_name, scratch):
    path = scratch("opts")
    ts.write_table(spark.range(5), table_name, path=path)
    ts.write_table(spark.range(5), table_name, options={"compression": "gzip"})
    assert all(".gz." in f for f in files(path))


def test_lifetime_and_clustering_can_change(spark, table_name):
    ts.write_table(months(spark, (1, dt.date(2024, 1, 5))), table_name, partitioning=MONTH)
    ts.update_table_schema(spark, table_name, clustering=["k"], partition_expiration_ms=1000)
    assert ts.expire_partitions(spark, table_name, dt.datetime(2025, 1, 1)) == ["2024-01-01"]
    ts.update_table_schema(spark, table_name, partition_expiration_ms=0)
    ts.write_table(months(spark, (1, dt.date(2024, 1, 5))), table_name)
    assert ts.expire_partitions(spark, table_name, dt.datetime(2025, 1, 1)) == []


def test_nested_tags_are_refused_before_writing(spark, table_name):
    plain = spark.createDataFrame([(1, ("5",))], "k int, s struct<x:string>")
    ts.write_table(plain, table_name)
    wide = plain.select("k", F.struct(F.lit(1).cast("decimal(38,18)").alias("x")).alias("s"))
    with pytest.raises(ValueError, match="nested decimal tags"):
        ts.write_table(wide, table_name, encode_decimals=True)
    assert spark.table(table_name).first()["s"]["x"] == "5"


def test_required_columns_refuse_nulls(spark, table_name):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    ts.write_table(df, table_name, column_overrides=[{"name": "v", "mode": "REQUIRED"}])
    with pytest.raises(Exception, match="required column v"):
        ts.write_table(spark.createDataFrame([(2, None)], "k int, v string"), table_name, mode="append")
    assert spark.table(table_name).count() == 1


@pytest.mark.parametrize("override,expected", [
    ({"scale": 0}, "decimal(38,0)"), ({"precision": "5"}, "decimal(5,5)"),
    ({"precision": "10", "scale": "2"}, "decimal(10,2)")])
def test_decimal_overrides(override, expected):
    schema = T.StructType([T.StructField("n", T.DecimalType(38, 18))])
    got = apply_column_overrides(schema, [{"name": "n", **override}])
    assert got["n"].dataType.simpleString() == expected


def test_names_match_without_case(spark, table_name):
    ts.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), table_name)
    ts.write_table(spark.createDataFrame([("b", 2)], "V string, K int"), table_name, mode="append")
    assert sorted(tuple(r) for r in spark.table(table_name).collect()) == [(1, "a"), (2, "b")]


def test_snapshot_keeps_partitions(spark, table_name):
    ts.write_table(months(spark, (1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5))), table_name, partitioning=MONTH)
    snap = unique_name("snap")
    ts.create_snapshot(spark, table_name, snap)
    day = dt.date(2024, 2, 5)
    assert [tuple(r) for r in ts.read_table(spark, snap, between=(day, day)).collect()] == [(2, day)]


def test_map_table_is_clustered(spark, table_name):
    df = spark.range(100).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"))
    ts.write_table(df, table_name, clustering=["id"])
    assert spark.table(table_name).count() == 100


def test_concurrent_writes_do_not_meet(spark, scratch):
    parted, plain = unique_name("tp"), unique_name("tf")
    base = months(spark, *((i, dt.date(2024, 1 + i % 3, 5)) for i in range(30)))
    ts.write_table(base, parted, partitioning=MONTH, path=scratch("tp"))
    ts.write_table(spark.range(10), plain, path=scratch("tf"))
    errors = []

    def run(fn):
        try:
            for _ in range(4):
                fn()
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    jobs = [lambda: ts.replace_partition(base.where("month(d) = 1"), parted, dt.date(2024, 1, 1)),
            lambda: ts.write_table(spark.range(10), plain)]
    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert spark.table(parted).count() == 30 and spark.table(plain).count() == 10


# ----------------------------------------------------------------------- external

def csv(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_external_csv_can_be_counted(spark, scratch):
    path = csv(spark, scratch("cnt"), ["1,a", "2,b", "x,c"])
    df = ts.read_external(spark, ts.ExternalData([path], "CSV", schema="a int, b string", max_bad_records=1))
    assert df.count() == 2 and df.agg(F.count("*")).first()[0] == 2
    assert [r[0] for r in df.select(F.lit(1)).collect()] == [1, 1]


def test_no_job_before_the_first_action(spark, scratch):
    path = csv(spark, scratch("lazy"), ["1,a", "x,c"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-read", "")
    try:
        df = ts.read_external(spark, ts.ExternalData([path], "CSV", schema="a int, b string"))
        assert not tracker.getJobIdsForGroup("lazy-read")
        spark.sparkContext.setJobGroup("budget-read", "")
        ts.read_external(spark, ts.ExternalData([path], "CSV", schema="a int, b string", max_bad_records=5))
        assert len(tracker.getJobIdsForGroup("budget-read")) <= 2   # one query: map side and final
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="bad record"):
        df.count()


def test_csv_formats_with_unknown_values(spark, scratch):
    path = csv(spark, scratch("fmt"), ["1,31/12/2020,more", "2,no date"])
    ext = ts.ExternalData([path], "CSV", schema="k int, d date", ignore_unknown_values=True, max_bad_records=1,
                          options={"dateFormat": "dd/MM/yyyy"})
    assert [tuple(r) for r in ts.read_external(spark, ext).collect()] == [(1, dt.date(2020, 12, 31))]


def test_json_nested_unknown_keys(spark, scratch):
    path = csv(spark, scratch("nest"), ['{"a":{"x":1}}', '{"a":{"x":2,"y":3}}', '{"b":[{"z":1}]}', '{"b":[{"w":1}]}'])
    ext = ts.ExternalData([path], "JSON", schema="a struct<x:int>, b array<struct<z:int>>", max_bad_records=2)
    assert ts.read_external(spark, ext).count() == 2


def test_hive_table_reads_alike_by_name(spark, scratch):
    path = scratch("hivename")
    spark.createDataFrame([(1, "01"), (2, "02")], "a int, p string").write.partitionBy("p").csv(path)
    name = unique_name("hv")
    ext = ts.ExternalData([path], "CSV", schema="a int", hive_partitioning=ts.HivePartitioning(path, "STRINGS"))
    ts.define_external_table(spark, name, ext)
    want = [(1, "01"), (2, "02")]
    assert sorted(tuple(r) for r in spark.table(name).collect()) == want
    assert sorted(tuple(r) for r in ts.read_table(spark, name).collect()) == want


def test_bad_rows_stay_out_by_name(spark, scratch):
    path = csv(spark, scratch("badname"), ["1,a", "x,c"])
    name = unique_name("bn")
    ts.define_external_table(spark, name, ts.ExternalData([path], "CSV", schema="a int, b string", max_bad_records=1))
    assert spark.table(name).count() == ts.read_table(spark, name).count() == 1


def test_two_folders_are_one_table(spark, scratch):
    a, b = csv(spark, scratch("fa") + "/v1.2", ["1,a"]), csv(spark, scratch("fb"), ["2,b"])
    name = unique_name("two")
    ts.define_external_table(spark, name, ts.ExternalData([a, b], "CSV", schema="k int, v string"))
    for df in (spark.table(name), ts.read_table(spark, name)):
        assert sorted(tuple(r) for r in df.collect()) == [(1, "a"), (2, "b")]
    assert ts.write_table(spark.range(1), name, mode="append").status == "skipped_external"


def test_autodetect_obeys_the_budget(spark, scratch):
    path = csv(spark, scratch("autob"), ["a,b", "1,2", "3,4", "5"])
    ext = ts.ExternalData([path], "CSV", autodetect=True, options={"header": "true"})
    with pytest.raises(Exception, match="bad record"):
        ts.read_external(spark, ext).collect()


def test_unify_never_makes_nulls(spark):
    df = spark.sql("SELECT cast('123456789012345678901234567890123' as decimal(38,2)) AS n")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="does not fit"):
            ts.conform_types(df, unify=True).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_archive_names_are_escaped():
    from tessera.sinks.table import archive_path
    path = archive_path("/r", "t", now=dt.datetime(2024, 1, 2, 3, 4, 5), partition_column="ts",
                        partition_value=dt.datetime(2024, 1, 1, 10))
    assert path == "/r/ar_t/2024/ts=2024-01-01%2010%3A00%3A00/20240102_030405"
