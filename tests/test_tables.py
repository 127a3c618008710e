"""Table definition, writes, partitions, views, snapshots, lifetimes, archives."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.functions import TAG
from tessera.operators import table_properties
from tessera.operators.tables import apply_column_overrides
from tessera.session import unique_name
from tessera.sinks import archive_path, read_archive
from tessera.sources import PartitionFilterRequired


def small(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "k bigint, v string, x double")


def test_create_if_absent_and_properties(spark, table_name, scratch):
    schema = small(spark).schema
    assert ts.create_table(spark, table_name, schema, path=scratch(), description="desc",
                           friendly_name="Nice", labels={"team": "a"}, location="EU",
                           expiration_time=dt.datetime(2030, 1, 1), clustering=["k"])
    assert not ts.create_table(spark, table_name, schema)
    props = table_properties(spark, table_name)
    assert props["friendly_name"] == "Nice" and props["label.team"] == "a"
    assert props["region"] == "EU" and props["tessera.clustering"] == '["k"]'
    assert int(props["tessera.expires_at_ms"]) == 1893456000000
    info = {r["col_name"]: r["data_type"] for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    assert info["Comment"] == "desc"


def test_column_overrides_each_key_alone():
    schema = T.StructType([T.StructField("p", T.DecimalType(38, 18), True, {"comment": TAG}),
                           T.StructField("s", T.StringType()), T.StructField("i", T.IntegerType()),
                           T.StructField("untouched", T.StringType(), True, {"comment": "c"})])
    out = apply_column_overrides(schema, [
        {"name": "p", "precision": "20", "scale": "4", "description": "price"},
        {"name": "s", "max-length": "10"},
        {"name": "i", "c-type": "STRING", "mode": "REQUIRED"}])
    assert out["p"].dataType == T.DecimalType(20, 4)
    assert out["p"].metadata["comment"] == f"{TAG}|price"
    assert out["s"].dataType == T.VarcharType(10)
    assert out["i"].dataType == T.StringType() and not out["i"].nullable
    assert out["untouched"] == schema["untouched"]
    only_desc = apply_column_overrides(schema, [{"name": "s", "description": "new"}])
    assert only_desc["s"].metadata["comment"] == "new"
    rep = apply_column_overrides(schema, [{"name": "i", "mode": "REPEATED"}])
    assert rep["i"].dataType == T.ArrayType(T.IntegerType(), True)
    with pytest.raises(KeyError):
        apply_column_overrides(schema, [{"name": "nope", "description": "x"}])


def test_save_modes(spark, table_name, scratch):
    df = small(spark)
    assert ts.write_table(df, table_name, path=scratch()).created
    with pytest.raises(RuntimeError):
        ts.write_table(df, table_name, mode="errorifexists")
    assert ts.write_table(df.limit(0), table_name, mode="ignore").status == "ignored"
    ts.write_table(df, table_name, mode="append")
    assert spark.table(table_name).count() == 4
    ts.write_table(df.where("k = 1"), table_name, mode="overwrite")
    assert spark.table(table_name).count() == 1
    with pytest.raises(ValueError):
        ts.write_table(df, table_name, mode="owerwrite")
    with pytest.raises(RuntimeError):
        ts.write_table(df, unique_name("absent"), create_if_not_exists=False)


def test_overwrite_keeps_comments_and_retags(spark, table_name, scratch):
    df = spark.createDataFrame([(1, Decimal("1.5"))], "k bigint, p decimal(38,18)")
    ts.write_table(df, table_name, encode_decimals=True, path=scratch())
    assert spark.table(table_name).schema["p"].metadata["comment"] == TAG
    ts.write_table(df, table_name, mode="overwrite", encode_decimals=True)
    assert spark.table(table_name).schema["p"].metadata["comment"] == TAG
    assert ts.read_table(spark, table_name).first()["p"] == Decimal("1.5")


def test_schema_update_add_and_rewrite(spark, table_name, scratch):
    df = small(spark)
    ts.write_table(df, table_name, path=scratch(), labels={"keep": "me"})
    new = T.StructType(df.schema.fields + [T.StructField("n", T.StringType(), True,
                                                         {"comment": "note"})])
    assert ts.update_table_schema(spark, table_name, new, description="d2")
    sch = spark.table(table_name).schema
    assert sch["n"].metadata["comment"] == "note"
    # type change: rewritten into a new table, properties kept
    changed = T.StructType([T.StructField("k", T.StringType(), True, {"comment": "key"})]
                           + new.fields[1:])
    ts.update_table_schema(spark, table_name, changed)
    sch = spark.table(table_name).schema
    assert sch["k"].dataType == T.StringType() and sch["k"].metadata["comment"] == "key"
    assert table_properties(spark, table_name)["label.keep"] == "me"
    assert sorted(r["k"] for r in spark.table(table_name).collect()) == ["1", "2"]
    assert not ts.update_table_schema(spark, unique_name("missing"), new)


def test_range_partition_values(spark, table_name, scratch):
    spec = ts.PartitionSpec("k", " INT64 ", ts.RangePartitioning(10, 50, 10))
    df = spark.createDataFrame([(5, "below"), (10, "start"), (27, "inside"), (50, "end"),
                                (None, "null")], "k bigint, v string")
    ts.write_table(df, table_name, partitioning=spec, path=scratch())
    got = {r["v"]: r["k__range"] for r in
           ts.read_table(spark, table_name, keep_partition_column=True).collect()}
    assert got == {"below": None, "start": 10, "inside": 20, "end": None, "null": None}
    assert "k__range" not in ts.read_table(spark, table_name).columns
    both = ts.read_table(spark, table_name, between=(0, 30))
    assert sorted(r["v"] for r in both.collect()) == ["below", "inside", "start"]


def test_time_partition_values(spark, table_name, scratch):
    rows = [(dt.datetime(2024, 1, 1, 10, 5), "h10"), (dt.datetime(2024, 1, 1, 11, 59), "h11"),
            (dt.datetime(2024, 2, 29, 0, 0), "feb"), (dt.datetime(2024, 12, 31, 23, 59), "ye"),
            (None, "null")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v string")
    hour = ts.PartitionSpec("ts", "timestamp", ts.TimePartitioning("hour"))
    ts.write_table(df, table_name, partitioning=hour, path=scratch())
    got = {r["v"]: r["ts__hour"] for r in
           ts.read_table(spark, table_name, keep_partition_column=True).collect()}
    assert got["h10"] == dt.datetime(2024, 1, 1, 10) and got["h11"] == dt.datetime(2024, 1, 1, 11)
    assert got["null"] is None
    month = ts.PartitionSpec("ts", "timestamp", ts.TimePartitioning("MONTH"))
    name2 = unique_name("month")
    ts.write_table(df, name2, partitioning=month, path=scratch())
    got = {r["v"]: r["ts__month"] for r in
           ts.read_table(spark, name2, keep_partition_column=True).collect()}
    assert got["feb"] == dt.date(2024, 2, 1) and got["ye"] == dt.date(2024, 12, 1)
    with pytest.raises(ValueError):
        ts.PartitionSpec("d", "date", ts.TimePartitioning("HOUR"))
    with pytest.raises(ValueError):
        ts.PartitionSpec("d", "string", ts.TimePartitioning("DAY"))


def test_replace_partition_checks_rows(spark, table_name, scratch):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 2, 5), 2)],
                               "d date, x int")
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))
    ts.write_table(df, table_name, partitioning=spec, path=scratch())
    jan = spark.createDataFrame([(dt.date(2024, 1, 9), 10), (dt.date(2024, 1, 10), 11)],
                                "d date, x int")
    ts.replace_partition(jan, table_name, dt.date(2024, 1, 1))
    assert sorted(r["x"] for r in spark.table(table_name).collect()) == [2, 10, 11]
    with pytest.raises(PySparkException):
        ts.replace_partition(df, table_name, dt.date(2024, 1, 1))
    assert sorted(r["x"] for r in spark.table(table_name).collect()) == [2, 10, 11]
    # an empty input empties that one partition
    ts.replace_partition(jan.limit(0), table_name, dt.date(2024, 1, 15))
    assert [r["x"] for r in spark.table(table_name).collect()] == [2]


def test_require_partition_filter_and_expiry(spark, table_name, scratch):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), 1), (dt.date(2023, 6, 5), 2)],
                               "d date, x int")
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH", 365 * 86400 * 1000))
    ts.write_table(df, table_name, partitioning=spec, path=scratch(),
                   require_partition_filter=True)
    with pytest.raises(PartitionFilterRequired):
        ts.read_table(spark, table_name)
    q = ts.read_table(spark, table_name, between=(dt.date(2023, 1, 1), dt.date(2023, 12, 31)))
    assert [r["x"] for r in q.collect()] == [2]
    from tessera.plans import executed_plan
    plan = executed_plan(q)
    assert "PartitionFilters" in plan and "d__month" in plan
    assert ts.expire_partitions(spark, table_name, dt.datetime(2024, 1, 1)) == ["2020-01-01"]
    assert [r["x"] for r in ts.read_table(spark, table_name, partition_value="2023-06-01")
            .collect()] == [2]


def test_expire_tables(spark, scratch):
    db = unique_name("db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch('db')}'")
    df = small(spark)
    ts.write_table(df, f"{db}.old", expiration_time=dt.datetime(2020, 1, 1), path=scratch())
    ts.write_table(df, f"{db}.new", expiration_time=dt.datetime(2030, 1, 1), path=scratch())
    ts.write_table(df, f"{db}.forever", path=scratch())
    assert ts.expire_tables(spark, dt.datetime(2025, 1, 1), db) == [f"{db}.old"]
    assert sorted(t.name for t in spark.catalog.listTables(db)) == ["forever", "new"]


def test_views_matview_snapshot(spark, table_name, scratch):
    df = small(spark)
    ts.write_table(df, table_name, path=scratch())
    v = unique_name("v")
    assert ts.create_view(spark, v, f"SELECT count(*) AS n FROM {table_name}")
    assert not ts.create_view(spark, v, "SELECT 1")
    assert ts.update_view(spark, v, f"SELECT sum(k) AS s FROM {table_name}")
    assert spark.table(v).first()["s"] == 3
    assert not ts.update_view(spark, unique_name("nov"), "SELECT 1")
    mv = unique_name("mv")
    ts.create_materialized_view(spark, mv, f"SELECT count(*) AS n FROM {table_name}",
                                path=scratch())
    ts.write_table(df, table_name, mode="append")
    assert spark.table(mv).first()["n"] == 2
    ts.refresh_materialized_view(spark, mv)
    assert spark.table(mv).first()["n"] == 4
    snap = unique_name("snap")
    ts.create_snapshot(spark, table_name, snap, path=scratch())
    ts.write_table(df.limit(1), table_name, mode="overwrite")
    assert spark.table(snap).count() == 4
    assert table_properties(spark, snap)["tessera.snapshot_of"] == table_name


def test_archive_layout_and_schema(spark, table_name, scratch):
    clock = dt.datetime(2024, 3, 1, 9, 8, 7)
    assert archive_path("/r", "t", now=clock) == "/r/ar_t/2024/20240301_090807"
    assert (archive_path("/r", "t", now=clock, partition_column="country_code",
                         partition_value="FR") == "/r/ar_t/2024/country_code=FR/20240301_090807")
    df = spark.createDataFrame([("FR", Decimal("1.5"), dt.date(2024, 1, 1)),
                                ("DE", Decimal("2.5"), dt.date(2024, 1, 2))],
                               "country_code string, amount decimal(38,18), day date")
    root = scratch("archive")
    res = ts.write_table(df, table_name, path=scratch(), encode_decimals=True, archive=True,
                         archive_root=root, now=clock)
    arch = read_archive(spark, res.archive_path)
    assert arch.schema["amount"].metadata["comment"] == TAG
    assert arch.count() == 2 and spark.table(table_name).count() == 2
    spec = ts.PartitionSpec("day", "date", ts.TimePartitioning("MONTH"))
    with pytest.raises(ValueError):
        ts.write_table(df, unique_name("p"), partitioning=spec, archive=True, archive_root=root)
    with pytest.raises(ValueError):
        ts.write_table(df, unique_name("noroot"), archive=True)


def test_clustered_layout(spark, table_name, scratch):
    from tessera.sinks import clustered
    from tessera.plans import executed_plan
    df = spark.range(10000).select((F.col("id") % 3).alias("g"), F.col("id"))
    plan = executed_plan(clustered(df, ["g"]))
    assert "rangepartitioning(g" in plan.lower() and "Sort [g" in plan
    ts.write_table(df, table_name, clustering=["g"], path=scratch())
    assert spark.table(table_name).count() == 10000
    assert table_properties(spark, table_name)["tessera.clustering"] == '["g"]'


def test_hour_partition_expiry_escaped_names(spark, table_name, scratch):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 5), 1),
                                (dt.datetime(2024, 1, 3, 11, 5), 2)], "ts timestamp_ntz, x int")
    spec = ts.PartitionSpec("ts", "timestamp", ts.TimePartitioning("HOUR", 24 * 3600 * 1000))
    ts.write_table(df, table_name, partitioning=spec, path=scratch())
    assert ts.expire_partitions(spark, table_name, dt.datetime(2024, 1, 3)) == ["2024-01-01 10:00:00"]
    assert [r["x"] for r in spark.table(table_name).collect()] == [2]


def test_where_on_tagged_column_compares_decimals(spark, table_name, scratch):
    df = spark.createDataFrame([(1, Decimal("9.5")), (2, Decimal("10.25"))],
                               "k bigint, p decimal(38,18)")
    ts.write_table(df, table_name, encode_decimals=True, path=scratch())
    # as text "9.5..." > "10..." — as decimals only 10.25 passes
    got = ts.read_table(spark, table_name, where=F.col("p") > 10).collect()
    assert [r["k"] for r in got] == [2]


def test_overwrite_from_the_same_table(spark, table_name, scratch):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 2, 5), 2)],
                               "d date, x int")
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))
    ts.write_table(df, table_name, partitioning=spec, path=scratch())
    jan = ts.read_table(spark, table_name, partition_value=dt.date(2024, 1, 1))
    ts.replace_partition(jan.withColumn("x", F.col("x") + 100), table_name, dt.date(2024, 1, 1))
    assert sorted(r["x"] for r in spark.table(table_name).collect()) == [2, 101]
    whole = ts.read_table(spark, table_name).withColumn("x", F.col("x") + 1)
    ts.write_table(whole, table_name, mode="overwrite")
    assert sorted(r["x"] for r in spark.table(table_name).collect()) == [3, 102]


def test_clustered_splits_a_hot_key(spark):
    from tessera.sinks import clustered
    # one key holds 90% of the rows
    df = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7)
                                   .otherwise(F.lit(3)).alias("g"), F.col("id"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = (clustered(df, ["g"], num_partitions=8)
                 .where(F.col("g") == 3).select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert parts >= 4


def test_nested_comment_update_is_metadata_only(spark, table_name, scratch):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), (Decimal("1.5"), "a")),
                                (dt.date(2024, 2, 5), (Decimal("2.5"), "b"))],
                               "d date, s struct<x: decimal(38,18), y: string>")
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))
    # a table first written without encoding: x is plain text, untagged
    plain = df.select("d", F.struct(F.col("s.x").cast("string").alias("x"), "s.y").alias("s"))
    ts.write_table(plain, table_name, partitioning=spec, path=scratch(),
                   options={"compression": "gzip"}, labels={"k": "v"})
    files_before = sorted(r[0] for r in spark.table(table_name)
                          .select(F.input_file_name()).distinct().collect())
    # appending encoded rows brings the nested tag; the entry is rebuilt, files stay
    ts.write_table(df, table_name, mode="append", encode_decimals=True)
    sch = spark.table(table_name).schema
    assert sch["s"].dataType["x"].metadata.get("comment") == TAG
    files_after = {r[0] for r in spark.table(table_name).select(F.input_file_name())
                   .distinct().collect()}
    assert set(files_before) <= files_after                # nothing rewritten
    assert all(f.endswith(".gz.parquet") for f in files_after)
    assert table_properties(spark, table_name)["label.k"] == "v"
    back = ts.read_table(spark, table_name)
    assert sorted(r["s"]["x"] for r in back.collect()) == [Decimal("1.5"), Decimal("1.5"),
                                                         Decimal("2.5"), Decimal("2.5")]
    assert ts.read_table(spark, table_name, partition_value=dt.date(2024, 1, 1)).count() == 2


def test_rebalanced_write_splits_a_hot_partition(spark, table_name, scratch):
    """Rebalanced partitioned write: few files for cold months, the hot one split.

    AQE splits a skewed reducer partition along map outputs, so the input has
    several tasks here, as any large input does.
    """
    # 90% of the rows fall in one month
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 == 0,
               F.make_date(F.lit(2024), (F.col("id") % 12 + 1).cast("int"), F.lit(1)))
        .otherwise(F.lit(dt.date(2024, 5, 1))).alias("d"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8)
    spec = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "256k")
    spark.conf.set(keys[1], "16k")
    plain = unique_name("plain")
    try:
        ts.write_table(df, table_name, partitioning=spec, path=scratch())
        ts.write_table(df, plain, partitioning=spec, path=scratch(), rebalance=False)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    def files_per_month(name):
        rows = (spark.table(name).select("d__month", F.input_file_name().alias("f"))
                .distinct().groupBy("d__month").count().collect())
        return {r["d__month"]: r["count"] for r in rows}
    hot = dt.date(2024, 5, 1)
    plain_files, balanced = files_per_month(plain), files_per_month(table_name)
    assert all(n == 8 for n in plain_files.values())     # every task, every month
    assert sum(balanced.values()) < sum(plain_files.values())
    assert min(balanced.values()) == 1                     # cold months: one file
    assert balanced[hot] > 1                               # the hot month is split
    assert spark.table(table_name).count() == 40000


def test_create_table_with_views_and_snapshot(spark, table_name, scratch):
    df = small(spark)
    ts.write_table(df, table_name, path=scratch())
    mv, v, snap = unique_name("mv"), unique_name("v"), unique_name("snap")
    again = ts.create_table(spark, table_name, df.schema,
                            materialized_view=(mv, f"SELECT count(*) AS n FROM {table_name}"),
                            view=(v, f"SELECT k FROM {table_name}"), snapshot=snap)
    assert again is False                   # the table existed; the rest was created
    assert spark.table(mv).first()["n"] == 2
    assert spark.table(v).count() == 2 and spark.table(snap).count() == 2
    ts.create_table(spark, table_name, df.schema, view=(v, "SELECT 1 AS k"), snapshot=snap)
    assert spark.table(v).count() == 2      # existing view left as it was


def test_write_with_external_definition(spark, scratch):
    from tessera.sources import ExternalData
    path = scratch("ext_write")
    spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string").write.json(path)
    name = unique_name("ext_w")
    res = ts.write_table(spark.createDataFrame([(9, "z")], "a int, b string"), name,
                         external=ExternalData([path], "JSON", schema="a int, b string"),
                         description="files")
    assert res.status == "skipped_external" and res.created
    assert sorted(r["a"] for r in ts.read_table(spark, name).collect()) == [1, 2]


def test_update_schema_also_updates_view(spark, table_name, scratch):
    df = small(spark)
    ts.write_table(df, table_name, path=scratch())
    v = unique_name("v")
    ts.create_view(spark, v, f"SELECT k FROM {table_name}")
    ts.update_table_schema(spark, table_name, df.schema,
                           view=(v, f"SELECT k, v FROM {table_name}"))
    assert spark.table(v).columns == ["k", "v"]
    # a missing table: nothing updated, the view still is
    assert not ts.update_table_schema(spark, unique_name("gone"), df.schema,
                                      view=(v, f"SELECT v FROM {table_name}"))
    assert spark.table(v).columns == ["v"]
