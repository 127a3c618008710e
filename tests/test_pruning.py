"""Reads that leave files out: joins on the partition column, file summaries, curves; archives as of a time."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.operators import summaries, versions
from tessera.session import unique_name

MONTH = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))
RANGE = ts.PartitionSpec("k", "int64", ts.RangePartitioning(0, 100, 10))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ----------------------------------------------------------- partitions from a join

@pytest.fixture(scope="module")
def days(spark):
    name = unique_name("days")
    df = spark.range(360).select(F.col("id").cast("int").alias("v"), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    ts.write_table(df, name, partitioning=MONTH)
    return name


def saved(spark, path, rows, schema):
    """Keys whose size Spark knows."""
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def partitions_read(df):
    """Partitions that the scan of the finished plan read, from its own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, seen = [plan], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            seen.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return seen


@pytest.mark.parametrize("listed", [False, True, None])
def test_join_prunes_partitions(spark, days, scratch, listed):
    keys = saved(spark, scratch("keys"), [(dt.date(2024, 3, 5), "a"), (dt.date(2024, 3, 5), "b"), (dt.date(2024, 7, 1), "c"),
                                          (dt.date(1990, 1, 1), "far"), (None, "none")], "day date, why string")
    semi = ts.read_matching(spark, days, keys, {"day": "d"}, listed=listed)
    assert semi.columns == ["v", "d"]
    assert sorted(r["v"] for r in semi.collect()) == [64, 182]
    inner = ts.read_matching(spark, days, keys, {"day": "d"}, how="inner", listed=listed)
    assert sorted(tuple(r) for r in inner.select("v", "why").collect()) == [(64, "a"), (64, "b"), (182, "c")]
    assert listed or "dynamicpruning" in plan_of(semi)
    # a plan tells its metrics the first time it runs
    assert partitions_read(ts.read_matching(spark, days, keys, {"day": "d"}, listed=listed)) == [2]


def test_keys_of_unknown_size_are_asked_first(spark, days):
    keys = spark.createDataFrame([(dt.date(2024, 3, 5),), (dt.date(2024, 9, 5),)], "day date")
    assert partitions_read(ts.read_matching(spark, days, keys, {"day": "d"})) == [2]


def test_join_on_integer_ranges(spark, table_name):
    df = spark.createDataFrame([(k, 1) for k in (-5, 0, 9, 10, 55, 99, 100, 1000, None)], "k bigint, m bigint")
    ts.write_table(df, table_name, partitioning=RANGE)
    keys = spark.createDataFrame([(k,) for k in (-5, 9, 55, 100, 7, None, 55)], "k bigint")
    for listed in (False, True):
        got = ts.read_matching(spark, table_name, keys, {"k": "k"}, listed=listed)
        assert sorted(r["k"] for r in got.collect()) == [-5, 9, 55, 100]
        got = ts.read_matching(spark, table_name, keys, {"k": "k"}, how="inner", listed=listed)
        assert sorted(r["k"] for r in got.collect()) == [-5, 9, 55, 55, 100]


def test_join_needs_the_partition_column(spark, days, table_name):
    keys = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError, match="partition column"):
        ts.read_matching(spark, days, keys, {"v": "v"})
    ts.create_table(spark, table_name, spark.table(days).drop("d__month").schema, partitioning=MONTH)
    assert ts.read_matching(spark, table_name, spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date"), {"d": "d"}).collect() == []


# -------------------------------------------------------------------- file summaries

def names(df):
    return sorted(r["file"] for r in df.collect())


def files_with(spark, table, test):
    return sorted(r[0] for r in spark.table(table).where(test).select("_metadata.file_name").distinct().collect())


def test_summaries_find_files(spark, table_name, scratch):
    df = spark.range(4000).select((F.col("id") * 7919 % 4001).alias("k"), F.concat(F.lit("n"), F.col("id") % 50).alias("s"),
                                  F.when(F.col("id") % 3 == 0, F.col("id") / 2).alias("x"))
    ts.write_table(df, table_name, path=scratch("sums"), clustering=["k"], cluster_partitions=8, summaries=["k", "x", "s"])
    for k in (0, 17, 3999, 4000):
        hit = names(ts.operators.candidate_files(spark, table_name, {"k": k}))
        assert set(files_with(spark, table_name, F.col("k") == k)) <= set(hit) and len(hit) <= 2
        assert ts.read_table(spark, table_name, points={"k": k}).count() == df.where(F.col("k") == k).count()
    assert names(ts.operators.candidate_files(spark, table_name, {"k": -1})) == []
    assert ts.read_table(spark, table_name, points={"k": -1}).collect() == []
    some = names(ts.operators.candidate_files(spark, table_name, ranges={"k": (100, 400)}))
    assert set(files_with(spark, table_name, "k between 100 and 400")) <= set(some) and len(some) < 4
    got = ts.read_table(spark, table_name, ranges={"k": (100, 400), "x": (None, 1000)}, points={"s": "n7"})
    want = df.where("k between 100 and 400 and x <= 1000 and s = 'n7'")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ts.read_table(spark, table_name, points={"x": None}).count() == df.where("x is null").count()


def test_bloom_filters_find_values_between(spark, table_name, scratch):
    """Every file has the whole range of values, so only the filters can tell them apart."""
    df = spark.range(3000).select(F.xxhash64("id").alias("h"))
    ts.write_table(df.repartition(6), table_name, path=scratch("bloom"), summaries=["h"])
    total = 0
    sought = [r["h"] for r in df.limit(20).collect()]
    for h in sought:
        hit = names(ts.operators.candidate_files(spark, table_name, {"h": h}))
        assert set(files_with(spark, table_name, F.col("h") == h)) <= set(hit)
        total += len(hit)
    assert total <= 25
    df1 = ts.read_table(spark, table_name, points={"h": sought[0]})
    assert "file_name" in plan_of(df1) and df1.count() == 1


def test_summaries_follow_writes(spark, table_name, scratch):
    df = spark.range(100).toDF("k")
    ts.write_table(df, table_name, path=scratch("follow"), summaries=["k"])
    ts.write_table(df.select((F.col("k") + 1000).alias("k")), table_name, mode="append")
    assert ts.read_table(spark, table_name, points={"k": 1005}).count() == 1
    assert len(names(ts.operators.candidate_files(spark, table_name, {"k": 1005}))) == 1
    # a version the summaries do not know: nothing is left out
    base = versions.begin(spark, table_name)
    spark.createDataFrame([(5000,)], "k bigint").write.insertInto(table_name)
    versions.appended(spark, base)
    assert ts.operators.candidate_files(spark, table_name, {"k": 5000}) is None
    assert ts.read_table(spark, table_name, points={"k": 5000}).count() == 1
    assert ts.summarise(spark, table_name) == 1 and ts.summarise(spark, table_name) == 0
    assert len(names(ts.operators.candidate_files(spark, table_name, {"k": 5000}))) == 1
    ts.write_table(df.select((F.col("k") + 7).alias("k")), table_name)
    assert ts.read_table(spark, table_name, points={"k": 3}).collect() == []
    assert ts.read_table(spark, table_name, points={"k": 103}).count() == 1


def test_summaries_of_partitions_and_many_files(spark, scratch, monkeypatch):
    name = unique_name("sp")
    df = spark.range(300).select(F.col("id").alias("v"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"))
    ts.write_table(df, name, partitioning=MONTH, path=scratch("sp"), summaries=["v"])
    ts.replace_partition(df.where("month(d) = 2").withColumn("v", F.col("v") + 1000), name, dt.date(2024, 2, 1))
    assert ts.read_table(spark, name, points={"v": 1040}).count() == 1
    assert ts.read_table(spark, name, points={"v": 40}, between=(dt.date(2024, 2, 1), dt.date(2024, 2, 28))).count() == 0
    monkeypatch.setattr(summaries, "NAMES", 0)
    assert ts.read_table(spark, name, points={"v": 1040}).count() == 1
    with pytest.raises(TypeError, match="no order"):
        ts.summarise(spark, name_with_array(spark, scratch), ["a"])


def name_with_array(spark, scratch):
    name = unique_name("arr")
    ts.write_table(spark.sql("select array(1) as a"), name, path=scratch("arr"))
    return name


def test_rewritten_table_has_no_stale_summaries(spark, table_name, scratch):
    ts.write_table(spark.range(10).toDF("k"), table_name, path=scratch("stale"), summaries=["k"])
    ts.update_table_schema(spark, table_name, T.StructType([T.StructField("k", T.StringType())]))
    assert ts.operators.candidate_files(spark, table_name, {"k": "3"}) is None
    assert ts.read_table(spark, table_name, points={"k": "3"}).count() == 1


# ------------------------------------------------------------------------------ curve

def test_curve_narrows_every_column(spark, table_name, scratch):
    df = spark.range(8192).select((F.col("id") * 7919 % 8192).alias("a"), F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") * 5471 % 4096).cast("int")).alias("b"),
                                  F.when(F.col("id") % 10 > 0, F.format_string("%05d", F.col("id") * 31 % 997)).alias("c"))
    line, curve = unique_name("line"), table_name
    for name, on in ((line, False), (curve, True)):
        ts.write_table(df, name, path=scratch(name), clustering=["a", "b"], cluster_partitions=16, cluster_curve=on, summaries=["a", "b"])
    lo, hi = dt.date(2001, 1, 1), dt.date(2001, 6, 1)
    count = lambda t, **kw: len(names(ts.operators.candidate_files(spark, t, **kw)))
    assert count(line, ranges={"b": (lo, hi)}) == 16
    assert count(curve, ranges={"b": (lo, hi)}) < 8 and count(curve, ranges={"a": (100, 300)}) < 8
    assert spark.table(curve).count() == 8192
    got = ts.read_table(spark, curve, ranges={"b": (lo, hi)})
    assert sorted(map(str, got.collect())) == sorted(map(str, df.where(F.col("b").between(lo, hi)).collect()))


def test_curve_places_by_quantiles(spark):
    from tessera.sinks.table import _rank, interleaved
    df = spark.range(64).select(F.col("id").alias("a"), (F.col("id") % 8).cast("string").alias("b"), F.lit(None).cast("double").alias("n"),
                                F.timestamp_seconds(F.col("id")).alias("t"), (F.col("id") % 2 == 0).alias("f"))
    placed = df.select(interleaved(df, ["a", "b", "n", "t", "f"]).alias("z")).collect()
    assert len({r["z"] for r in placed}) > 32
    cuts = [1.0, 2.5, 2.6, 9.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.55, 9.0, 10.0)], "x double").select(_rank(F.col("x"), cuts)).collect()]
    assert got == [0, 1, 2, 4, 4]
    with pytest.raises(TypeError, match="interleaved"):
        interleaved(spark.sql("select array(1) as a"), ["a"])


# ------------------------------------------------------------------ archives as of a time

def stamp(*a):
    return dt.datetime(*a)


def test_archive_as_of(spark, table_name, scratch):
    root = scratch("arch")
    write = lambda rows, when, m: ts.replace_partition(
        spark.createDataFrame(rows, "v int, d date"), table_name, m and dt.date(2024, m, 1), archive=True, archive_root=root, now=when)
    ts.create_table(spark, table_name, spark.createDataFrame([], "v int, d date").schema, partitioning=MONTH, path=scratch("t"))
    write([(1, dt.date(2024, 1, 5))], stamp(2024, 1, 10, 8), 1)
    write([(2, dt.date(2024, 2, 5))], stamp(2024, 2, 10, 8), 2)
    write([(3, dt.date(2024, 1, 6)), (4, dt.date(2024, 1, 7))], stamp(2024, 3, 1, 8), 1)
    write([(5, None)], stamp(2024, 3, 2, 8), None)
    write([], stamp(2025, 1, 1, 8), 2)
    at = lambda *a: sorted(r["v"] for r in ts.read_archive_as_of(spark, root, table_name, stamp(*a)).collect())
    assert at(2024, 1, 10, 8) == [1] and at(2024, 2, 11) == [1, 2] and at(2024, 3, 1, 7) == [1, 2]
    assert at(2024, 3, 1, 8) == [2, 3, 4] and at(2024, 12, 31) == [2, 3, 4, 5] and at(2026, 1, 1) == [3, 4, 5]
    with pytest.raises(ValueError, match="no archive copy"):
        ts.read_archive_as_of(spark, root, table_name, stamp(2023, 1, 1))
    assert ts.list_archives(spark, root, table_name).count() == 5
    assert ts.list_archives(spark, root, "other").collect() == []


def test_archive_as_of_with_changed_schema(spark, table_name, scratch):
    root = scratch("arch2")
    one = spark.sql("select 1 as k, cast(1.5 as decimal(38,18)) as p")
    ts.write_table(one, table_name, path=scratch("u"), archive=True, archive_root=root, encode_decimals=True, now=stamp(2024, 1, 1))
    ts.write_table(one.withColumn("k", F.lit(2)), table_name, archive=True, archive_root=root, encode_decimals=True, now=stamp(2024, 1, 2))
    back = ts.read_archive_as_of(spark, root, table_name, stamp(2024, 1, 1, 12))
    assert back.collect()[0]["k"] == 1 and "BigDecimalType" in back.schema["p"].metadata["comment"]
    assert ts.read_archive_as_of(spark, root, table_name, stamp(2024, 5, 1)).collect()[0]["k"] == 2
