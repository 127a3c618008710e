"""Cluster depth, and order restored where it is disturbed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import tessera as ts
from tessera.operators import cluster_depth, recluster as module, versions
from tessera.session import unique_name

MONTH = ts.PartitionSpec("d", "date", ts.TimePartitioning("MONTH"))


def depths(spark, name):
    return {r["partition"]: r["depth"] for r in cluster_depth(spark, name).collect()}


def names(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def rows(spark, n, seed):
    return spark.range(n).select((F.col("id") * 7919 % 1000 + seed).alias("k"),
                                 F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"))


def test_depth_of_hand_made_ranges(spark, table_name, scratch):
    path = scratch("hand")
    ts.create_table(spark, table_name, spark.range(1).toDF("k").schema, path=path, clustering=["k"])
    for lo, hi in ((0, 10), (10, 20), (5, 12), (6, 8), (30, 30), (30, 40)):
        spark.createDataFrame([(lo,), (hi,)], "k bigint").coalesce(1).write.insertInto(table_name)
    assert depths(spark, table_name) == {"": 3}


def test_plain_table(spark, table_name, scratch):
    df = rows(spark, 900, 0).select("k")
    ts.write_table(df, table_name, path=scratch("plain"), clustering=["k"], cluster_partitions=4)
    assert depths(spark, table_name) == {"": 1}
    kept = names(spark, table_name)
    assert ts.recluster(spark, table_name).rewritten == [] and names(spark, table_name) == kept
    for _ in range(3):
        df.write.insertInto(table_name)
    assert depths(spark, table_name)[""] > 1
    assert ts.recluster(spark, table_name).rewritten == [""]
    assert depths(spark, table_name) == {"": 1} and spark.table(table_name).count() == 3600


def test_disturbed_partitions_only(spark, scratch):
    name = unique_name("part")
    ts.write_table(rows(spark, 900, 0), name, partitioning=MONTH, path=scratch("part"), clustering=["k"])
    null_rows = rows(spark, 40, 5).withColumn("d", F.lit(None).cast("date"))
    for k in range(3):
        ts.write_table(rows(spark, 300, k).where("month(d) = 2").union(null_rows), name, mode="append", clustering=[])
    ts.update_table_schema(spark, name, clustering=["k"])
    before = depths(spark, name)
    assert before["2024-01-01"] == before["2024-03-01"] == 1 and before["2024-02-01"] > 1
    total, kept = spark.table(name).count(), {f for f in names(spark, name) if "month=2024-01" in f or "month=2024-03" in f}
    done = ts.recluster(spark, name)
    assert done.rewritten == ["d__month=2024-02-01", "d__month=__HIVE_DEFAULT_PARTITION__"] and done.untouched == 2
    assert kept <= names(spark, name) and set(depths(spark, name).values()) == {1}
    assert spark.table(name).count() == total
    assert ts.recluster(spark, name).rewritten == []
    assert ts.read_table(spark, name, partition_value=None).count() == 120


def test_append_in_between_is_not_lost(spark, table_name, scratch, monkeypatch):
    df = rows(spark, 300, 0).select("k")
    ts.write_table(df, table_name, path=scratch("race"), clustering=["k"])
    df.write.insertInto(table_name)
    real = versions.commit

    def late(s, base, *a, **kw):
        monkeypatch.undo()
        ts.write_table(df.limit(7), table_name, mode="append", clustering=[])
        return real(s, base, *a, **kw)
    monkeypatch.setattr(versions, "commit", late)
    with pytest.raises(ts.ConcurrentWrite):
        ts.recluster(spark, table_name)
    assert spark.table(table_name).count() == 607


def test_needs_a_clustered_table(spark, table_name, scratch):
    ts.write_table(spark.range(3), table_name, path=scratch("none"))
    with pytest.raises(ValueError, match="not clustered"):
        module(spark, table_name)
