"""Partition derivation in Spark and on the driver agree, and the implied
partition predicate never drops a row the source filter keeps."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tessera as ts

_settings = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


@_settings
@given(start=st.integers(-50, 50), width=st.integers(1, 40), steps=st.integers(1, 6),
       keys=st.lists(st.one_of(st.none(), st.integers(-120, 320)), min_size=1, max_size=30),
       lo=st.integers(-150, 350), span=st.integers(0, 200))
def test_range_buckets_and_pruning(spark, start, width, steps, keys, lo, span):
    spec = ts.PartitionSpec("k", "int64", ts.RangePartitioning(start, start + width * steps, width))
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    rows = spec.with_partition_column(df).collect()
    for r in rows:
        assert r[spec.partition_column] == spec.derive_python(r["k"])
    hi = lo + span
    kept = spec.with_partition_column(df).where(F.col("k").between(lo, hi))
    pruned = kept.where(spec.between_predicate(lo, hi))
    assert kept.count() == pruned.count()


_times = st.datetimes(min_value=dt.datetime(1999, 12, 30), max_value=dt.datetime(2001, 1, 2))


@_settings
@given(unit=st.sampled_from(["HOUR", "DAY", "MONTH", "YEAR"]),
       values=st.lists(_times, min_size=1, max_size=30), lo=_times,
       span=st.timedeltas(min_value=dt.timedelta(0), max_value=dt.timedelta(days=90)))
def test_time_buckets_and_pruning(spark, unit, values, lo, span):
    spec = ts.PartitionSpec("t", "timestamp", ts.TimePartitioning(unit))
    df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
    for r in spec.with_partition_column(df).collect():
        assert r[spec.partition_column] == spec.derive_python(r["t"])
    hi = lo + span
    src = spec.source_between(F.col("t"), df.schema["t"].dataType, lo, hi)
    kept = spec.with_partition_column(df).where(src)
    assert kept.count() == kept.where(spec.between_predicate(lo, hi)).count()
