"""Benchmark the headline table operations; prints one JSON line.

The input (``lineitem`` at ``$BENCH_SF_DIR``) is first written as two files a
core, so every case has parallel work. Each case runs ``BENCH_REPS`` times
(default 3); the order of the cases rotates from one repetition to the next,
and the median is reported. The row-wise comparison has as many runs.

  encode_write       wide decimals encoded and written to a new table (V1, W1)
  read_restore       table read back, decimals restored, summed per flag (R1, V2)
  partitioned_write  encoded and written month-partitioned, rebalanced by month (W6, D3)
  filtered_read      month-partitioned table, one quarter read via partition pruning (R1, D6)
  replace_partition  one month of a partitioned table replaced (W2)
  archive_write      write with a dated ORC archive copy (W3)
  conform_write      lineitem conformed to warehouse types and written (V3, W1)
  clustered_write    written clustered by part key (W5)
  full_overwrite     an existing table overwritten, old rows kept until done (W1a)
  external_read      external CSV read under its load rules and summed (R4)
  rowwise_codec      for comparison only: the same encode + restore done row by
                     row through the RDD API, the design the reference uses

``value`` is the sum of the library cases (the row-wise case is excluded).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import tessera as ts  # noqa: E402
from tessera.session import scratch_path, unique_name  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("tessera-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-bench-"))
             .config("spark.sql.shuffle.partitions", str(int(CPUS) * 2))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def split_input(spark) -> str:
    """``lineitem`` as two files a core."""
    path = scratch_path(spark, "bench-lineitem")
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").repartition(int(CPUS) * 2).write.parquet(path)
    return path


def lineitem_wide(spark, path):
    li = spark.read.parquet(path)
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                     F.col("l_quantity"),
                     F.col("l_extendedprice").cast("decimal(38,18)").alias("price"),
                     F.col("l_tax").cast("decimal(38,18)").alias("tax"),
                     F.col("l_discount").cast("decimal(38,18)").alias("discount"),
                     "l_shipdate")


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    spark = session()
    path = split_input(spark)
    src = lineitem_wide(spark, path)
    month = ts.PartitionSpec("l_shipdate", "timestamp", ts.TimePartitioning("MONTH"))

    def new_table(label):
        name = unique_name(label)
        return name, scratch_path(spark, name)

    # tables that the reading and replacing cases work on; also the warm-up
    base, at = new_table("base")
    ts.write_table(src, base, encode_decimals=True, path=at)
    parted, at = new_table("parted")
    ts.write_table(src, parted, encode_decimals=True, partitioning=month, path=at)
    full, at = new_table("full")
    ts.write_table(src, full, encode_decimals=True, path=at)
    csv = scratch_path(spark, "bench-csv")
    spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice").write.csv(csv)

    def encode_write():
        name, at = new_table("enc")
        ts.write_table(src, name, encode_decimals=True, path=at)

    def read_restore():
        ts.read_table(spark, base).groupBy("l_returnflag").agg(
            F.sum("price"), F.sum("tax"), F.sum("discount"), F.count("*")).collect()

    def partitioned_write():
        name, at = new_table("parted_w")
        ts.write_table(src, name, encode_decimals=True, partitioning=month, path=at)

    def filtered_read():
        ts.read_table(spark, parted, between=(dt.datetime(1997, 1, 1), dt.datetime(1997, 3, 31))) \
            .agg(F.sum("price"), F.count("*")).collect()

    one_month = dt.date(1997, 6, 1)
    month_rows = src.where(F.date_trunc("MONTH", "l_shipdate").cast("date") == F.lit(one_month)) \
        .withColumn("l_quantity", F.col("l_quantity") + 1)

    def replace_partition():
        ts.replace_partition(month_rows, parted, one_month, encode_decimals=True)

    def archive_write():
        name, at = new_table("arch")
        ts.write_table(src, name, encode_decimals=True, archive=True,
                       archive_root=scratch_path(spark, "archive"), path=at)

    def conform_write():
        name, at = new_table("conform")
        ts.write_table(ts.conform_types(src), name, path=at)

    parts = spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")

    def clustered_write():
        name, at = new_table("clustered")
        ts.write_table(parts, name, clustering=["l_partkey"], path=at)

    def full_overwrite():
        ts.write_table(src, full, encode_decimals=True)

    external = ts.ExternalData([csv], "CSV", schema="k bigint, line int, flag string, price double")

    def external_read():
        ts.read_external(spark, external).groupBy("flag").agg(F.sum("price"), F.count("*")).collect()

    library = [encode_write, read_restore, partitioned_write, filtered_read, replace_partition, archive_write,
               conform_write, clustered_write, full_overwrite, external_read]

    # --- comparison: row-by-row codec through the RDD API (reference design)
    wide_idx = [i for i, f in enumerate(src.schema.fields)
                if isinstance(f.dataType, T.DecimalType) and f.dataType.scale > 9]
    enc_schema = T.StructType([
        T.StructField(f.name, T.StringType(), True, {"comment": ts.TAG}) if i in wide_idx else f
        for i, f in enumerate(src.schema.fields)])
    dec_schema = src.schema

    def enc_row(row):
        return tuple((None if v is None else str(v)) if i in wide_idx else v
                     for i, v in enumerate(row))

    def dec_row(row):
        return tuple((None if v is None else Decimal(v)) if i in wide_idx else v
                     for i, v in enumerate(row))

    def rowwise_codec():
        name, path = new_table("rowwise")
        encoded = spark.createDataFrame(src.rdd.map(enc_row), enc_schema)
        encoded.write.option("path", path).saveAsTable(name)
        back = spark.createDataFrame(spark.table(name).rdd.map(dec_row), dec_schema)
        back.groupBy("l_returnflag").agg(F.sum("price"), F.sum("tax"), F.sum("discount"),
                                         F.count("*")).collect()
    def columnar_codec():
        name, path = new_table("columnar")
        ts.write_table(src, name, encode_decimals=True, path=path)
        ts.read_table(spark, name).groupBy("l_returnflag").agg(
            F.sum("price"), F.sum("tax"), F.sum("discount"), F.count("*")).collect()

    cases = [*library, columnar_codec, rowwise_codec]
    seconds: dict[str, list[float]] = {fn.__name__: [] for fn in cases}
    for fn in cases:  # once more, so that every case finds its code compiled
        if fn is not rowwise_codec:
            fn()
    for rep in range(REPS):
        turn = rep * len(cases) // max(1, REPS)
        for fn in cases[turn:] + cases[:turn]:
            seconds[fn.__name__].append(timed(fn))
    results = {name: statistics.median(took) for name, took in seconds.items()}
    print(json.dumps({
        "metric": "table_ops_total_sec",
        "value": round(sum(results[fn.__name__] for fn in library), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
        "rows": src.count(),
        "rowwise_over_columnar": round(results["rowwise_codec"] / results["columnar_codec"], 2),
        "cpus": int(CPUS),
        "reps": REPS,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
