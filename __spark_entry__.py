"""

Each query exercises one operator of the library on the whole driver
tables and returns a lazy DataFrame over what it wrote. Tables and files go
under the cluster's shared folder (``spark.checkpoint.dir``) with unique
names, and are left in place so the returned DataFrame stays readable.

Decimal results are returned as their canonical text (``cast(... as
string)``, which Spark under ANSI mode and DuckDB print identically); where
the type is the point, a ``*_type`` column reports it with ``typeof``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tessera as ts
from tessera.functions.decimals import TAG, decimal_text
from tessera.operators import versions
from tessera.session import file_names, scratch_path, unique_name

W = "decimal(38,18)"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _table(spark: SparkSession, label: str) -> tuple[str, str]:
    name = unique_name(label)
    return name, scratch_path(spark, name)


def _wide(c: str) -> F.Column:
    return F.col(c).cast(W)


def _text(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _dec_text(c, scale: int = 18) -> F.Column:
    """Plain text of a decimal, the same with or without ANSI mode."""
    c = F.col(c) if isinstance(c, str) else c
    return decimal_text(c, scale)


def _money_sum(c: str) -> F.Column:
    """Exact sum of a two-decimal amount, as text."""
    return _text(F.sum(F.col(c).cast("decimal(18,2)")))


def _tagged_text(c: F.Column, name: str) -> F.Column:
    return c.alias(name, metadata={"comment": TAG})


def _lineitem_wide(spark, sf_dir) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     _wide("l_extendedprice").alias("price"), _wide("l_tax").alias("tax"),
                     "l_shipdate")


def _written(spark, sf_dir, label, df, **kw) -> str:
    name, path = _table(spark, label)
    ts.write_table(df, name, path=path, **kw)
    return name


# ------------------------------------------------------------------- entry

def entry(spark: SparkSession) -> DataFrame:
    """Encode wide prices, write a table, read it back restored, sum per flag."""
    sf_dir = "/root/testdata/sf0.001"
    name = _written(spark, sf_dir, "entry_lineitem", _lineitem_wide(spark, sf_dir),
                    encode_decimals=True)
    back = ts.read_table(spark, name)
    return (back.groupBy("l_returnflag")
            .agg(_dec_text(F.sum("price")).alias("sum_price"), F.count("*").alias("n_lines")))


# -------------------------------------------------------------- V: codec

def q_encode_flat(spark, sf_dir):
    enc = ts.encode_wide_decimals(_lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "price"))
    return enc.select("l_orderkey", "l_linenumber", "price",
                      F.typeof("price").alias("price_type"))


def q_encode_array(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.array("price", "tax").alias("amounts"))
    enc = ts.encode_wide_decimals(df)
    return enc.select("l_orderkey", "l_linenumber",
                      F.array_join("amounts", "|").alias("amounts"))


def q_encode_struct(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("tax"), F.col("l_shipdate").alias("ship")).alias("s"))
    enc = ts.encode_wide_decimals(df)
    return enc.select("l_orderkey", "l_linenumber", F.col("s.tax").alias("tax"),
                      F.col("s.ship").alias("ship"), F.typeof("s.tax").alias("tax_type"))


def q_encode_array_struct(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.array(F.struct(F.lit("price").alias("kind"), F.col("price").alias("amount")),
                F.struct(F.lit("tax").alias("kind"), F.col("tax").alias("amount"))).alias("items"))
    enc = ts.encode_wide_decimals(df)
    return enc.select("l_orderkey", "l_linenumber", F.posexplode("items").alias("pos", "item")) \
        .select("l_orderkey", "l_linenumber", "pos", "item.kind", "item.amount")


def q_encode_map(spark, sf_dir):
    cu = _read(spark, sf_dir, "customer")
    df = cu.select("c_custkey", F.create_map("c_mktsegment", _wide("c_acctbal")).alias("m"))
    conf = ts.conform_types(ts.encode_wide_decimals(df))
    return conf.select("c_custkey", F.inline("m"))


def q_encode_selected(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select("l_orderkey", "l_linenumber", "price", "tax")
    enc = ts.encode_wide_decimals(df, columns=["price"])
    return enc.select("l_orderkey", "l_linenumber", "price", _dec_text("tax").alias("tax"),
                      F.typeof("price").alias("price_type"), F.typeof("tax").alias("tax_type"))


def q_column_order_kept(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", F.col("price").alias("unit price"), "l_linenumber", "l_returnflag")
    return ts.encode_wide_decimals(df)


def _encoded_table(spark, sf_dir, label, df) -> str:
    return _written(spark, sf_dir, label, df, encode_decimals=True)


def q_restore_flat(spark, sf_dir):
    name = _encoded_table(spark, sf_dir, "restore_flat", _lineitem_wide(spark, sf_dir))
    back = ts.read_table(spark, name)
    return back.select("l_orderkey", "l_linenumber", _dec_text("price").alias("price"),
                       _dec_text("tax").alias("tax"), F.typeof("price").alias("price_type"))


def q_restore_struct(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("tax"), F.col("l_shipdate").alias("ship")).alias("s"))
    back = ts.read_table(spark, _encoded_table(spark, sf_dir, "restore_struct", df))
    return back.select("l_orderkey", "l_linenumber", _dec_text("s.tax").alias("tax"),
                       F.col("s.ship").alias("ship"), F.typeof("s.tax").alias("tax_type"))


def q_restore_array(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.array("price", "tax").alias("amounts"))
    back = ts.read_table(spark, _encoded_table(spark, sf_dir, "restore_array", df))
    return back.select("l_orderkey", "l_linenumber", F.posexplode("amounts").alias("pos", "amount")) \
        .select("l_orderkey", "l_linenumber", "pos", _dec_text("amount").alias("amount"),
                F.typeof("amount").alias("amount_type"))


def q_restore_array_struct(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.array(F.struct(F.lit("price").alias("kind"), F.col("price").alias("amount")),
                F.struct(F.lit("tax").alias("kind"), F.col("tax").alias("amount"))).alias("items"))
    back = ts.read_table(spark, _encoded_table(spark, sf_dir, "restore_array_struct", df))
    return back.select("l_orderkey", "l_linenumber", F.posexplode("items").alias("pos", "item")) \
        .select("l_orderkey", "l_linenumber", "pos", "item.kind",
                _dec_text("item.amount").alias("amount"), F.typeof("item.amount").alias("amount_type"))


def q_restore_map(spark, sf_dir):
    cu = _read(spark, sf_dir, "customer")
    df = cu.select("c_custkey", F.create_map("c_mktsegment", _wide("c_acctbal")).alias("m"))
    back = ts.read_table(spark, _encoded_table(spark, sf_dir, "restore_map", df))
    return back.select("c_custkey", F.explode("m").alias("segment", "balance")) \
        .select("c_custkey", "segment", _dec_text("balance").alias("balance"),
                F.typeof("balance").alias("balance_type"))


def q_restore_selected(spark, sf_dir):
    name = _encoded_table(spark, sf_dir, "restore_selected", _lineitem_wide(spark, sf_dir))
    back = ts.read_table(spark, name, columns=["price"])
    return back.select("l_orderkey", "l_linenumber", _dec_text("price").alias("price"), "tax",
                       F.typeof("price").alias("price_type"), F.typeof("tax").alias("tax_type"))


def q_restore_lenient(spark, sf_dir):
    li = _lineitem_wide(spark, sf_dir)
    text = (F.when(F.col("l_linenumber") == 2, F.concat(_dec_text("price"), F.lit("x")))
            .when(F.col("l_linenumber") == 4, F.lit(""))
            .otherwise(_dec_text("price")))
    df = li.select("l_orderkey", "l_linenumber", _tagged_text(text, "price"))
    back = ts.restore_decimals(df, lenient=True)
    return back.select("l_orderkey", "l_linenumber", _dec_text("price").alias("price"))


def q_conform_types(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    df = o.select(F.col("o_orderkey"), F.col("o_custkey").cast("int").alias("cust_int"),
                  F.col("o_totalprice").cast("decimal(20,2)").alias("total_n"),
                  _wide("o_totalprice").alias("total_w"),
                  F.col("o_orderstatus").cast("varchar(1)").alias("status"),
                  F.col("o_orderdate"))
    c = ts.conform_types(df, unify=True)
    return c.select("o_orderkey", "cust_int", _dec_text("total_n", 9).alias("total_n"), "total_w",
                    "status", "o_orderdate",
                    F.typeof("cust_int").alias("cust_int_type"),
                    F.typeof("total_n").alias("total_n_type"),
                    F.typeof("total_w").alias("total_w_type"))


# ------------------------------------------------------------ R: sources

def q_read_raw(spark, sf_dir):
    name = _encoded_table(spark, sf_dir, "read_raw", _lineitem_wide(spark, sf_dir))
    raw = ts.read_raw(spark, name)
    return raw.select("l_orderkey", "l_linenumber", "price", "tax",
                      F.typeof("price").alias("price_type"))


def q_read_restored(spark, sf_dir):
    name = _encoded_table(spark, sf_dir, "read_restored", _lineitem_wide(spark, sf_dir))
    back = ts.read_table(spark, name)
    return back.groupBy("l_returnflag").agg(_dec_text(F.sum("price")).alias("sum_price"),
                                            _dec_text(F.sum("tax")).alias("sum_tax"),
                                            F.count("*").alias("n_lines"))


def q_preview_rows(spark, sf_dir):
    name = _encoded_table(spark, sf_dir, "preview", _lineitem_wide(spark, sf_dir))
    # (l_orderkey, l_linenumber) repeats in this data: order by every output column
    p = ts.preview(ts.read_table(spark, name), 20,
                   order_by=["l_orderkey", "l_linenumber", "price"])
    return p.select("l_orderkey", "l_linenumber", _dec_text("price").alias("price"))


# -------------------------------------------------------------- W: sinks

def _orders_cols(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def q_write_append(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "write_append", o)
    ts.write_table(o, name, mode="append")
    return spark.table(name)


def q_write_overwrite(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "write_overwrite", o)
    ts.write_table(o.withColumn("o_totalprice", F.col("o_totalprice") + 1), name, mode="overwrite")
    return spark.table(name)


def q_write_ignore(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "write_ignore", o)
    res = ts.write_table(o.withColumn("o_totalprice", F.col("o_totalprice") + 1), name,
                         mode="ignore")
    return spark.table(name).withColumn("status", F.lit(res.status))


def q_write_options(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "write_options", o, options={"compression": "gzip"})
    return spark.table(name)


def q_write_codec(spark, sf_dir):
    """The codec a written table's files have, by their names."""
    o = _orders_cols(spark, sf_dir)
    out = []
    for codec in ("gzip", "zstd"):
        name = _written(spark, sf_dir, f"codec_{codec}", o, options={"compression": codec})
        suffix = F.regexp_extract(F.input_file_name(), r"\.(\w+)\.parquet$", 1)
        out.append(spark.table(name).groupBy(F.when(suffix == "gz", "gzip").otherwise(suffix).alias("codec"))
                   .agg(F.count("*").alias("n_orders"), _money_sum("o_totalprice").alias("total")))
    return out[0].union(out[1])


def q_write_error_if_exists(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "error_mode", o, mode="errorifexists")
    try:
        said = ts.write_table(o, name, mode="errorifexists").status
    except RuntimeError as e:
        said = "refused" if "already exists" in str(e) else str(e)
    return spark.table(name).withColumn("second_write", F.lit(said))


def _month_spec(expiration_ms=None, require=False) -> ts.PartitionSpec:
    return ts.PartitionSpec("o_orderdate", "timestamp", ts.TimePartitioning("MONTH", expiration_ms))


REPLACED_MONTH = dt.date(1995, 3, 1)
CURVE_LO, CURVE_HI = dt.datetime(1996, 1, 1), dt.datetime(1996, 6, 30)


def q_replace_partition(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    spec = _month_spec()
    name = _written(spark, sf_dir, "replace_partition", o, partitioning=spec)
    month = F.date_trunc("MONTH", "o_orderdate").cast("date")
    part = o.where(month == F.lit(REPLACED_MONTH)).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)
    ts.replace_partition(part, name, REPLACED_MONTH)
    return ts.read_table(spark, name)


ARCHIVE_CLOCK = dt.datetime(2024, 5, 17, 8, 30, 0)


def q_archive_copy(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir)
    name, path = _table(spark, "archive_copy")
    res = ts.write_table(df, name, path=path, encode_decimals=True, archive=True,
                         archive_root=scratch_path(spark, "archive"), now=ARCHIVE_CLOCK)
    arch = ts.read_archive(spark, res.archive_path)
    year, stamp = res.archive_path.split("/")[-2:]
    return arch.select("l_orderkey", "l_linenumber", "price", "tax",
                       F.lit(f"{year}/{stamp}").alias("year_stamp"))


def q_clustered_write(spark, sf_dir):
    df = _lineitem_wide(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag",
                                              "l_shipdate")
    name = _written(spark, sf_dir, "clustered", df, clustering=["l_returnflag", "l_shipdate"])
    return spark.table(name)


# ------------------------------------------------------ D: partitioning

RANGE = ts.RangePartitioning(100, 1000, 50)


def q_range_partition_counts(spark, sf_dir):
    spec = ts.PartitionSpec("o_custkey", "int64", RANGE)
    name = _written(spark, sf_dir, "range_part", _orders_cols(spark, sf_dir), partitioning=spec)
    back = ts.read_table(spark, name, keep_partition_column=True)
    return back.groupBy(F.col(spec.partition_column).alias("bucket")).agg(
        F.count("*").alias("n_orders"))


def q_month_partition_counts(spark, sf_dir):
    spec = _month_spec()
    name = _written(spark, sf_dir, "month_part", _orders_cols(spark, sf_dir), partitioning=spec)
    back = ts.read_table(spark, name, keep_partition_column=True)
    return back.groupBy(F.col(spec.partition_column).alias("month")).agg(
        F.count("*").alias("n_orders"), _money_sum("o_totalprice").alias("total"))


def q_hour_partition_counts(spark, sf_dir):
    spec = ts.PartitionSpec("ts", "timestamp", ts.TimePartitioning("HOUR"))
    ev = _read(spark, sf_dir, "events")
    name = _written(spark, sf_dir, "hour_part", ev, partitioning=spec)
    back = ts.read_table(spark, name, keep_partition_column=True)
    return back.groupBy(F.col(spec.partition_column).alias("hour")).agg(
        F.count("*").alias("n_events"))


EXPIRY_AS_OF = dt.datetime(2000, 1, 1)
LIFETIME_MS = 365 * 24 * 3600 * 1000


def q_partition_expiry(spark, sf_dir):
    spec = _month_spec(expiration_ms=LIFETIME_MS)
    name = _written(spark, sf_dir, "expiry", _orders_cols(spark, sf_dir), partitioning=spec)
    ts.expire_partitions(spark, name, EXPIRY_AS_OF)
    return ts.read_table(spark, name)


FILTER_LO, FILTER_HI = dt.datetime(1996, 2, 10), dt.datetime(1997, 7, 20)


def q_filtered_partition_read(spark, sf_dir):
    spec = _month_spec()
    name = _written(spark, sf_dir, "filtered", _orders_cols(spark, sf_dir), partitioning=spec,
                    require_partition_filter=True)
    return ts.read_table(spark, name, between=(FILTER_LO, FILTER_HI))


RANGE_LO, RANGE_HI = 250, 1200   # the upper bound lies past the range end


def q_filtered_range_read(spark, sf_dir):
    spec = ts.PartitionSpec("o_custkey", "int64", RANGE)
    name = _written(spark, sf_dir, "range_filtered", _orders_cols(spark, sf_dir),
                    partitioning=spec, require_partition_filter=True)
    return ts.read_table(spark, name, between=(RANGE_LO, RANGE_HI))


def q_day_partition_counts(spark, sf_dir):
    spec = ts.PartitionSpec("ts", "timestamp", ts.TimePartitioning("DAY"))
    name = _written(spark, sf_dir, "day_part", _read(spark, sf_dir, "events"), partitioning=spec)
    back = ts.read_table(spark, name, keep_partition_column=True)
    return back.groupBy(F.col(spec.partition_column).alias("day")).agg(
        F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"))


def q_year_partition_counts(spark, sf_dir):
    spec = ts.PartitionSpec("l_shipdate", "timestamp", ts.TimePartitioning("YEAR"))
    name = _written(spark, sf_dir, "year_part", _lineitem_wide(spark, sf_dir),
                    partitioning=spec, encode_decimals=True)
    back = ts.read_table(spark, name, keep_partition_column=True)
    return back.groupBy(F.col(spec.partition_column).alias("year")).agg(
        F.count("*").alias("n_lines"), _dec_text(F.sum("price")).alias("sum_price"))


REPLACED_BUCKET = 150


def q_replace_range_partition(spark, sf_dir):
    spec = ts.PartitionSpec("o_custkey", "int64", RANGE)
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "replace_range", o, partitioning=spec)
    bucket = spec.derive(F.col("o_custkey"))
    part = o.where(bucket == REPLACED_BUCKET).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    ts.replace_partition(part, name, REPLACED_BUCKET)
    return ts.read_table(spark, name)


def q_partition_append(spark, sf_dir):
    spec = _month_spec()
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "partition_append", o, partitioning=spec)
    month = F.date_trunc("MONTH", "o_orderdate").cast("date")
    ts.write_table(o.where(month == F.lit(REPLACED_MONTH)), name, mode="append",
                   partition_value=REPLACED_MONTH)
    return ts.read_table(spark, name)


def q_clustered_partitioned_write(spark, sf_dir):
    spec = _month_spec()
    name = _written(spark, sf_dir, "clustered_part", _orders_cols(spark, sf_dir),
                    partitioning=spec, clustering=["o_custkey"])
    return ts.read_table(spark, name)


# ------------------------------------------------------ D: definition

def q_create_if_absent(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name, path = _table(spark, "create_if_absent")
    first = ts.create_table(spark, name, o.schema, path=path, description="orders")
    second = ts.create_table(spark, name, o.schema, path=path, description="orders")
    ts.write_table(o, name, mode="append", create_if_not_exists=False)
    return spark.table(name).withColumn("created", F.lit(f"{first}/{second}"))


def q_table_properties(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "props", o, description="all orders",
                    friendly_name="Orders", labels={"team": "sales"}, location="EU")
    props = ts.operators.table_properties(spark, name)
    return spark.table(name).select(
        "o_orderkey", F.lit(props.get("friendly_name")).alias("friendly_name"),
        F.lit(props.get("label.team")).alias("label_team"),
        F.lit(props.get("region")).alias("region"))


def q_schema_update(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "schema_update", o)
    new_schema = T.StructType(o.schema.fields + [
        T.StructField("o_note", T.StringType(), True, {"comment": "free text"})])
    ts.update_table_schema(spark, name, new_schema)
    ts.write_table(o.withColumn("o_note", F.concat(F.lit("n"), _text("o_orderkey"))), name,
                   mode="append")
    return spark.table(name)


def q_column_override(spark, sf_dir):
    o = _orders_cols(spark, sf_dir).withColumn("o_totalprice", _wide("o_totalprice"))
    name, path = _table(spark, "column_override")
    ts.create_table(spark, name, o.schema, path=path, column_overrides=[
        {"name": "o_totalprice", "precision": "20", "scale": "4", "description": "gross"}])
    ts.write_table(o, name, mode="append")
    back = spark.table(name)
    return back.select("o_orderkey", _dec_text("o_totalprice", 4).alias("o_totalprice"),
                       F.typeof("o_totalprice").alias("price_type"))


def q_column_override_kinds(spark, sf_dir):
    """Overrides of a column's type, mode and length, and the type each column then has in the catalog."""
    o = _orders_cols(spark, sf_dir).select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
                                           F.col("o_custkey").alias("customers"))
    name, path = _table(spark, "override_kinds")
    ts.create_table(spark, name, o.schema, path=path, column_overrides=[
        {"name": "k", "c-type": "STRING", "mode": "REQUIRED"}, {"name": "status", "max-length": "3"},
        {"name": "customers", "mode": "REPEATED"}])
    rows = o.select(F.col("k").cast("string").alias("k"), "status", F.array("customers").alias("customers"))
    ts.write_table(rows, name, mode="append")
    try:
        ts.write_table(rows.withColumn("k", F.lit(None).cast("string")), name, mode="append")
        refused = False
    except Exception as e:  # the write job fails on the null
        refused = "required column k" in str(e)
    types = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {name}").collect()}
    return spark.table(name).select("k", "status", "customers", *[F.lit(types[c]).alias(f"{c}_type") for c in rows.columns],
                                    F.lit(refused).alias("null_refused"))


_SQL_MONEY = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS STRING)"


def _orders_table(spark, sf_dir, label) -> str:
    return _written(spark, sf_dir, label, _orders_cols(spark, sf_dir))


def q_view_query(spark, sf_dir):
    base = _orders_table(spark, sf_dir, "view_base")
    view = unique_name("orders_by_status")
    ts.create_view(spark, view, f"SELECT o_orderstatus, count(*) AS n_orders, {_SQL_MONEY} "
                                f"AS total FROM {base} GROUP BY o_orderstatus")
    return spark.table(view)


def q_view_replaced(spark, sf_dir):
    base = _orders_table(spark, sf_dir, "view_base2")
    view = unique_name("orders_view")
    ts.create_view(spark, view, f"SELECT o_orderstatus, count(*) AS n_orders FROM {base} "
                                "GROUP BY o_orderstatus")
    ts.update_view(spark, view, f"SELECT year(o_orderdate) AS yr, count(*) AS n_orders "
                                f"FROM {base} GROUP BY year(o_orderdate)")
    return spark.table(view)


def q_matview_refresh(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    base = _written(spark, sf_dir, "mv_base", o)
    mv, path = _table(spark, "mv")
    ts.create_materialized_view(spark, mv, f"SELECT o_orderstatus, count(*) AS n_orders, "
                                           f"{_SQL_MONEY} AS total FROM {base} "
                                           "GROUP BY o_orderstatus", path=path)
    ts.write_table(o, base, mode="append")
    ts.refresh_materialized_view(spark, mv)
    return spark.table(mv)


def q_snapshot_frozen(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    base = _written(spark, sf_dir, "snap_base", o)
    snap, path = _table(spark, "snap")
    ts.create_snapshot(spark, base, snap, path=path)
    ts.write_table(o.withColumn("o_totalprice", F.lit(0.0)), base, mode="overwrite")
    return spark.table(snap)


def q_table_expiry(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    db = unique_name("expiry_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    keep = _written(spark, sf_dir, f"{db}.keep", o.where(F.col("o_orderstatus") != "F"),
                    expiration_time=dt.datetime(2030, 1, 1))
    _written(spark, sf_dir, f"{db}.old", o.where(F.col("o_orderstatus") == "F"),
             expiration_time=dt.datetime(2020, 1, 1))
    ts.expire_tables(spark, dt.datetime(2025, 1, 1), db)
    names = [t.name for t in spark.catalog.listTables(db)]
    return spark.table(keep).withColumn("tables_left", F.lit(len(names)))


def q_create_with_derived_objects(spark, sf_dir):
    o = _orders_cols(spark, sf_dir)
    name, path = _table(spark, "derived_base")
    mv, v, snap = unique_name("derived_mv"), unique_name("derived_v"), unique_name("derived_snap")
    ts.create_table(spark, name, o.schema, path=path,
                    materialized_view=(mv, f"SELECT o_orderstatus, count(*) AS n_orders, "
                                           f"{_SQL_MONEY} AS total FROM {name} "
                                           "GROUP BY o_orderstatus"),
                    view=(v, f"SELECT o_orderstatus, o_totalprice FROM {name}"),
                    snapshot=snap)
    # created empty, then loaded: the stored view is refreshed, the snapshot stays empty
    ts.write_table(o, name, mode="append")
    ts.refresh_materialized_view(spark, mv)
    live = spark.table(v).groupBy("o_orderstatus").agg(F.count("*").alias("n_view"))
    frozen = spark.table(snap).count()          # one-row count
    return (spark.table(mv).join(live, "o_orderstatus")
            .withColumn("n_snapshot", F.lit(frozen)))


# --------------------------------------------------------- external files

def _export(df: DataFrame, fmt: str, spark, **opts) -> str:
    path = scratch_path(spark, f"export_{fmt}")
    df.write.options(**opts).format(fmt).save(path)
    return path


_ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
               "o_totalprice double, o_orderdate timestamp_ntz")


def _orders_export(spark, sf_dir) -> DataFrame:
    return _orders_cols(spark, sf_dir)


def _external(spark, name, ext):
    ts.define_external_table(spark, name, ext)
    res = ts.write_table(spark.table(name), name, mode="append")
    return ts.read_table(spark, name).withColumn("write_status", F.lit(res.status))


def q_external_csv(spark, sf_dir):
    path = _export(_orders_export(spark, sf_dir), "csv", spark, header="true")
    ext = ts.ExternalData([path], "CSV", schema=_ORDERS_DDL, options={"header": "true"})
    return _external(spark, unique_name("ext_csv"), ext)


def q_external_json(spark, sf_dir):
    path = _export(_orders_export(spark, sf_dir), "json", spark)
    ext = ts.ExternalData([path], "NEWLINE_DELIMITED_JSON", schema=_ORDERS_DDL)
    return _external(spark, unique_name("ext_json"), ext)


def _csv_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws(",", *[_text(c) for c in df.columns]).alias("value"))


def q_write_external_definition(spark, sf_dir):
    o = _orders_export(spark, sf_dir)
    path = _export(o, "json", spark)
    name = unique_name("ext_def")
    res = ts.write_table(o, name, external=ts.ExternalData([path], "NEWLINE_DELIMITED_JSON",
                                                            schema=_ORDERS_DDL))
    return ts.read_table(spark, name).withColumn("write_status", F.lit(res.status))


def q_external_bad_records(spark, sf_dir):
    o = _orders_export(spark, sf_dir)
    good = _csv_lines(o)
    # one broken line per urgent order: a price that is not a number
    broken = _csv_lines(o.where(F.col("o_orderstatus") == "P")
                        .withColumn("o_totalprice", F.lit("n/a")))
    path = scratch_path(spark, "bad_records")
    good.unionByName(broken).write.text(path)
    budget = o.where(F.col("o_orderstatus") == "P").count()
    ext = ts.ExternalData([path], "CSV", schema=_ORDERS_DDL, max_bad_records=budget)
    return ts.read_external(spark, ext)


def q_external_unknown_values(spark, sf_dir):
    o = _orders_export(spark, sf_dir).withColumn("o_extra", F.lit("unexpected"))
    path = _export(o, "json", spark)
    ext = ts.ExternalData([path], "NEWLINE_DELIMITED_JSON", schema=_ORDERS_DDL,
                          ignore_unknown_values=True)
    return ts.read_external(spark, ext)


def q_external_gzip_hive(spark, sf_dir):
    o = _orders_export(spark, sf_dir)
    path = scratch_path(spark, "hive_gzip")
    o.write.partitionBy("o_orderstatus").option("compression", "gzip").csv(path)
    ext = ts.ExternalData([path], "CSV", compression="GZIP",
                          schema="o_orderkey bigint, o_custkey bigint, o_totalprice double, "
                                 "o_orderdate timestamp_ntz",
                          hive_partitioning=ts.HivePartitioning(path, "STRINGS"))
    return ts.read_external(spark, ext)


def q_external_decimal_target(spark, sf_dir):
    o = _orders_export(spark, sf_dir).select(
        "o_orderkey", _text(F.col("o_totalprice").cast("decimal(20,2)")).alias("o_totalprice"))
    path = _export(o, "csv", spark)
    ext = ts.ExternalData([path], "CSV", schema="o_orderkey bigint, o_totalprice decimal(38,18)",
                          decimal_target_types=["NUMERIC", "BIGNUMERIC", "STRING"])
    df = ts.read_external(spark, ext)
    return df.select("o_orderkey", _dec_text("o_totalprice", 9).alias("o_totalprice"),
                     F.typeof("o_totalprice").alias("price_type"))


# --------------------------------------- rows that must not get lost or come back

def q_timestamp_partition_read(spark, sf_dir):
    """Zoned timestamps, hour partitions in UTC, read between two instants."""
    ev = _read(spark, sf_dir, "events").select(
        "event_id", "user_id", F.expr("cast(concat(cast(ts as string), '+00:00') as timestamp)").alias("at"))
    name = _written(spark, sf_dir, "utc_hours", ev,
                    partitioning=ts.PartitionSpec("at", "timestamp", ts.TimePartitioning("HOUR")))
    got = ts.read_table(spark, name, between=(dt.datetime(2024, 1, 5, 6), dt.datetime(2024, 1, 9, 18, 30)),
                        keep_partition_column=True)
    return got.select("event_id", "user_id", F.col("at__hour").alias("hour"))


BIG = 2**53


def q_big_range_read(spark, sf_dir):
    """Integer ranges beyond the exact doubles."""
    o = _orders_cols(spark, sf_dir).select((F.col("o_orderkey") + F.lit(BIG)).alias("k"), "o_custkey")
    name = _written(spark, sf_dir, "big_range", o, partitioning=ts.PartitionSpec(
        "k", "int64", ts.RangePartitioning(BIG, BIG + 10_000_000, 97)))
    got = ts.read_table(spark, name, between=(BIG + 11, BIG + 4001), keep_partition_column=True)
    return got.select("k", "o_custkey", F.col("k__range").alias("bucket"))


def _by_day_or_null(spark, sf_dir):
    return _orders_cols(spark, sf_dir).select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("d"))


def q_null_partition_replaced(spark, sf_dir):
    """The partition of rows without a date is replaced, all others stay."""
    o = _by_day_or_null(spark, sf_dir)
    name = _written(spark, sf_dir, "null_part", o,
                    partitioning=ts.PartitionSpec("d", "date", ts.TimePartitioning("YEAR")))
    ts.replace_partition(o.where("d is null").withColumn("o_orderkey", -F.col("o_orderkey")), name, None)
    return ts.read_table(spark, name)


def q_expiry_then_append(spark, sf_dir):
    """After expiry an append to an expired month brings only its own rows."""
    o = _orders_cols(spark, sf_dir).select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    name = _written(spark, sf_dir, "expire_append", o, partitioning=ts.PartitionSpec(
        "d", "date", ts.TimePartitioning("MONTH", 24 * 3600 * 1000)))
    ts.expire_partitions(spark, name, dt.datetime(1996, 1, 15))
    ts.write_table(o.where("d < date'1992-03-01'").withColumn("o_orderkey", -F.col("o_orderkey")), name, mode="append")
    return ts.read_table(spark, name)


def q_external_csv_count(spark, sf_dir):
    """Rows of an external CSV counted without a data column, by name and by rules."""
    path = _export(_orders_export(spark, sf_dir), "csv", spark, header="true")
    ext = ts.ExternalData([path], "CSV", schema=_ORDERS_DDL, options={"header": "true"})
    name = unique_name("ext_count")
    ts.define_external_table(spark, name, ext)
    by_name = spark.table(name).agg(F.count("*").alias("n_by_name"))
    return ts.read_table(spark, name).agg(F.count("*").alias("n")).join(by_name)


def q_external_unknown_csv(spark, sf_dir):
    """Extra tokens fall away, dates keep the reader's own format."""
    o = _orders_export(spark, sf_dir).select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    path = scratch_path(spark, "unknown_csv")
    o.select(F.concat_ws(",", _text("o_orderkey"), F.date_format("d", "dd/MM/yyyy"), F.lit("more")).alias("value")) \
        .write.text(path)
    return ts.read_external(spark, ts.ExternalData(
        [path], "CSV", schema="o_orderkey bigint, d date", ignore_unknown_values=True,
        options={"dateFormat": "dd/MM/yyyy"}))


def q_external_hive_by_name(spark, sf_dir):
    """A registered Hive layout read by its catalog name."""
    o = _orders_export(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "hive_by_name")
    o.write.partitionBy("o_orderstatus").csv(path)
    name = unique_name("hive_named")
    ts.define_external_table(spark, name, ts.ExternalData(
        [path], "CSV", schema="o_orderkey bigint", hive_partitioning=ts.HivePartitioning(path, "STRINGS")))
    return spark.table(name)


def q_external_two_folders(spark, sf_dir):
    """Files of two folders registered as one table."""
    o = _orders_export(spark, sf_dir)
    paths = [_export(o.where(f), "json", spark) for f in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'")]
    name = unique_name("two_folders")
    ts.define_external_table(spark, name, ts.ExternalData(paths, "NEWLINE_DELIMITED_JSON", schema=_ORDERS_DDL))
    return spark.table(name)


def q_rewrite_keeps_settings(spark, sf_dir):
    """Settings given with a write into an existing table, beside its rows."""
    o = _orders_cols(spark, sf_dir)
    name, path = _table(spark, "resettled")
    ts.write_table(o, name, path=path, description="first")
    ts.write_table(o, name, description="second", labels={"team": "sales"}, clustering=["o_custkey"],
                   column_overrides=[{"name": "o_custkey", "description": "buyer"}])
    props = ts.operators.tables.table_properties(spark, name)
    about = ts.operators.tables.table_layout(spark, name)["description"]
    back = spark.table(name)
    return back.select("o_orderkey", F.lit(about).alias("description"), F.lit(props["label.team"]).alias("team"),
                       F.lit(",".join(ts.operators.tables.clustering_of(props))).alias("clustering"),
                       F.lit(back.schema["o_custkey"].metadata.get("comment")).alias("buyer_comment"))


def q_comments_after_write(spark, sf_dir):
    """Tags and merged comments of a written and re-written table, beside its rows."""
    li = _lineitem_wide(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.col("price").alias("price", metadata={"comment": "net"}), "tax")
    name, path = _table(spark, "commented")
    ts.write_table(li.withColumn("tax", _text("tax")), name, path=path, encode_decimals=True,
                   column_overrides=[{"name": "l_orderkey", "description": "key"}])
    ts.write_table(li, name, encode_decimals=True, column_overrides=[{"name": "l_orderkey", "description": "of order"}])
    comment = lambda df, c: F.lit(df.schema[c].metadata.get("comment"))
    raw, back = spark.table(name), ts.read_table(spark, name)
    return back.select("l_orderkey", "l_linenumber", comment(raw, "price").alias("price_tag"),
                       comment(raw, "tax").alias("tax_tag"), comment(raw, "l_orderkey").alias("merged"),
                       comment(back, "price").alias("restored_comment"), F.typeof("price").alias("price_type"))


def q_snapshot_partitioned(spark, sf_dir):
    """A snapshot keeps the partitions of its table, so it prunes like it."""
    o = _orders_cols(spark, sf_dir)
    base = _written(spark, sf_dir, "snap_base", o,
                    partitioning=ts.PartitionSpec("o_orderdate", "timestamp", ts.TimePartitioning("MONTH")))
    name, path = _table(spark, "snap_parts")
    ts.create_snapshot(spark, base, name, path=path)
    return ts.read_table(spark, name, between=(dt.datetime(1995, 2, 1), dt.datetime(1995, 6, 30)))


def q_overwrite_from_itself(spark, sf_dir):
    """A table overwritten by a query over itself."""
    name = _written(spark, sf_dir, "itself", _orders_cols(spark, sf_dir))
    ts.write_table(spark.table(name).where("o_orderstatus = 'O'"), name)
    return spark.table(name)


def q_clustered_files(spark, sf_dir):
    """Key ranges of a clustered table's files: no two overlap beyond a shared end."""
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "ranges", o, clustering=["o_custkey"], cluster_partitions=6)
    f = (spark.table(name).groupBy(F.input_file_name().alias("file"))
         .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"), F.count("*").alias("n")))
    w = Window.orderBy("lo", "hi")  # one row a file
    return (f.withColumn("before", F.lag("hi").over(w))
            .agg(F.sum("n").alias("n_rows"), F.count_if(F.col("lo") < F.col("before")).alias("n_overlaps")))


def _without_suffix(spark, path: str) -> str:
    """Take the ``.gz`` off the names of a folder's files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in file_names(spark, path):
        if name.endswith(".gz"):
            fs.rename(hadoop(f"{path}/{name}"), hadoop(f"{path}/{name[:-3]}"))
    return path


def q_external_gzip_unnamed(spark, sf_dir):
    """Gzip files that lack the suffix, beside some that have it."""
    o = _orders_export(spark, sf_dir)
    path = _without_suffix(spark, _export(o.where("o_orderstatus <> 'F'"), "csv", spark, compression="gzip"))
    o.where("o_orderstatus = 'F'").write.mode("append").option("compression", "gzip").csv(path)
    return ts.read_external(spark, ts.ExternalData([path], "CSV", schema=_ORDERS_DDL, compression="GZIP"))


def q_external_autodetect(spark, sf_dir):
    """Types found from every row: one key and one price in the last file are wider than all others."""
    o = _orders_cols(spark, sf_dir)
    cells = o.select(_text("o_orderkey").alias("k"), _dec_text(F.col("o_totalprice").cast("decimal(20,2)"), 2).alias("price"),
                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    path = _export(cells, "csv", spark, header=True)
    wide = o.agg(F.lit("9" * 20).alias("k"), F.lit("0." + "1" * 12).alias("price"), F.lit("2024-02-29").alias("day"))
    wide.coalesce(1).write.mode("append").option("header", True).csv(path)
    df = ts.read_external(spark, ts.ExternalData([path], "CSV", autodetect=True, options={"header": "true"}))
    return df.select(_text("k").alias("k"), _dec_text("price", 12).alias("price"), "day",
                     *[F.lit(t).alias(f"{c}_type") for c, t in df.dtypes])


def q_external_autodetect_json(spark, sf_dir):
    """Nested JSON: structs, arrays, exact decimals and dates found from every row."""
    o = _orders_cols(spark, sf_dir)
    docs = o.groupBy("o_custkey").agg(
        F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("k"),
                                             F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
                                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))).alias("orders"),
        F.struct(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("latest")).alias("seen"))
    path = _export(docs, "json", spark)
    df = ts.read_external(spark, ts.ExternalData([path], "JSON", autodetect=True))
    item = F.explode("orders").alias("o")
    return df.select("o_custkey", F.col("seen.latest").alias("latest"), F.typeof("seen.latest").alias("latest_type"), item).select(
        "o_custkey", "latest", "latest_type", F.col("o.k").alias("k"), F.col("o.price").cast("double").alias("price"),
        F.col("o.day").alias("day"), F.typeof("o.day").alias("day_type"),
        F.substring(F.typeof("o.price"), 1, 7).alias("price_kind"))


# ------------------------------------------------ versions, stored aggregates

def _monthly(spark, sf_dir, label, **kw) -> str:
    return _written(spark, sf_dir, label, _orders_cols(spark, sf_dir), partitioning=_month_spec(**kw))


def q_matview_incremental(spark, sf_dir):
    """A stored aggregate after its table gained rows in one month and had another replaced: two months are read."""
    o = _orders_cols(spark, sf_dir)
    base = _monthly(spark, sf_dir, "inc_base")
    view, path = _table(spark, "inc_view")
    ts.create_incremental_view(
        spark, view, base, path=path, keys={"o_orderstatus": "o_orderstatus", "yr": "year(o_orderdate)"},
        measures={"n_orders": ts.Measure("count"), "total": ts.Measure("sum", "CAST(o_totalprice AS DECIMAL(18,2))"),
                  "lowest": ts.Measure("min", "o_totalprice"), "highest": ts.Measure("max", "o_totalprice")})
    month = F.date_trunc("month", "o_orderdate").cast("date")
    ts.write_table(o.where(month == F.lit(dt.date(1995, 5, 1))), base, mode="append")
    ts.replace_partition(o.where(month == F.lit(REPLACED_MONTH)).withColumn("o_totalprice", F.col("o_totalprice") * 2),
                         base, REPLACED_MONTH)
    done = ts.refresh_incremental_view(spark, view)
    return spark.table(view).select("o_orderstatus", "yr", "n_orders", _text("total").alias("total"), "lowest", "highest",
                                    F.lit(len(done.changed)).alias("n_read"), F.lit(done.unchanged).alias("n_left"))


def q_snapshot_shared(spark, sf_dir):
    """A snapshot reads its rows from the base's own files after those were expired, replaced and dropped."""
    o = _orders_cols(spark, sf_dir)
    db = unique_name("shared_db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    base = _monthly(spark, sf_dir, f"{db}.base", expiration_ms=86_400_000)
    snap, path = _table(spark, "shared_snap")
    ts.create_snapshot(spark, base, snap, path=path)
    home = spark.table(base).select(F.input_file_name().alias("f")).first()["f"].rsplit("/", 2)[0]
    ts.write_table(o, base, mode="append")
    ts.expire_partitions(spark, base, EXPIRY_AS_OF)
    ts.write_table(o.withColumn("o_totalprice", F.lit(0.0)), base)
    ts.update_table_schema(spark, base, expiration_time=dt.datetime(2020, 1, 1))
    ts.expire_tables(spark, dt.datetime(2025, 1, 1), db)
    return ts.read_table(spark, snap).withColumn("shared", F.startswith(F.input_file_name(), F.lit(home)))


def q_two_writers(spark, sf_dir):
    """Of two writers that start from one version the quicker one stays and the other fails as a whole."""
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "two_writers", o)
    start = versions.begin(spark, name)
    ts.write_table(o.where("o_orderstatus <> 'F'"), name)
    late = start.fresh_folder()
    o.where("o_orderstatus = 'F'").write.parquet(late)
    try:
        versions.commit(spark, start, "overwrite", location=late)
        said = "written"
    except ts.ConcurrentWrite:
        said = "refused"
    return spark.table(name).withColumn("late_writer", F.lit(said))


def q_unfinished_overwrite(spark, sf_dir):
    """A writer of whole months died after its commit and before the catalog knew: the next reader makes it good."""
    name = _monthly(spark, sf_dir, "unfinished")
    start = versions.begin(spark, name)
    left = start.fresh_folder()
    o = _orders_cols(spark, sf_dir)
    month = _month_spec().derive(F.col("o_orderdate"), o.schema["o_orderdate"].dataType)
    column = _month_spec().partition_column
    o.where("o_orderstatus = 'O'").withColumn(column, month).write.partitionBy(column).parquet(left)
    parts = [p for p in file_names(spark, left) if "=" in p]
    versions.publish(spark, start, "overwrite", location=left, changes={p: f"{left}/{p}" for p in parts})
    before = spark.table(name).count()
    return ts.read_table(spark, name).withColumn("n_before", F.lit(before))


def q_recluster(spark, sf_dir):
    """Three unordered appends to two months of a clustered table, put in order: the other months' files stay."""
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "recluster", o, partitioning=_month_spec(), clustering=["o_custkey"])
    month = F.date_trunc("month", "o_orderdate").cast("date")
    some = o.where(month.isin([REPLACED_MONTH, dt.date(1995, 5, 1)]))
    for k in range(3):
        ts.write_table(some.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == k), name, mode="append", clustering=[])
    ts.update_table_schema(spark, name, clustering=["o_custkey"])
    files = lambda: spark.table(name).select(month.alias("m"), F.col("_metadata.file_name").alias("file")).distinct()
    before = {tuple(r) for r in files().collect()}
    done = ts.recluster(spark, name)
    kept = len({r[0] for r in before & {tuple(r) for r in files().collect()}})
    deepest = ts.operators.cluster_depth(spark, name).agg(F.max("depth")).first()[0]
    return spark.table(name).drop(_month_spec().partition_column).withColumns(
        {"n_rewritten": F.lit(len(done.rewritten)), "n_kept": F.lit(kept), "depth": F.lit(deepest)})


# ------------------------------------------------------- reads that leave files out

def q_pruned_join(spark, sf_dir):
    """Orders of the dates of some customers' first orders: the months to read come from those keys at run time."""
    base = _monthly(spark, sf_dir, "pruned")
    firsts = (_read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
              .where("o_custkey % 50 = 1").select("first").distinct())
    df = ts.read_matching(spark, base, firsts, {"first": "o_orderdate"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    return df.withColumn("pruned", F.lit("dynamicpruning" in plan))


def q_file_skipping(spark, sf_dir):
    """Orders of one customer, and how many of the table's files their summaries leave to be read."""
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "skipping", o, clustering=["o_orderkey"], cluster_partitions=16, summaries=["o_custkey"])
    custkey = o.agg(F.min("o_custkey")).first()[0]
    read = ts.read_table(spark, name, points={"o_custkey": custkey})
    listed = ts.operators.candidate_files(spark, name, {"o_custkey": custkey}).count()
    holding = read.select("_metadata.file_name").distinct().count()
    return read.withColumn("files_enough", F.lit(holding <= listed < 16))


def q_curve_files(spark, sf_dir):
    """A range of the second cluster column alone leaves under half of the files of a table laid out along a curve."""
    o = _orders_cols(spark, sf_dir)
    name = _written(spark, sf_dir, "curve", o, clustering=["o_custkey", "o_orderdate"], cluster_partitions=16,
                    cluster_curve=True, summaries=["o_custkey", "o_orderdate"])
    span = {"o_orderdate": (CURVE_LO, CURVE_HI)}
    files = spark.table(name).select("_metadata.file_name").distinct().count()
    listed = ts.operators.candidate_files(spark, name, ranges=span).count()
    return ts.read_table(spark, name, ranges=span).withColumn("under_half", F.lit(2 * listed < files))


def q_archive_as_of(spark, sf_dir):
    """Two months archived at three times, as they were between the second and the third."""
    o = _orders_cols(spark, sf_dir)
    root = scratch_path(spark, "archives")
    name, path = _table(spark, "as_of")
    ts.create_table(spark, name, o.schema, partitioning=_month_spec(), path=path)
    month = F.date_trunc("month", "o_orderdate").cast("date")
    for k, (when, months) in enumerate([(dt.datetime(2024, 1, 31), (REPLACED_MONTH, dt.date(1995, 5, 1))),
                                        (dt.datetime(2024, 2, 29), (REPLACED_MONTH,)),
                                        (dt.datetime(2024, 3, 31), (REPLACED_MONTH, dt.date(1995, 5, 1)))], 1):
        for m in months:
            rows = o.where(month == F.lit(m)).withColumn("o_totalprice", F.col("o_totalprice") * k)
            ts.replace_partition(rows, name, m, archive=True, archive_root=root, now=when)
    return ts.read_archive_as_of(spark, root, name, dt.datetime(2024, 3, 15))


# ------------------------------------------------------------- registry

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "encode_flat": q_encode_flat,
    "encode_array": q_encode_array,
    "encode_struct": q_encode_struct,
    "encode_array_struct": q_encode_array_struct,
    "encode_map": q_encode_map,
    "encode_selected": q_encode_selected,
    "column_order_kept": q_column_order_kept,
    "restore_flat": q_restore_flat,
    "restore_struct": q_restore_struct,
    "restore_array": q_restore_array,
    "restore_array_struct": q_restore_array_struct,
    "restore_map": q_restore_map,
    "restore_selected": q_restore_selected,
    "restore_lenient": q_restore_lenient,
    "conform_types": q_conform_types,
    "read_raw": q_read_raw,
    "read_restored": q_read_restored,
    "preview_rows": q_preview_rows,
    "write_append": q_write_append,
    "write_overwrite": q_write_overwrite,
    "write_ignore": q_write_ignore,
    "write_options": q_write_options,
    "replace_partition": q_replace_partition,
    "archive_copy": q_archive_copy,
    "clustered_write": q_clustered_write,
    "range_partition_counts": q_range_partition_counts,
    "month_partition_counts": q_month_partition_counts,
    "hour_partition_counts": q_hour_partition_counts,
    "partition_expiry": q_partition_expiry,
    "filtered_partition_read": q_filtered_partition_read,
    "filtered_range_read": q_filtered_range_read,
    "day_partition_counts": q_day_partition_counts,
    "year_partition_counts": q_year_partition_counts,
    "replace_range_partition": q_replace_range_partition,
    "partition_append": q_partition_append,
    "clustered_partitioned_write": q_clustered_partitioned_write,
    "create_if_absent": q_create_if_absent,
    "table_properties": q_table_properties,
    "schema_update": q_schema_update,
    "column_override": q_column_override,
    "view_query": q_view_query,
    "view_replaced": q_view_replaced,
    "matview_refresh": q_matview_refresh,
    "snapshot_frozen": q_snapshot_frozen,
    "table_expiry": q_table_expiry,
    "create_with_derived_objects": q_create_with_derived_objects,
    "write_external_definition": q_write_external_definition,
    "external_csv": q_external_csv,
    "external_json": q_external_json,
    "external_bad_records": q_external_bad_records,
    "external_unknown_values": q_external_unknown_values,
    "external_gzip_hive": q_external_gzip_hive,
    "external_decimal_target": q_external_decimal_target,
    "timestamp_partition_read": q_timestamp_partition_read,
    "big_range_read": q_big_range_read,
    "null_partition_replaced": q_null_partition_replaced,
    "expiry_then_append": q_expiry_then_append,
    "external_csv_count": q_external_csv_count,
    "external_unknown_csv": q_external_unknown_csv,
    "external_hive_by_name": q_external_hive_by_name,
    "external_two_folders": q_external_two_folders,
    "rewrite_keeps_settings": q_rewrite_keeps_settings,
    "comments_after_write": q_comments_after_write,
    "snapshot_partitioned": q_snapshot_partitioned,
    "overwrite_from_itself": q_overwrite_from_itself,
    "clustered_files": q_clustered_files,
    "matview_incremental": q_matview_incremental,
    "snapshot_shared": q_snapshot_shared,
    "two_writers": q_two_writers,
    "unfinished_overwrite": q_unfinished_overwrite,
    "write_codec": q_write_codec,
    "column_override_kinds": q_column_override_kinds,
    "write_error_if_exists": q_write_error_if_exists,
    "external_gzip_unnamed": q_external_gzip_unnamed,
    "external_autodetect": q_external_autodetect,
    "external_autodetect_json": q_external_autodetect_json,
    "recluster": q_recluster,
    "pruned_join": q_pruned_join,
    "file_skipping": q_file_skipping,
    "curve_files": q_curve_files,
    "archive_as_of": q_archive_as_of,
}


try:  # the training-data operators are a separate subpackage; the rest works without it
    from tessera.llm import entries as _llm
except ImportError:
    _llm = None
try:
    import corpus_pipeline as _pipeline
except ImportError:
    _pipeline = None


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = _llm.queries() if _llm else {}
    if _llm and _pipeline:
        extra["pipeline"] = _pipeline.run
    return table_queries() | extra


# ---------------------------------------------------------------- oracles

def _dec(x: str) -> str:
    # over varchar: a direct double → decimal cast in DuckDB keeps binary noise
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def _dtext(x: str) -> str:
    return f"CAST({_dec(x)} AS VARCHAR)"


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
_DUCK_MONEY = "CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2))) AS VARCHAR)"


def oracle_sql() -> dict[str, str]:
    extra = _llm.oracle_sql() if _llm else {}
    if _llm and _pipeline and _pipeline.ORACLE_SQL:
        extra["pipeline"] = _pipeline.ORACLE_SQL
    return table_oracle_sql() | extra


def table_oracle_sql() -> dict[str, str]:
    return {
        "encode_flat": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   'string' AS price_type FROM lineitem""",
        "encode_array": f"""
            SELECT l_orderkey, l_linenumber,
                   {_dtext('l_extendedprice')} || '|' || {_dtext('l_tax')} AS amounts
            FROM lineitem""",
        "encode_struct": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_tax')} AS tax, l_shipdate AS ship,
                   'string' AS tax_type FROM lineitem""",
        "encode_array_struct": f"""
            SELECT l_orderkey, l_linenumber, 0 AS pos, 'price' AS kind,
                   {_dtext('l_extendedprice')} AS amount FROM lineitem
            UNION ALL
            SELECT l_orderkey, l_linenumber, 1 AS pos, 'tax' AS kind,
                   {_dtext('l_tax')} AS amount FROM lineitem""",
        "encode_map": f"""
            SELECT c_custkey, c_mktsegment AS "Key", {_dtext('c_acctbal')} AS "value"
            FROM customer""",
        "encode_selected": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   {_dtext('l_tax')} AS tax, 'string' AS price_type,
                   'decimal(38,18)' AS tax_type FROM lineitem""",
        "column_order_kept": f"""
            SELECT l_orderkey, {_dtext('l_extendedprice')} AS "unit price", l_linenumber,
                   l_returnflag FROM lineitem""",
        "restore_flat": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   {_dtext('l_tax')} AS tax, 'decimal(38,18)' AS price_type FROM lineitem""",
        "restore_struct": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_tax')} AS tax, l_shipdate AS ship,
                   'decimal(38,18)' AS tax_type FROM lineitem""",
        "restore_array": f"""
            SELECT l_orderkey, l_linenumber, 0 AS pos, {_dtext('l_extendedprice')} AS amount,
                   'decimal(38,18)' AS amount_type FROM lineitem
            UNION ALL
            SELECT l_orderkey, l_linenumber, 1 AS pos, {_dtext('l_tax')} AS amount,
                   'decimal(38,18)' AS amount_type FROM lineitem""",
        "restore_array_struct": f"""
            SELECT l_orderkey, l_linenumber, 0 AS pos, 'price' AS kind,
                   {_dtext('l_extendedprice')} AS amount, 'decimal(38,18)' AS amount_type
            FROM lineitem
            UNION ALL
            SELECT l_orderkey, l_linenumber, 1 AS pos, 'tax' AS kind,
                   {_dtext('l_tax')} AS amount, 'decimal(38,18)' AS amount_type FROM lineitem""",
        "restore_map": f"""
            SELECT c_custkey, c_mktsegment AS segment, {_dtext('c_acctbal')} AS balance,
                   'decimal(38,18)' AS balance_type FROM customer""",
        "restore_selected": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   {_dtext('l_tax')} AS tax, 'decimal(38,18)' AS price_type,
                   'string' AS tax_type FROM lineitem""",
        "restore_lenient": f"""
            SELECT l_orderkey, l_linenumber,
                   CAST(TRY_CAST(CASE WHEN l_linenumber = 2 THEN {_dtext('l_extendedprice')} || 'x'
                                      WHEN l_linenumber = 4 THEN ''
                                      ELSE {_dtext('l_extendedprice')} END
                                 AS DECIMAL(38,18)) AS VARCHAR) AS price
            FROM lineitem""",
        "conform_types": f"""
            SELECT o_orderkey, o_custkey AS cust_int,
                   CAST(CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(20,2))
                        AS DECIMAL(38,9)) AS VARCHAR) AS total_n,
                   {_dtext('o_totalprice')} AS total_w, o_orderstatus AS status, o_orderdate,
                   'bigint' AS cust_int_type, 'decimal(38,9)' AS total_n_type,
                   'string' AS total_w_type
            FROM orders""",
        "read_raw": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   {_dtext('l_tax')} AS tax, 'string' AS price_type FROM lineitem""",
        "read_restored": f"""
            SELECT l_returnflag, CAST(sum({_dec('l_extendedprice')}) AS VARCHAR) AS sum_price,
                   CAST(sum({_dec('l_tax')}) AS VARCHAR) AS sum_tax, count(*) AS n_lines
            FROM lineitem GROUP BY l_returnflag""",
        "preview_rows": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price
            FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice LIMIT 20""",
        "write_append": f"""
            SELECT {_ORDERS} FROM orders UNION ALL SELECT {_ORDERS} FROM orders""",
        "write_overwrite": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
                   o_orderdate FROM orders""",
        "write_ignore": f"SELECT {_ORDERS}, 'ignored' AS status FROM orders",
        "write_options": f"SELECT {_ORDERS} FROM orders",
        "replace_partition": f"""
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN {_MONTH} = DATE '{REPLACED_MONTH}' THEN o_totalprice * 2
                        ELSE o_totalprice END AS o_totalprice, o_orderdate
            FROM orders""",
        "archive_copy": f"""
            SELECT l_orderkey, l_linenumber, {_dtext('l_extendedprice')} AS price,
                   {_dtext('l_tax')} AS tax,
                   '{ARCHIVE_CLOCK.year}/{ARCHIVE_CLOCK:%Y%m%d_%H%M%S}' AS year_stamp
            FROM lineitem""",
        "clustered_write": """
            SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM lineitem""",
        "range_partition_counts": f"""
            SELECT CASE WHEN o_custkey >= {RANGE.start} AND o_custkey < {RANGE.end}
                        THEN {RANGE.start} + ((o_custkey - {RANGE.start}) // {RANGE.interval})
                             * {RANGE.interval} END AS bucket,
                   count(*) AS n_orders
            FROM orders GROUP BY 1""",
        "month_partition_counts": f"""
            SELECT {_MONTH} AS month, count(*) AS n_orders, {_DUCK_MONEY} AS total
            FROM orders GROUP BY 1""",
        "hour_partition_counts": """
            SELECT date_trunc('hour', ts) AS hour, count(*) AS n_events FROM events GROUP BY 1""",
        "partition_expiry": f"""
            SELECT {_ORDERS} FROM orders
            WHERE {_MONTH} + INTERVAL 365 DAY > TIMESTAMP '{EXPIRY_AS_OF}'""",
        "filtered_partition_read": f"""
            SELECT {_ORDERS} FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '{FILTER_LO}' AND TIMESTAMP '{FILTER_HI}'""",
        "filtered_range_read": f"""
            SELECT {_ORDERS} FROM orders WHERE o_custkey BETWEEN {RANGE_LO} AND {RANGE_HI}""",
        "day_partition_counts": """
            SELECT CAST(ts AS DATE) AS day, count(*) AS n_events,
                   count(DISTINCT user_id) AS n_users FROM events GROUP BY 1""",
        "year_partition_counts": f"""
            SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS year, count(*) AS n_lines,
                   CAST(sum({_dec('l_extendedprice')}) AS VARCHAR) AS sum_price
            FROM lineitem GROUP BY 1""",
        "replace_range_partition": f"""
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN o_custkey >= {REPLACED_BUCKET}
                             AND o_custkey < {REPLACED_BUCKET + RANGE.interval}
                        THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
                   o_orderdate
            FROM orders""",
        "partition_append": f"""
            SELECT {_ORDERS} FROM orders
            UNION ALL
            SELECT {_ORDERS} FROM orders WHERE {_MONTH} = DATE '{REPLACED_MONTH}'""",
        "clustered_partitioned_write": f"SELECT {_ORDERS} FROM orders",
        "create_if_absent": f"SELECT {_ORDERS}, 'True/False' AS created FROM orders",
        "table_properties": """
            SELECT o_orderkey, 'Orders' AS friendly_name, 'sales' AS label_team,
                   'EU' AS region FROM orders""",
        "schema_update": f"""
            SELECT {_ORDERS}, NULL::VARCHAR AS o_note FROM orders
            UNION ALL
            SELECT {_ORDERS}, 'n' || CAST(o_orderkey AS VARCHAR) AS o_note FROM orders""",
        "column_override": """
            SELECT o_orderkey,
                   CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(20,4)) AS VARCHAR)
                       AS o_totalprice,
                   'decimal(20,4)' AS price_type FROM orders""",
        "view_query": f"""
            SELECT o_orderstatus, count(*) AS n_orders, {_DUCK_MONEY} AS total
            FROM orders GROUP BY o_orderstatus""",
        "view_replaced": """
            SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n_orders FROM orders
            GROUP BY year(o_orderdate)""",
        "matview_refresh": """
            SELECT o_orderstatus, 2 * count(*) AS n_orders,
                   CAST(2 * sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2))) AS VARCHAR)
                       AS total
            FROM orders GROUP BY o_orderstatus""",
        "snapshot_frozen": f"SELECT {_ORDERS} FROM orders",
        "table_expiry": f"SELECT {_ORDERS}, 1 AS tables_left FROM orders WHERE o_orderstatus <> 'F'",
        "create_with_derived_objects": f"""
            SELECT o_orderstatus, count(*) AS n_orders, {_DUCK_MONEY} AS total,
                   count(*) AS n_view, 0 AS n_snapshot
            FROM orders GROUP BY o_orderstatus""",
        "write_external_definition": f"""
            SELECT {_ORDERS}, 'skipped_external' AS write_status FROM orders""",
        "external_csv": f"SELECT {_ORDERS}, 'skipped_external' AS write_status FROM orders",
        "external_json": f"SELECT {_ORDERS}, 'skipped_external' AS write_status FROM orders",
        "external_bad_records": f"SELECT {_ORDERS} FROM orders",
        "external_unknown_values": f"SELECT {_ORDERS} FROM orders",
        "external_gzip_hive": f"SELECT {_ORDERS} FROM orders",
        "external_decimal_target": """
            SELECT o_orderkey,
                   CAST(CAST(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(20,2))
                        AS DECIMAL(38,9)) AS VARCHAR) AS o_totalprice,
                   'decimal(38,9)' AS price_type FROM orders""",
        "timestamp_partition_read": """
            SELECT event_id, user_id, date_trunc('hour', ts) AS hour FROM events
            WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-09 18:30:00'""",
        "big_range_read": """
            SELECT o_orderkey + 9007199254740992 AS k, o_custkey,
                   9007199254740992 + (o_orderkey // 97) * 97 AS bucket
            FROM orders WHERE o_orderkey BETWEEN 11 AND 4001""",
        "null_partition_replaced": """
            SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_orderstatus,
                   CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders""",
        "expiry_then_append": """
            SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
            WHERE date_trunc('month', o_orderdate) + INTERVAL 1 DAY > TIMESTAMP '1996-01-15 00:00:00'
            UNION ALL SELECT -o_orderkey, CAST(o_orderdate AS DATE) FROM orders
            WHERE CAST(o_orderdate AS DATE) < DATE '1992-03-01'""",
        "external_csv_count": "SELECT count(*) AS n, count(*) AS n_by_name FROM orders",
        "external_unknown_csv": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders",
        "external_hive_by_name": "SELECT o_orderkey, o_orderstatus FROM orders",
        "external_two_folders": f"SELECT {_ORDERS} FROM orders",
        "rewrite_keeps_settings": """
            SELECT o_orderkey, 'second' AS description, 'sales' AS team, 'o_custkey' AS clustering,
                   'buyer' AS buyer_comment FROM orders""",
        "comments_after_write": """
            SELECT l_orderkey, l_linenumber, 'BigDecimalType|net' AS price_tag, 'BigDecimalType' AS tax_tag,
                   'key|of order' AS merged, 'BigDecimalType|net' AS restored_comment, 'decimal(38,18)' AS price_type
            FROM lineitem""",
        "snapshot_partitioned": f"""
            SELECT {_ORDERS} FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '1995-02-01 00:00:00' AND TIMESTAMP '1995-06-30 00:00:00'""",
        "overwrite_from_itself": f"SELECT {_ORDERS} FROM orders WHERE o_orderstatus = 'O'",
        "clustered_files": "SELECT count(*) AS n_rows, 0 AS n_overlaps FROM orders",
        "matview_incremental": f"""
            WITH now AS (
                SELECT o_orderstatus, o_orderdate, o_totalprice * CASE WHEN {_MONTH} = DATE '{REPLACED_MONTH}' THEN 2 ELSE 1 END AS price
                FROM orders
                UNION ALL SELECT o_orderstatus, o_orderdate, o_totalprice FROM orders WHERE {_MONTH} = DATE '1995-05-01')
            SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n_orders,
                   CAST(sum(CAST(CAST(price AS VARCHAR) AS DECIMAL(18,2))) AS VARCHAR) AS total,
                   min(price) AS lowest, max(price) AS highest, 2 AS n_read,
                   (SELECT count(DISTINCT {_MONTH}) - 2 FROM orders) AS n_left
            FROM now GROUP BY ALL""",
        "snapshot_shared": f"SELECT {_ORDERS}, TRUE AS shared FROM orders",
        "two_writers": f"SELECT {_ORDERS}, 'refused' AS late_writer FROM orders WHERE o_orderstatus <> 'F'",
        "unfinished_overwrite": f"""
            SELECT {_ORDERS}, (SELECT count(*) FROM orders) AS n_before FROM orders WHERE o_orderstatus = 'O'""",
        "write_codec": f"""
            SELECT codec, count(*) AS n_orders, {_DUCK_MONEY} AS total
            FROM orders, (VALUES ('gzip'), ('zstd')) AS c(codec) GROUP BY codec""",
        "column_override_kinds": """
            SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS status, [o_custkey] AS customers,
                   'string' AS k_type, 'varchar(3)' AS status_type, 'array<bigint>' AS customers_type, TRUE AS null_refused
            FROM orders""",
        "write_error_if_exists": f"SELECT {_ORDERS}, 'refused' AS second_write FROM orders",
        "external_gzip_unnamed": f"SELECT {_ORDERS} FROM orders",
        "external_autodetect": """
            WITH cells AS (
                SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,12)) AS price,
                       CAST(o_orderdate AS DATE) AS day FROM orders
                UNION ALL SELECT repeat('9', 20), CAST('0.' || repeat('1', 12) AS DECIMAL(38,12)), DATE '2024-02-29')
            SELECT k, CAST(price AS VARCHAR) AS price, day, 'decimal(20,0)' AS k_type,
                   'decimal(' || (SELECT max(length(CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR))) + 12 FROM orders)
                       || ',12)' AS price_type, 'date' AS day_type
            FROM cells""",
        "recluster": f"""
            SELECT {_ORDERS}, 2 AS n_rewritten, (SELECT count(DISTINCT {_MONTH}) - 2 FROM orders) AS n_kept, 1 AS depth
            FROM (SELECT * FROM orders
                  UNION ALL SELECT * FROM orders WHERE {_MONTH} IN (DATE '{REPLACED_MONTH}', DATE '1995-05-01'))""",
        "pruned_join": f"""
            SELECT {_ORDERS}, TRUE AS pruned FROM orders WHERE o_orderdate IN (
                SELECT min(o_orderdate) FROM orders GROUP BY o_custkey HAVING o_custkey % 50 = 1)""",
        "file_skipping": f"""
            SELECT {_ORDERS}, TRUE AS files_enough FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)""",
        "curve_files": f"""
            SELECT {_ORDERS}, TRUE AS under_half FROM orders
            WHERE o_orderdate BETWEEN TIMESTAMP '{CURVE_LO}' AND TIMESTAMP '{CURVE_HI}'""",
        "archive_as_of": f"""
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   o_totalprice * CASE WHEN {_MONTH} = DATE '{REPLACED_MONTH}' THEN 2 ELSE 1 END AS o_totalprice, o_orderdate
            FROM orders WHERE {_MONTH} IN (DATE '{REPLACED_MONTH}', DATE '1995-05-01')""",
        "external_autodetect_json": """
            SELECT o_custkey, CAST(max(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) AS latest, 'date' AS latest_type,
                   o_orderkey AS k, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day, 'date' AS day_type,
                   'decimal' AS price_kind FROM orders""",
    }
