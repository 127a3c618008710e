"""Summaries of a table's files, so that a read on columns without partitions opens few of them.

For each file and chosen column two things are kept beside the table: the least
and greatest value, and a Bloom filter. Both are made by a scan of the chosen
columns of files that have none yet (`summarise`), never by the driver:

    <home>__summaries/<id>/ranges    file, nulls, and lo/hi of each column
    <home>__summaries/<id>/bits      file, column, word, bits: the words of the filters, sorted by word

A look-up of one value reads two words of every file's filter, which lie together,
and not the filters. A read turns the files that may hold the value into a
predicate on the file's name, which Spark applies when it lists the table. The
predicate only spares work: rows are still compared, files beyond ``NAMES``
are read without it, and summaries count only for the very version of the table
that they were brought up to.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, file_names, quote_ident, quote_table
from . import versions
from .partitioning import typed_literal
from .tables import ddl_properties, table_properties
from .versions import PROP_SUMMARISED

log = logging.getLogger(__name__)

PROP_SUMMARIES = "tessera.summaries"
#: Bits of a file's filter of one column (as a power of two), and hashes of a value.
FILTER_BITS = 17
HASHES = 2
#: Names a read passes to Spark at most.
NAMES = 10_000


def _folder(home: str) -> str:
    return f"{home}__summaries"


def _position(c: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), c), F.lit(1 << FILTER_BITS))


def _parts(spark: SparkSession, home: str, what: str) -> list[str]:
    """Finished parts: the ``ranges`` are written last."""
    folder = _folder(home)
    return [f"{folder}/{p}/{what}" for p in file_names(spark, folder) if "ranges" in file_names(spark, f"{folder}/{p}")]


def summarise(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> int:
    """Bring the summaries of ``table`` up to its version; the number of files summarised anew.

    ``columns`` (given the first time, or to change them) are kept on the table.
    Stale entries of files that are gone do no harm; with other columns, or once
    no old file is left, the summaries begin anew.
    """
    base = versions.begin(spark, table)
    props = table_properties(spark, table)
    had = json.loads(props.get(PROP_SUMMARIES, "[]"))
    wanted = list(columns) if columns is not None else had
    if not wanted:
        raise ValueError(f"{table} has no columns to summarise")
    schema = spark.table(table).schema
    for c in wanted:
        if not isinstance(schema[c].dataType, T.AtomicType):
            raise TypeError(f"column {c!r}: {schema[c].dataType.simpleString()} values have no order")
    old = _parts(spark, base.home, "ranges") if wanted == had else []
    file = F.col("_metadata.file_name")
    rows = spark.table(table)
    if old:
        known = spark.read.parquet(*old)
        last = known.agg(F.max("modified")).first()[0]
        if last is not None:
            # the time is a bound that Spark applies to the list of files
            rows = (rows.where(F.col("_metadata.file_modification_time") >= F.lit(last)).withColumn("__file", file)
                    .withColumn("__modified", F.col("_metadata.file_modification_time"))
                    .join(known.select(F.col("file").alias("__file")), "__file", "left_anti"))
    if "__file" not in rows.columns:
        rows = rows.withColumn("__file", file).withColumn("__modified", F.col("_metadata.file_modification_time"))
    part = f"{_folder(base.home)}/{uuid.uuid4().hex}"
    at = lambda c: F.col(quote_ident(c))
    bits = None
    for i, c in enumerate(wanted):
        hashed = rows.where(at(c).isNotNull()).select(F.col("__file").alias("file"), F.explode(F.array(*[
            _position(at(c), k) for k in range(HASHES)])).alias("p"))
        one = hashed.groupBy("file", F.lit(i).alias("column"), F.shiftright("p", 6).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
        bits = one if bits is None else bits.unionByName(one)
    bits.repartitionByRange("column", "word").sortWithinPartitions("column", "word").write.parquet(f"{part}/bits")
    ranges = rows.groupBy(F.col("__file").alias("file")).agg(
        F.max("__modified").alias("modified"), F.count("*").alias("n"),
        *[f(at(c)).alias(f"{k}_{i}") for i, c in enumerate(wanted) for k, f in (("lo", F.min), ("hi", F.max))])
    ranges.write.parquet(f"{part}/ranges")
    if columns is not None and wanted != had:
        for p in file_names(spark, _folder(base.home)):
            if not part.endswith(p):
                delete_folder(spark, f"{_folder(base.home)}/{p}")
    spark.sql(f"ALTER TABLE {quote_table(table)} SET TBLPROPERTIES ("
              f"{ddl_properties({PROP_SUMMARIES: json.dumps(wanted), PROP_SUMMARISED: str(base.version)})})")
    return spark.read.parquet(f"{part}/ranges").count()


def candidate_files(spark: SparkSession, table: str, points: Mapping | None = None,
                    ranges: Mapping[str, tuple] | None = None) -> DataFrame | None:
    """Names of the files that may hold rows with the given values (``points``) and within the ``ranges``.

    None when the summaries do not cover the table as it is now, or none of the columns.
    """
    props = table_properties(spark, table)
    columns = json.loads(props.get(PROP_SUMMARIES, "[]"))
    if (props.get(PROP_SUMMARISED) != props.get(versions.PROP_VERSION, "0") or versions.unfinished(spark, props)
            or not {*(points or ()), *(ranges or ())} & set(columns)):
        return None
    home = props.get(versions.PROP_HOME) or versions.begin(spark, table).home
    schema = spark.table(table).schema
    test = F.lit(True)
    out = spark.read.parquet(*_parts(spark, home, "ranges"))
    for i, c in enumerate(columns):
        literal = lambda v, c=c: typed_literal(v, schema[c].dataType)
        lo, hi = F.col(f"lo_{i}"), F.col(f"hi_{i}")
        if points and c in points:
            if points[c] is None:
                continue  # nulls are in neither
            v = literal(points[c])
            test &= (lo <= v) & (v <= hi)
        if ranges and c in ranges:
            a, b = ranges[c]
            test &= (hi >= literal(a) if a is not None else F.lit(True)) & (lo <= literal(b) if b is not None else F.lit(True))
    out = out.where(test).select("file")
    bits = spark.read.parquet(*_parts(spark, home, "bits"))
    for i, c in enumerate(columns):
        if points and points.get(c) is not None:
            spots = spark.range(1).select(*[_position(typed_literal(points[c], schema[c].dataType), k).alias(f"p{k}")
                                            for k in range(HASHES)]).first()
            for p in spots:
                out = out.join(bits.where((F.col("column") == i) & (F.col("word") == p >> 6)
                                          & (F.getbit("bits", F.lit(p & 63)) == 1)).select("file"), "file", "left_semi")
    return out.distinct()


def only_files(df: DataFrame, names: DataFrame | None) -> DataFrame:
    """``df`` over those files alone, where there are few enough to say so."""
    if names is None:
        return df
    few = [r["file"] for r in names.limit(NAMES + 1).collect()]
    if len(few) > NAMES:
        log.warning("over %s files may hold the rows; all are read", NAMES)
        return df
    return df.where(F.col("_metadata.file_name").isin(few) if few else F.lit(False))
