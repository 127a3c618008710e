"""Clustered order restored where appends have disturbed it.

A clustered write leaves files with disjoint ranges of the first cluster
column; appends add files that overlap them. The depth of a partition is the
greatest number of its files whose ranges share a value between their ends: one
where every file stands alone. Only partitions deeper than wanted are read and
written again, all in one commit (`versions`); the files of all others stay as
they are. A table without partitions is one partition.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import delete_folder, quote_ident
from . import versions
from .partitioning import PartitionSpec
from .tables import (NULL_PARTITION, clustering_of, overwrite_all, partition_clause, partition_spec_of,
                     partition_texts, table_properties)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Reclustered:
    """Partitions written again (empty text: the whole table), and how many were left alone."""

    rewritten: Sequence[str]
    untouched: int


def file_ranges(spark: SparkSession, table: str, column: str) -> DataFrame:
    """``partition, file, lo, hi, n``: the range of a column in each file, by a scan of that column alone."""
    spec = partition_spec_of(spark, table)
    part = F.lit("") if spec is None else F.coalesce(F.col(quote_ident(spec.partition_column)).cast("string"),
                                                     F.lit(NULL_PARTITION))
    at = F.col(quote_ident(column))
    return spark.table(table).groupBy(part.alias("partition"), F.col("_metadata.file_name").alias("file")).agg(
        F.min(at).alias("lo"), F.max(at).alias("hi"), F.count("*").alias("n"))


def cluster_depth(spark: SparkSession, table: str, column: str | None = None) -> DataFrame:
    """``partition, files, depth``: how many files overlap at most, of those with any value.

    Ranges that only share an end do not overlap. One row a file is sorted within
    its partition; rows of the table are not.
    """
    column = column or _leading(spark, table)
    ranges = file_ranges(spark, table, column).where("lo is not null and lo < hi")
    ends = ranges.select("partition", F.explode(F.array(
        F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")),
        F.struct(F.col("hi").alias("at"), F.lit(-1).alias("step")))).alias("e")).select("partition", "e.*")
    # at one value, files end before others begin
    sofar = F.sum("step").over(W.partitionBy("partition").orderBy("at", "step").rowsBetween(W.unboundedPreceding, 0))
    deepest = ends.withColumn("depth", sofar).groupBy("partition").agg(F.max("depth").alias("depth"))
    files = file_ranges(spark, table, column).groupBy("partition").agg(F.count("*").alias("files"))
    return files.join(deepest, "partition", "left").withColumn("depth", F.greatest(F.lit(1), F.coalesce("depth", F.lit(1))).cast("int"))


def _leading(spark: SparkSession, table: str) -> str:
    columns = clustering_of(table_properties(spark, table))
    if not columns:
        raise ValueError(f"table {table} is not clustered")
    return columns[0]


def recluster(spark: SparkSession, table: str, max_depth: int = 1, num_partitions: int | None = None) -> Reclustered:
    """Write the partitions whose depth is over ``max_depth`` again, clustered; what was done.

    ``num_partitions``: tasks of the rewrite (by default as for a clustered
    write). Rows appended meanwhile are not lost: the commit fails with
    ``ConcurrentWrite`` and the table stays as it was.
    """
    from ..sinks.table import clustered
    columns = clustering_of(table_properties(spark, table))
    _leading(spark, table)
    base = versions.begin(spark, table)
    depths = cluster_depth(spark, table).select("partition", "depth").collect()  # one row a partition
    deep = {r["partition"] for r in depths if r["depth"] > max_depth}
    spec = partition_spec_of(spark, table)
    if not deep:
        return Reclustered([], len(depths))
    if spec is None:
        rows = clustered(spark.table(table), columns, num_partitions)
        overwrite_all(spark, table, lambda staging: rows.write.insertInto(staging))
        return Reclustered([""], 0)
    chosen = [p for p in partition_texts(spark, table) if unquote(p.split("=", 1)[1]) in deep]
    rows = clustered(_in_partitions(spark.table(table), spec, chosen), [spec.partition_column, *columns], num_partitions)
    _replace(spark, table, base, rows, chosen)
    return Reclustered(sorted(chosen), len(depths) - len(chosen))


def _in_partitions(df: DataFrame, spec: PartitionSpec, folders: Sequence[str]) -> DataFrame:
    held = quote_ident(spec.partition_column)
    values = [partition_clause(spec, p).split(" = ", 1)[1] for p in folders if unquote(p.split("=", 1)[1]) != NULL_PARTITION]
    tests = [f"{held} IN ({', '.join(values)})"] if values else []
    if len(values) < len(folders):
        tests.append(f"{held} IS NULL")
    return df.where(" OR ".join(tests))


def _replace(spark: SparkSession, table: str, base: versions.Base, rows: DataFrame, folders: Sequence[str]) -> None:
    from .tables import _staged
    staging, made = _staged(spark, table, base, lambda tmp: rows.write.insertInto(tmp))
    try:
        versions.commit(spark, base, "partitions",
                        changes={p: f"{staging}/{p}" if p in made else None for p in {*folders, *made}})
    except versions.ConcurrentWrite:
        delete_folder(spark, staging)
        raise
