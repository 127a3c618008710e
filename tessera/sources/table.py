"""Read catalog tables (or table folders) back, decimals restored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decimals import restore_decimals
from ..operators import versions
from ..operators.partitioning import UNSET, PartitionSpec, RangePartitioning, typed_literal
from ..operators.summaries import candidate_files, only_files
from ..operators.tables import NULL_PARTITION, PROP_EXTERNAL, PROP_REQUIRE_FILTER, partition_texts, table_properties
from ..session import quote_ident


class PartitionFilterRequired(ValueError):
    """The table demands a partition predicate and none was given."""


def read_table(spark: SparkSession, table: str | None = None, *,
               path: str | None = None, format: str = "parquet",
               restore: bool = True,
               columns: Sequence[str | int] | None = None,
               lenient: bool = False,
               target: T.DataType | str | Mapping[str, T.DataType | str] | None = None,
               where: str | Column | None = None,
               between: tuple | None = None,
               partition_value=UNSET,
               points: Mapping | None = None,
               ranges: Mapping[str, tuple] | None = None,
               keep_partition_column: bool = False) -> DataFrame:
    """Load a table lazily and restore its tagged decimals.

    ``between=(lo, hi)`` filters the partition source column and adds the
    matching predicate on the derived partition column, so only the folders
    in range are listed and read. ``partition_value`` reads one partition
    (None: the partition of rows that have none).
    ``points`` (column to value) and ``ranges`` (column to lowest and highest
    value, None for open) filter other columns; files whose summaries
    (``summarise``) rule the values out are not listed.
    ``where`` is any further filter, applied after restoring (a predicate on a
    tagged column compares decimals); Catalyst still pushes predicates on the
    other columns into the scan. A
    table flagged ``require_partition_filter`` refuses a read without
    ``between`` or ``partition_value``.
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    if table is not None:
        props = table_properties(spark, table)
        if versions.unfinished(spark, props):
            versions.recover(spark, table)
        if props.get(PROP_EXTERNAL) == "true":
            from .external import read_external_table
            df = read_external_table(spark, table)
        else:
            df = spark.table(table)
    else:
        df = spark.read.format(format).load(path)
        props = {}
    spec = PartitionSpec.from_properties(props)
    if props.get(PROP_REQUIRE_FILTER) == "true" and between is None and partition_value is UNSET:
        raise PartitionFilterRequired(
            f"table {table} requires a partition filter (between= or partition_value=)")
    if points or ranges:
        if table is not None:
            df = only_files(df, candidate_files(spark, table, points, ranges))
        df = df.where(_wanted(df, points or {}, ranges or {}))
    if between is not None:
        if spec is None:
            raise ValueError("between= needs a partitioned table")
        lo, hi = between
        src = df[quote_ident(spec.column)]
        src_type = df.schema[spec.column].dataType
        df = df.where(spec.between_predicate(lo, hi)
                      & spec.source_between(src, src_type, lo, hi))
    if partition_value is not UNSET:
        if spec is None:
            raise ValueError("partition_value needs a partitioned table")
        value = spec.values(partition_value)
        held = F.col(quote_ident(spec.partition_column))
        df = df.where(held.isNull() if value is None else held == spec.value_literal(value))
    if restore:
        df = restore_decimals(df, columns, lenient=lenient, target=target)
    if where is not None:
        # after restoring, so a predicate on a tagged column compares decimals;
        # predicates on other columns still reach the scan through the projection
        df = df.where(where)
    if spec is not None and not keep_partition_column:
        df = df.drop(spec.partition_column)
    return df


def _wanted(df: DataFrame, points: Mapping, ranges: Mapping[str, tuple]) -> Column:
    test = F.lit(True)
    for c, v in points.items():
        at = df[quote_ident(c)]
        test &= at.isNull() if v is None else at == typed_literal(v, df.schema[c].dataType)
    for c, (lo, hi) in ranges.items():
        at = df[quote_ident(c)]
        for v, holds in ((lo, at.__ge__), (hi, at.__le__)):
            if v is not None:
                test &= holds(typed_literal(v, df.schema[c].dataType))
    return test


def read_matching(spark: SparkSession, table: str, keys: DataFrame, on: Mapping[str, str], *,
                  how: str = "semi", listed: bool | None = None) -> DataFrame:
    """Rows of a partitioned table that match ``keys``, reading only the partitions the keys fall into.

    ``on`` names a column of ``keys`` for each table column compared; one of
    them must be the table's partition source column. The partition of each key is
    derived from it as it is when rows are written, and joined with the partition
    column, so Spark prunes the folders at run time by the keys it broadcasts.
    Keys that Spark takes to be too large to broadcast are asked for their
    partitions first instead (one value a partition of the table at most);
    ``listed`` settles which. ``how``: ``semi`` (table rows, once each) or ``inner`` (with the
    keys' other columns).
    """
    if how not in ("semi", "inner"):
        raise ValueError(f"how={how!r} is not semi or inner")
    props = table_properties(spark, table)
    if versions.unfinished(spark, props):
        versions.recover(spark, table)
    spec = PartitionSpec.from_properties(props)
    if spec is None or spec.column not in on.values():
        raise ValueError(f"on= must compare the partition column of {table}")
    rows = spark.table(table)
    clash = set(rows.columns) & set(keys.columns)
    key = {c: f"__key_{i}" if c in clash else c for i, c in enumerate(keys.columns)}
    keys = keys.select(*[F.col(quote_ident(c)).alias(k) for c, k in key.items()])
    mine = next(k for k, c in on.items() if c == spec.column)
    derived = spec.derive(F.col(quote_ident(key[mine])), keys.schema[key[mine]].dataType)
    held = quote_ident(spec.partition_column)
    same = [rows[quote_ident(c)] == F.col(quote_ident(key[k])) for k, c in on.items()]
    extra = [k for c, k in key.items() if c not in on] if how == "inner" else []
    if set(extra) & set(key[c] for c in clash):
        raise ValueError(f"columns {sorted(clash - set(on))} are in both; rename them")
    join = "left_semi" if how == "semi" else "inner"
    columns = [rows[quote_ident(c)] for c in rows.columns if c != spec.partition_column]

    texts = partition_texts(spark, table)
    if listed is None:
        size = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        listed = size > int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    values = [versions.partition_value(p) for p in texts if versions.partition_value(p) != NULL_PARTITION]
    literal = [F.lit(v).cast(spec.partition_type) for v in values]
    parted, outs = keys.withColumn("__part", derived), []
    if values:
        if listed:
            wanted = [r[0] for r in parted.select("__part").where(F.col("__part").isin(literal)).distinct().collect()]
            own = rows.where(F.col(held).isin([spec.value_literal(v) for v in wanted]) if wanted else F.lit(False))
        else:
            own = rows
        # keys beyond the table's partitions match nothing
        near = parted.where(F.col("__part").between(F.least(*literal) if len(literal) > 1 else literal[0],
                                                    F.greatest(*literal) if len(literal) > 1 else literal[0]))
        outs.append(own.join(near, [rows[held] == F.col("__part"), *same], join).select(*columns, *map(quote_ident, extra)))
    if isinstance(spec.metadata, RangePartitioning) and len(values) < len(texts):
        # keys outside the integer range are in the null partition and may still match
        outs.append(rows.where(F.col(held).isNull()).join(parted.where("__part is null"), same, join)
                    .select(*columns, *map(quote_ident, extra)))
    if not outs:
        return rows.join(parted, same, join).select(*columns, *map(quote_ident, extra)).limit(0)
    return restore_decimals(outs[0] if len(outs) == 1 else outs[0].unionByName(outs[1]))


def read_raw(spark: SparkSession, table: str, **kwargs) -> DataFrame:
    """``read_table`` without restoring (tagged columns stay text)."""
    return read_table(spark, table, restore=False, **kwargs)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows (by ``order_by`` when given) for a look at a table."""
    if order_by:
        df = df.orderBy(*[F.col(quote_ident(c)) for c in order_by])
    return df.limit(n)
