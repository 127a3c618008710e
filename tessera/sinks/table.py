"""Write DataFrames into catalog tables: save modes, one-partition replace,
dated ORC archive copies, clustered layout.

Every write goes through Spark's commit protocol (task retries and lost
executors are handled by the protocol; nothing is staged on a machine-local
disk). Only DDL and small results reach the driver.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conform import conform_types
from ..functions.decimals import comment_of, encode_wide_decimals, has_tag, tag_comment
from ..operators.partitioning import UNSET, PartitionSpec
from ..operators.tables import (NULL_PARTITION, PROP_EXTERNAL, PROP_OPTIONS, clustering_of, create_table,
                                data_schema, ddl_properties, overwrite_all, overwrite_partition,
                                partition_spec_of, required_columns, table_exists, table_layout, table_properties,
                                update_table_schema)
from ..operators import versions
from ..operators.summaries import PROP_SUMMARIES, summarise
from ..session import first_file, quote_ident, quote_table, sql_string, write_text

log = logging.getLogger(__name__)

SAVE_MODES = ("append", "overwrite", "ignore", "errorifexists")
ARCHIVE_ROOT_CONF = "spark.tessera.archiveRoot"
DEFAULT_ZONE = "Europe/Paris"
#: Plan size estimate per range partition of a clustered write, where no count is given.
CLUSTER_BYTES = 512 << 20
#: Settings of ``create_table`` that a write into an existing table brings up to date.
SETTINGS = ("description", "friendly_name", "labels", "location", "expiration_time", "require_partition_filter",
            "column_overrides", "properties")
#: Those that only make sense when the table is created.
AT_CREATION = ("materialized_view", "view", "snapshot")
SCHEMA_SUFFIX = "_schema"


@dataclass
class WriteResult:
    status: str                       # written | ignored | skipped_external
    table: str
    archive_path: str | None = None
    created: bool = False


# ------------------------------------------------------------------ archive

def archive_path(root: str, table: str, *, now: dt.datetime,
                 partition_column: str | None = None, partition_value=UNSET) -> str:
    """``{root}/ar_{table}/{year}/[{col}={value}/]{yyyyMMdd_HHmmss}``."""
    stamp = now.strftime("%Y%m%d_%H%M%S")
    base = f"{root.rstrip('/')}/ar_{table}/{now.year}"
    if partition_column is not None:
        # escaped, since a store may refuse ':' and blanks in a name
        value = NULL_PARTITION if partition_value is None else quote(str(partition_value), safe="")
        return f"{base}/{quote(partition_column, safe='')}={value}/{stamp}"
    return f"{base}/{stamp}"


def write_archive(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as ORC at ``path`` (never over existing files) and return it read back.

    ORC files do not keep column comments, so the schema (comments and
    tags included) is stored beside the files as one JSON line.
    """
    spark = df.sparkSession
    df.write.mode("errorifexists").orc(path)
    write_text(spark, path + SCHEMA_SUFFIX, df.schema.json() + "\n")
    return read_archive(spark, path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read an archive copy with its stored schema (comments restored)."""
    text = spark.read.text(path + SCHEMA_SUFFIX).first()[0]
    return spark.read.schema(T.StructType.fromJson(json.loads(text))).orc(path)


def list_archives(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``path, partition, stamp, stored_schema`` of every archive copy of a table.

    ``partition`` is the folder name of the partition (escaped; empty for a table
    without), ``stamp`` the time it was written, as it stands in the path. A
    copy counts from the moment its schema stands beside it, which is last.
    """
    home = f"{root.rstrip('/')}/ar_{table.rsplit('.', 1)[-1]}"
    levels = [f"{home}/*/*{SCHEMA_SUFFIX}", f"{home}/*/*=*/*{SCHEMA_SUFFIX}"]
    there = [p for p in levels if first_file(spark, [p])]
    if not there:
        return spark.createDataFrame([], "path string, partition string, stamp timestamp_ntz, stored_schema string")
    path = F.regexp_replace("path", f"{SCHEMA_SUFFIX}$", "")
    return spark.read.format("binaryFile").load(there).select(
        path.alias("path"), F.regexp_extract(path, "/([^/]+=[^/]*)/[^/]+$", 1).alias("partition"),
        F.try_to_timestamp(F.regexp_extract(path, "([^/]+)$", 1), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz").alias("stamp"),
        F.trim(F.decode("content", "UTF-8")).alias("stored_schema"))


def read_archive_as_of(spark: SparkSession, root: str, table: str, as_of: dt.datetime) -> DataFrame:
    """The rows of ``table`` as its archive copies hold them at ``as_of``.

    Of each partition, the newest copy written by then; of a table without
    partitions, the newest copy. ``as_of`` is in the zone the copies were stamped
    in. Copies of one schema are one scan, however many partitions there are; a
    column that an older copy lacks is null there.
    """
    by_then = list_archives(spark, root, table).where(F.col("stamp") <= F.lit(as_of).cast("timestamp_ntz"))
    # one row a partition; the copies themselves are not looked into
    newest = by_then.groupBy("partition").agg(F.max(F.struct("stamp", "path", "stored_schema")).alias("c")).select("c.*").collect()
    if not newest:
        raise ValueError(f"no archive copy of {table} at {root} from {as_of} or before")
    scans: dict[str, list] = {}
    for r in sorted(newest, key=lambda r: r["stamp"], reverse=True):
        scans.setdefault(r["stored_schema"], []).append(r["path"])
    out = None
    for schema, paths in scans.items():
        part = spark.read.schema(T.StructType.fromJson(json.loads(schema))).orc(paths)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------- layout

def _hashable(dtp: T.DataType) -> bool:
    """Spark can hash the type (it cannot where a map is inside)."""
    if isinstance(dtp, T.StructType):
        return all(_hashable(f.dataType) for f in dtp.fields)
    if isinstance(dtp, T.ArrayType):
        return _hashable(dtp.elementType)
    return not isinstance(dtp, (T.MapType, T.VariantType))


def _number(c: Column, dtp: T.DataType) -> Column:
    """A double in the order of the values, for quantiles (of a text, its first six bytes)."""
    if isinstance(dtp, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtp, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c, "UTC")).cast("double")
    if isinstance(dtp, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtp, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(dtp, (T.NumericType, T.BooleanType)):
        return c.cast("int").cast("double") if isinstance(dtp, T.BooleanType) else c.cast("double")
    raise TypeError(f"{dtp.simpleString()} values cannot be interleaved")


def _rank(x: Column, cuts: Sequence[float], low: int = 0) -> Column:
    """How many of the ascending ``cuts`` are at or below ``x``: a balanced tree of comparisons."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(x >= F.lit(cuts[mid]), _rank(x, cuts[mid + 1:], low + mid + 1)).otherwise(_rank(x, cuts[:mid], low))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on a space-filling curve over the columns.

    Each column's value is replaced by its quantile (``2**bits`` of them, from
    one aggregate over all rows), and the bits of the quantiles are interleaved, so
    a file of neighbours on the curve covers a narrow range of every column.
    """
    numbers = [_number(df[quote_ident(c)], df.schema[c].dataType) for c in columns]
    n = 1 << bits
    steps = F.array(*[F.lit(i / n) for i in range(1, n)])
    found = df.agg(*[F.percentile_approx(x, steps, 20 * n).alias(f"q{i}") for i, x in enumerate(numbers)]).first()
    place = F.lit(0).cast("bigint")
    for i, x in enumerate(numbers):
        rank = F.coalesce(_rank(x, sorted(set(found[f"q{i}"] or []))), F.lit(0)).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return place


def clustered(df: DataFrame, columns: Sequence[str],
              num_partitions: int | None = None, curve: bool = False) -> DataFrame:
    """Range-partition and sort by ``columns`` so files cover narrow key ranges.

    A hash of the row (of its columns without maps) breaks ties: a key that
    holds a third of the rows is then spread over several range partitions
    instead of one task. AQE can merge range partitions but not split them, so
    without ``num_partitions`` there are as many as the plan's size estimate
    has multiples of ``CLUSTER_BYTES``, and at least the session's default.
    ``curve`` orders by `interleaved` instead, so that files are narrow in every
    one of the columns and not in the first alone.
    """
    cols = [interleaved(df, columns)] if curve else [F.col(quote_ident(c)) for c in columns]
    tiebreak = F.xxhash64(*[F.col(quote_ident(f.name)) for f in df.schema.fields if _hashable(f.dataType)])
    if not num_partitions:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        num_partitions = max(default, min(1_000_000, math.ceil(size / CLUSTER_BYTES)))
    return df.repartitionByRange(num_partitions, *cols, tiebreak).sortWithinPartitions(*cols)


# -------------------------------------------------------------------- write

def _normalise_mode(mode: str) -> str:
    m = mode.strip().lower()
    if m in ("error", "default"):
        m = "errorifexists"
    if m not in SAVE_MODES:
        raise ValueError(f"save mode {mode!r} is not one of {SAVE_MODES}")
    return m


def _aligned(df: DataFrame, table_schema: T.StructType) -> list[Column]:
    """Table columns in table order, taken from ``df`` by name (missing → null).

    Names are compared as the session does, without case unless it says so.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    key = (lambda n: n) if exact else str.lower
    have = {key(c): c for c in df.columns}
    extra = set(have) - {key(n) for n in table_schema.fieldNames()}
    if extra:
        raise ValueError(f"columns {sorted(have[k] for k in extra)} are not in the table; update its schema first")
    return [(df[quote_ident(have[key(f.name)])] if key(f.name) in have else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in table_schema.fields]


def _not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job that meets a null in a REQUIRED column."""
    for c in columns:
        col = df[quote_ident(c)]
        df = df.withColumn(c, F.when(col.isNull(), F.raise_error(F.lit(f"null in required column {c}"))).otherwise(col))
    return df


def _update_settings(spark: SparkSession, table: str, settings: Mapping, clustering, options, mode: str) -> None:
    """Settings given with a write into an existing table."""
    given = {k: v for k, v in settings.items() if v is not None and k in SETTINGS}
    if given or clustering is not None:
        update_table_schema(spark, table, clustering=clustering, **given)
    if options:
        layout = table_layout(spark, table)
        old = layout["options"] or {}
        new = {**old, **{k: str(v) for k, v in options.items()}}
        if new == old:
            return
        if layout["format"].lower() not in ("parquet", "orc") and mode != "overwrite":
            raise ValueError(f"options of a {layout['format']} table also read the files it has; overwrite it instead")
        spark.sql(f"ALTER TABLE {quote_table(table)} SET SERDEPROPERTIES ({ddl_properties(new)})")
        spark.sql(f"ALTER TABLE {quote_table(table)} SET TBLPROPERTIES ({ddl_properties({PROP_OPTIONS: json.dumps(new)})})")


def write_table(df: DataFrame, table: str, *,
                mode: str = "overwrite",
                create_if_not_exists: bool = True,
                partitioning: PartitionSpec | None = None,
                partition_value=UNSET,
                clustering: Sequence[str] | None = None,
                encode_decimals: bool = False,
                decimal_columns: Sequence[str | int] | None = None,
                archive: bool = False,
                archive_root: str | None = None,
                zone: str = DEFAULT_ZONE,
                now: dt.datetime | None = None,
                options: Mapping[str, str] | None = None,
                format: str = "parquet",
                path: str | None = None,
                rebalance: bool | None = None,
                cluster_partitions: int | None = None,
                cluster_curve: bool = False,
                summaries: Sequence[str] | None = None,
                conform: bool = False,
                widen_float: bool = False,
                external=None,
                **table_settings) -> WriteResult:
    """Write ``df`` into catalog table ``table``.

    Order: encode wide decimals → archive copy → create if absent → write →
    re-tag comments. ``partition_value`` turns the write into a replace
    (``overwrite``) or append of exactly that partition (None: the partition
    of rows that have none); every row must belong to it, checked inside the
    write job. ``options`` are format options recorded on the table (e.g.
    compression). ``table_settings`` go to ``create_table`` (description,
    labels, …); an existing table is brought up to date with them once the
    rows are written. A full overwrite keeps the old rows until then.
    ``conform`` rewrites every column to a warehouse type first (V3).
    ``rebalance`` (default on for partitioned writes) adds AQE's REBALANCE on
    the partition column; pass False to write without a shuffle.
    ``cluster_curve`` lays a table without partitions out along a space-filling
    curve over all its cluster columns (see ``clustered``). ``summaries`` names
    columns whose values are summarised by file from then on (``summarise``).
    ``external`` (an ``ExternalData``) defines ``table`` over those files
    instead (when creating is allowed) and loads nothing into it.
    """
    spark = df.sparkSession
    mode = _normalise_mode(mode)
    unknown = set(table_settings) - {*SETTINGS, *AT_CREATION}
    if unknown:
        raise TypeError(f"unknown table settings {sorted(unknown)}")
    exists = table_exists(spark, table)
    if external is not None:
        from ..sources.external import define_external_table
        created = False
        if not exists and create_if_not_exists:
            keep = ("description", "friendly_name", "labels")
            created = define_external_table(spark, table, external,
                                            **{k: v for k, v in table_settings.items()
                                               if k in keep})
        log.warning("%s is an external table; nothing written", table)
        return WriteResult("skipped_external", table, created=created)
    props = table_properties(spark, table) if exists else {}
    if props.get(PROP_EXTERNAL) == "true":
        log.warning("%s is an external table; nothing written", table)
        return WriteResult("skipped_external", table)
    if exists and mode == "ignore":
        return WriteResult("ignored", table)
    if exists and mode == "errorifexists":
        raise RuntimeError(f"table {table} already exists")
    if not exists and not create_if_not_exists:
        raise RuntimeError(f"table {table} does not exist and create_if_not_exists is False")

    if encode_decimals:
        df = encode_wide_decimals(df, decimal_columns)
    if conform:
        df = conform_types(df, widen_float=widen_float)

    spec = PartitionSpec.from_properties(props) if exists else partitioning
    if exists and partitioning is not None and partitioning != spec:
        raise ValueError(f"table {table} is partitioned as {spec}, not {partitioning}")
    one = partition_value is not UNSET
    value = None
    if one:
        if spec is None:
            raise ValueError("partition_value given for an unpartitioned table")
        value = spec.values(partition_value)

    archived = None
    if archive:
        root = archive_root or spark.conf.get(ARCHIVE_ROOT_CONF, None)
        if not root:
            raise ValueError(f"archive needs archive_root or {ARCHIVE_ROOT_CONF}")
        if spec is not None and not one:
            raise ValueError("archiving a partitioned table needs partition_value")
        clock = now or dt.datetime.now(ZoneInfo(zone))
        archived = archive_path(root, table.rsplit(".", 1)[-1], now=clock,
                                partition_column=spec.column if spec else None,
                                partition_value=value)
        # The table is loaded from the archive, so both hold the same rows and
        # the plan below starts from files, not from the caller's lineage.
        df = write_archive(df, archived)

    if exists and encode_decimals:
        _check_nested_tags(spark, table, df.schema)
    created = False
    if not exists:
        created = create_table(spark, table, df.schema, partitioning=spec,
                               clustering=clustering, format=format, path=path,
                               options=options, **table_settings)
        props = table_properties(spark, table)
    elif options:
        _update_settings(spark, table, {}, None, options, mode)

    table_schema = spark.table(table).schema
    cluster_cols = list(clustering) if clustering is not None else clustering_of(props)
    df = _not_null(df, [c for c in required_columns(props) if c in df.columns])

    if one:
        # Every row must belong to the partition: checked inside the write job,
        # so a stray row fails the job before anything is committed.
        guard = spec.derive(df[quote_ident(spec.column)], df.schema[spec.column].dataType) \
            .eqNullSafe(spec.value_literal(value))
        fail = F.raise_error(F.lit(f"row outside partition {spec.partition_column}={value}"))
        first = df.schema.fields[0]
        df = df.select(F.when(guard, df[quote_ident(first.name)]).otherwise(fail)
                       .alias(first.name, metadata=first.metadata),
                       *[df[quote_ident(c)] for c in df.columns[1:]],
                       spec.value_literal(value).alias(spec.partition_column))
    elif spec is not None:
        df = spec.with_partition_column(df)
    by_partition = spec is not None and not one
    if by_partition and rebalance is not False:
        # One shuffle on the partition column: AQE sizes the output files and
        # splits a hot partition over several tasks; without it every task
        # would write one small file per partition it happens to hold.
        if spark.conf.get("spark.sql.adaptive.enabled") != "true":
            raise RuntimeError("a partitioned write needs spark.sql.adaptive.enabled to split hot partitions; "
                               "pass rebalance=False if the input is laid out by partition")
        lead = F.col(quote_ident(spec.partition_column))
        df = df.hint("rebalance", lead)
        if cluster_cols:
            df = df.sortWithinPartitions(lead, *[F.col(quote_ident(c)) for c in cluster_cols])
    elif cluster_cols:
        lead = [spec.partition_column] if by_partition else []
        df = clustered(df, lead + cluster_cols, cluster_partitions, cluster_curve and not by_partition)

    out = df.select(*_aligned(df, table_schema))
    if one and mode == "overwrite":
        overwrite_partition(spark, table, value, lambda staging: out.write.insertInto(staging))
    elif exists and mode == "overwrite":
        overwrite_all(spark, table, lambda staging: out.write.insertInto(staging))
    elif exists:
        base = versions.begin(spark, table)
        out.write.insertInto(table)
        versions.appended(spark, base)
    else:
        out.write.insertInto(table)

    if exists:
        _update_settings(spark, table, table_settings, clustering, None, mode)
        if encode_decimals:
            _retag(spark, table, df.schema)
    if summaries is not None or PROP_SUMMARIES in props:
        summarise(spark, table, summaries)
    return WriteResult("written", table, archived, created)


def _check_nested_tags(spark: SparkSession, table: str, written: T.StructType) -> None:
    """Refuse, before anything is written, tags that a managed table cannot take in place."""
    have = {f.name: f for f in data_schema(spark, table).fields}
    lost = [f.name for f in written.fields if f.name in have
            and _nested_tags(f.dataType) - _nested_tags(have[f.name].dataType)]
    if lost and not table_layout(spark, table)["external"]:
        raise ValueError(f"columns {lost} bring nested decimal tags that {table} lacks; "
                         "bring it up to date with update_table_schema first")


def _retag(spark: SparkSession, table: str, written: T.StructType) -> None:
    """Give an existing table the tags of what was just written into it.

    Top-level comments are altered in place. Nested tags need the schema
    update of ``update_table_schema``, metadata-only for tables with a path
    (for others the write was refused before it began).
    """
    spec = partition_spec_of(spark, table)
    current = [f for f in spark.table(table).schema.fields
               if spec is None or f.name != spec.partition_column]
    by_name = {f.name: f for f in written.fields}
    for f in current:
        w = by_name.get(f.name)
        if w is not None and has_tag(comment_of(w)) and not has_tag(comment_of(f)):
            spark.sql(f"ALTER TABLE {quote_table(table)} ALTER COLUMN {quote_ident(f.name)} "
                      f"COMMENT {sql_string(tag_comment(comment_of(f)))}")
    nested = [f for f in current if f.name in by_name
              and f.dataType.simpleString() == by_name[f.name].dataType.simpleString()
              and _nested_tags(by_name[f.name].dataType) - _nested_tags(f.dataType)]
    if not nested:
        return
    names = {f.name for f in nested}
    target = T.StructType([
        T.StructField(f.name, by_name[f.name].dataType, f.nullable, f.metadata)
        if f.name in names else f
        for f in spark.table(table).schema.fields
        if spec is None or f.name != spec.partition_column])
    update_table_schema(spark, table, target)


def _nested_tags(dtp: T.DataType, path: str = "") -> set[str]:
    """Paths of tagged fields inside a struct, array or map."""
    out: set[str] = set()
    if isinstance(dtp, T.StructType):
        for f in dtp.fields:
            p = f"{path}.{f.name}"
            if has_tag(comment_of(f)):
                out.add(p)
            out |= _nested_tags(f.dataType, p)
    elif isinstance(dtp, T.ArrayType):
        out |= _nested_tags(dtp.elementType, path + "[]")
    elif isinstance(dtp, T.MapType):
        out |= _nested_tags(dtp.valueType, path + "{}")
    return out


def replace_partition(df: DataFrame, table: str, partition_value, **kwargs) -> WriteResult:
    """Replace exactly one partition of ``table`` with ``df`` (others untouched).

    ``partition_value``: a source value; None names the partition of rows
    that have none (null keys, keys outside an integer range).
    """
    return write_table(df, table, mode="overwrite", partition_value=partition_value, **kwargs)
