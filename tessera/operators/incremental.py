"""Stored aggregates kept up to date from the source partitions that changed.

A view groups one table by some keys. Beside its result lies a table of partial
aggregates with one partition a source partition, so the share of a source
partition can be taken back by replacing that partition alone. A refresh

1. lists the source's files (without reading them) and compares a fingerprint of
   each source partition's with the one its partials were made from;
2. aggregates the changed source partitions only (a partition filter of the
   scan) and replaces their partials, and drops those of partitions that are
   gone, in one commit (`versions`) that also holds the new fingerprints;
3. merges all partials into the result, in a second commit.

Both steps may be repeated: a refresh that dies is made good by the next one, and
of two at a time one fails with ``ConcurrentWrite``. Only fingerprints, one line a
source partition, reach the driver.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, file_names, quote_ident, quote_table, sql_string
from . import versions
from .tables import (NULL_PARTITION, create_table, ddl_columns, ddl_properties, overwrite_all, partition_clause,
                     partition_spec_of, partition_texts, table_exists, table_properties)

log = logging.getLogger(__name__)

PROP_INCREMENTAL = "tessera.incremental"
PROP_MERGED = "tessera.merged_version"
SOURCE = "source__partition"
KINDS = ("count", "sum", "min", "max", "avg")


@dataclass(frozen=True)
class Measure:
    """``count``, ``sum``, ``min``, ``max`` or ``avg`` of an SQL expression (``count`` also of ``*``)."""

    kind: str
    expr: str = "*"

    def whole(self) -> Column:
        return F.expr(f"{self.kind}({self.expr})")

    def partials(self, name: str) -> list[Column]:
        if self.kind == "avg":
            return [F.expr(f"sum({self.expr})").alias(f"{name}__sum"), F.expr(f"count({self.expr})").alias(f"{name}__count")]
        return [self.whole().alias(name)]

    def merged(self, name: str) -> Column:
        at = lambda c: F.col(quote_ident(c))
        if self.kind == "avg":
            return F.try_divide(F.sum(at(f"{name}__sum")), F.sum(at(f"{name}__count")))
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](at(name))


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: source partitions aggregated anew, taken back, and left alone."""

    changed: Sequence[str]
    dropped: Sequence[str]
    unchanged: int
    merged: bool


def _partials_table(name: str) -> str:
    return f"{name}__partials"


def _definition(spark: SparkSession, name: str) -> dict:
    text = table_properties(spark, name).get(PROP_INCREMENTAL)
    if text is None:
        raise ValueError(f"{name} is not an incremental view")
    d = json.loads(text)
    d["measures"] = {k: Measure(**m) for k, m in d["measures"].items()}
    return d


def _rows(spark: SparkSession, d: Mapping) -> DataFrame:
    rows = spark.table(d["base"])
    return rows.where(d["where"]) if d["where"] else rows


def create_incremental_view(spark: SparkSession, name: str, base: str, *, keys: Mapping[str, str],
                            measures: Mapping[str, Measure], where: str | None = None,
                            format: str = "parquet", path: str | None = None) -> bool:
    """Store ``measures`` of ``base`` by ``keys`` (column name to SQL expression) as table ``name``.

    Without keys the result is one row. ``where`` filters the source's rows.
    """
    if table_exists(spark, name):
        log.warning("materialized view %s already exists", name)
        return False
    for k, m in measures.items():
        if m.kind not in KINDS:
            raise ValueError(f"measure {k!r}: {m.kind!r} is not one of {KINDS}")
    d = {"base": base, "keys": dict(keys), "measures": measures, "where": where}
    by = [F.expr(e).alias(k) for k, e in keys.items()]
    rows = _rows(spark, d)
    whole = rows.groupBy(*by).agg(*[m.whole().alias(k) for k, m in measures.items()]).schema
    for k, m in measures.items():
        if m.kind == "avg" and isinstance(whole[k].dataType, T.DecimalType):
            raise ValueError(f"measure {k!r}: keep sum and count of a decimal; their quotient would round twice")
    partial = rows.groupBy(*by).agg(*[c for k, m in measures.items() for c in m.partials(k)]).schema
    told = json.dumps({**d, "measures": {k: asdict(m) for k, m in measures.items()}})
    nullable = lambda s: T.StructType([T.StructField(f.name, f.dataType) for f in s.fields])
    create_table(spark, name, nullable(whole), format=format, path=path, properties={PROP_INCREMENTAL: told})
    home = path or versions.begin(spark, name).home
    spark.sql(f"CREATE TABLE {quote_table(_partials_table(name))} ({ddl_columns(nullable(partial))}, {SOURCE} STRING) "
              f"USING parquet PARTITIONED BY ({SOURCE}) LOCATION {sql_string(home.rstrip('/') + '__partials')} "
              f"TBLPROPERTIES ({ddl_properties({versions.PROP_ID: versions.new_id()})})")
    refresh_incremental_view(spark, name)
    return True


def _fingerprints(spark: SparkSession, base: str) -> dict[str, str]:
    """A text for each source partition (one, named '', of a table without) that changes with its files."""
    state = versions.begin(spark, base)
    parts = partition_texts(spark, base) if partition_spec_of(spark, base) is not None else [""]
    folders = {state.folder_of(p) if p else state.location: p for p in parts}
    out = {p: "" for p in parts}
    prints = (versions.files_of(spark, folders).groupBy("folder")
              .agg(F.count("*").alias("n"), F.sum("length").alias("length"),
                   F.bit_xor(F.xxhash64("name", "length", "modified")).alias("h")))
    for r in prints.collect():
        if r["folder"] in folders:
            out[folders[r["folder"]]] += f"{r['n']}:{r['length']}:{r['h']}"
    return {p: f"{state.folder_of(p) if p else state.location}|{x}" for p, x in out.items()}


def source_id(partition: str) -> str:
    """Name of a source partition's partials."""
    value = versions.partition_value(partition) if partition else ""
    return hashlib.md5(value.encode()).hexdigest()[:20]


def changed_rows(spark: SparkSession, name: str, partitions: Sequence[str]) -> DataFrame:
    """The view's source rows in the partitions named: a scan with a filter on the partition column."""
    d = _definition(spark, name)
    spec = partition_spec_of(spark, d["base"])
    if spec is None:
        return _rows(spark, d)
    held = quote_ident(spec.partition_column)
    values = [partition_clause(spec, p).split(" = ", 1)[1] for p in partitions
              if versions.partition_value(p) != NULL_PARTITION]
    tests = [f"{held} IN ({', '.join(values)})"] if values else []
    if len(values) < len(partitions):
        tests.append(f"{held} IS NULL")
    return _rows(spark, d).where(" OR ".join(tests) or "false")


def refresh_incremental_view(spark: SparkSession, name: str) -> Refresh:
    """Bring the view up to date; it reads only source partitions whose files changed."""
    d = _definition(spark, name)
    partials = _partials_table(name)
    state = versions.begin(spark, partials)
    known = state.info.get("sources", {})
    now = _fingerprints(spark, d["base"])
    changed = sorted(p for p, x in now.items() if known.get(p) != x)
    dropped = sorted(p for p in known if p not in now)
    version = state.version
    if changed or dropped:
        spec = partition_spec_of(spark, d["base"])
        text = F.lit("") if spec is None else F.coalesce(
            F.col(quote_ident(spec.partition_column)).cast("string"), F.lit(NULL_PARTITION))
        by = [F.expr(e).alias(k) for k, e in d["keys"].items()]
        source = F.substring(F.md5(text.cast("binary")), 1, 20).alias(SOURCE)
        staging = state.fresh_folder()
        try:
            if changed:
                (changed_rows(spark, name, changed).groupBy(source, *by)
                 .agg(*[c for k, m in d["measures"].items() for c in m.partials(k)])
                 .write.partitionBy(SOURCE).parquet(staging))
            made = set(file_names(spark, staging))
            folder = {p: f"{SOURCE}={source_id(p)}" for p in [*changed, *dropped]}
            changes = {f: f"{staging}/{f}" if f in made else None for f in folder.values()}
            version = versions.commit(spark, state, "partitions", changes=changes, info={"sources": now})
        except BaseException:
            if version == state.version:
                delete_folder(spark, staging)
            raise
    merged = table_properties(spark, name).get(PROP_MERGED) != str(version)
    if merged:
        keys = [F.col(quote_ident(k)) for k in d["keys"]]
        target = spark.table(name).schema
        rows = spark.table(partials).groupBy(*keys).agg(*[m.merged(k).alias(k) for k, m in d["measures"].items()])
        if not keys:  # counts of no rows at all
            rows = rows.select(*[F.coalesce(F.col(quote_ident(k)), F.lit(0)).alias(k) if m.kind == "count"
                                 else F.col(quote_ident(k)) for k, m in d["measures"].items()])
        rows = rows.select(*[F.col(quote_ident(f.name)).cast(f.dataType).alias(f.name) for f in target.fields])
        overwrite_all(spark, name, lambda staging: rows.write.insertInto(staging))
        spark.sql(f"ALTER TABLE {quote_table(name)} SET TBLPROPERTIES ({sql_string(PROP_MERGED)} = '{version}')")
    return Refresh(changed, dropped, len(now) - len(changed), merged)
