"""Table definition on Spark's catalog: create, update, lifetimes.

All of it is catalog DDL issued from the driver (``CREATE TABLE``,
``ALTER TABLE``); no data passes through the driver. Table-level settings
are table properties, so any Spark reader sees them.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decimals import comment_of, with_comment
from ..session import delete_folder, quote_ident, quote_table, sql_string, unique_name
from . import versions
from .partitioning import PartitionSpec, TimePartitioning

log = logging.getLogger(__name__)

# Table property names (our own convention).
PROP_FRIENDLY_NAME = "friendly_name"
PROP_LABEL_PREFIX = "label."
PROP_LOCATION = "region"
PROP_CLUSTERING = "tessera.clustering"
PROP_REQUIRE_FILTER = "tessera.require_partition_filter"
PROP_EXPIRES_AT = "tessera.expires_at_ms"
PROP_EXTERNAL = "tessera.external"
PROP_OPTIONS = "tessera.options"
PROP_REQUIRED = "tessera.required_columns"
# Field metadata under which Spark keeps a char or varchar type (fixed value).
RAW_TYPE = "__CHAR_VARCHAR_TYPE_STRING"
DROP_CHUNK = 500

# Warehouse column type names accepted in column overrides, and their Spark types.
_OVERRIDE_TYPES = {
    "STRING": "string", "BYTES": "binary", "INTEGER": "bigint", "INT64": "bigint",
    "FLOAT": "double", "FLOAT64": "double", "NUMERIC": "decimal(38,9)",
    "BIGNUMERIC": "decimal(38,18)", "BOOLEAN": "boolean", "BOOL": "boolean",
    "TIMESTAMP": "timestamp", "DATE": "date", "DATETIME": "timestamp_ntz",
}


# ------------------------------------------------------------------ DDL text

def ddl_type(dtp: T.DataType) -> str:
    if isinstance(dtp, T.StructType):
        inner = ", ".join(
            f"{quote_ident(f.name)}: {ddl_type(f.dataType)}"
            + (f" COMMENT {sql_string(comment_of(f))}" if comment_of(f) else "")
            for f in dtp.fields)
        return f"STRUCT<{inner}>"
    if isinstance(dtp, T.ArrayType):
        return f"ARRAY<{ddl_type(dtp.elementType)}>"
    if isinstance(dtp, T.MapType):
        return f"MAP<{ddl_type(dtp.keyType)}, {ddl_type(dtp.valueType)}>"
    return dtp.simpleString()


def ddl_columns(schema: T.StructType) -> str:
    return ", ".join(
        f"{quote_ident(f.name)} {(f.metadata or {}).get(RAW_TYPE) or ddl_type(f.dataType)}"
        + (f" COMMENT {sql_string(comment_of(f))}" if comment_of(f) else "")
        for f in schema.fields)


def ddl_properties(props: Mapping[str, str]) -> str:
    return ", ".join(f"{sql_string(k)} = {sql_string(str(v))}" for k, v in props.items())


# ------------------------------------------------------------ column overrides

def apply_column_overrides(schema: T.StructType,
                           overrides: Sequence[Mapping[str, str]] | None) -> T.StructType:
    """Apply per-column settings to top-level fields named in ``overrides``.

    Keys: ``name`` (required), ``c-type`` (warehouse type name), ``mode``
    (NULLABLE, REQUIRED, REPEATED), ``description`` (merged as ``old|new``),
    ``max-length`` (string → varchar(n)), ``precision`` and ``scale``
    (→ decimal(p,s)). Each key stands alone; unnamed columns are unchanged.
    """
    if not overrides:
        return schema
    by_name = {o["name"]: o for o in overrides}
    unknown = set(by_name) - set(schema.fieldNames())
    if unknown:
        raise KeyError(f"column overrides name unknown columns {sorted(unknown)}")
    fields = []
    for f in schema.fields:
        o = by_name.get(f.name)
        if o is None:
            fields.append(f)
            continue
        dtp, nullable = f.dataType, f.nullable
        if o.get("c-type"):
            key = o["c-type"].strip().upper()
            if key == "RECORD":
                if not isinstance(dtp, T.StructType):
                    raise TypeError(f"column {f.name!r}: RECORD needs a struct column")
            elif key in _OVERRIDE_TYPES:
                dtp = T.DataType.fromDDL(_OVERRIDE_TYPES[key])
            else:
                raise ValueError(f"column {f.name!r}: unknown type {o['c-type']!r}")
        if o.get("max-length"):
            if not isinstance(dtp, (T.StringType, T.VarcharType, T.CharType)):
                raise TypeError(f"column {f.name!r}: max-length needs a string column")
            dtp = T.VarcharType(int(o["max-length"]))
        given = {k: int(o[k]) for k in ("precision", "scale") if o.get(k) not in (None, "")}
        if given:
            base = dtp if isinstance(dtp, T.DecimalType) else T.DecimalType(38, 9)
            p = given.get("precision", base.precision)
            # a precision alone keeps as much of the scale as fits
            s = given.get("scale", min(base.scale, p))
            if not 0 <= s <= p <= 38 or not p:
                raise ValueError(f"column {f.name!r}: decimal({p},{s}) is not possible")
            dtp = T.DecimalType(p, s)
        mode = (o.get("mode") or "").strip().upper()
        if mode == "REQUIRED":
            nullable = False
        elif mode == "NULLABLE":
            nullable = True
        elif mode == "REPEATED" and not isinstance(dtp, T.ArrayType):
            dtp = T.ArrayType(dtp, True)
        elif mode not in ("", "REPEATED"):
            raise ValueError(f"column {f.name!r}: unknown mode {o['mode']!r}")
        comment = comment_of(f)
        if o.get("description"):
            comment = o["description"] if not comment else f"{comment}|{o['description']}"
        metadata = with_comment(f, comment)
        if dtp != f.dataType:
            metadata.pop(RAW_TYPE, None)
        fields.append(T.StructField(f.name, dtp, nullable, metadata))
    return T.StructType(fields)


# ------------------------------------------------------------------ queries

def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote_table(name)}").collect()
    return {r["key"]: r["value"] for r in rows}


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def clustering_of(props: Mapping[str, str]) -> list[str]:
    """Cluster columns recorded on a table."""
    text = props.get(PROP_CLUSTERING)
    return json.loads(text) if text else []


def required_columns(props: Mapping[str, str]) -> list[str]:
    """Columns whose mode is REQUIRED: writers refuse nulls in them."""
    text = props.get(PROP_REQUIRED)
    return json.loads(text) if text else []


def is_external(spark: SparkSession, name: str) -> bool:
    return table_properties(spark, name).get(PROP_EXTERNAL) == "true"


def partition_spec_of(spark: SparkSession, name: str) -> PartitionSpec | None:
    return PartitionSpec.from_properties(table_properties(spark, name))


# ------------------------------------------------------------------- create

def settings_properties(*, partitioning, clustering, require_partition_filter, friendly_name,
                 labels, location, expiration_time, extra) -> dict[str, str]:
    props: dict[str, str] = {}
    if partitioning is not None:
        props.update(partitioning.to_properties())
    if clustering:
        props[PROP_CLUSTERING] = json.dumps(list(clustering))
    if require_partition_filter:
        if partitioning is None:
            raise ValueError("require_partition_filter needs a partitioned table")
        props[PROP_REQUIRE_FILTER] = "true"
    if friendly_name:
        props[PROP_FRIENDLY_NAME] = friendly_name
    for k, v in (labels or {}).items():
        props[PROP_LABEL_PREFIX + k] = v
    if location:
        props[PROP_LOCATION] = location
    if expiration_time is not None:
        props[PROP_EXPIRES_AT] = str(_epoch_ms(expiration_time))
    props.update(extra or {})
    return props


def _epoch_ms(value) -> int:
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=dt.timezone.utc)
        return int(value.timestamp() * 1000)
    return int(value)


def create_table(spark: SparkSession, name: str, schema: T.StructType, *,
                 partitioning: PartitionSpec | None = None,
                 clustering: Sequence[str] | None = None,
                 require_partition_filter: bool = False,
                 description: str | None = None,
                 friendly_name: str | None = None,
                 labels: Mapping[str, str] | None = None,
                 location: str | None = None,
                 column_overrides: Sequence[Mapping[str, str]] | None = None,
                 expiration_time=None,
                 format: str = "parquet",
                 path: str | None = None,
                 options: Mapping[str, str] | None = None,
                 properties: Mapping[str, str] | None = None,
                 materialized_view: tuple[str, str] | None = None,
                 view: tuple[str, str] | None = None,
                 snapshot: str | None = None) -> bool:
    """Create ``name`` unless it exists; returns True when created.

    ``schema`` is the data schema; a partitioned table gets the derived
    partition column appended. Clustering becomes ``CLUSTER BY`` on an
    unpartitioned table (Spark forbids it with ``PARTITIONED BY``) and is
    recorded as a property either way, for the writer's layout.

    ``materialized_view=(name, query)``, ``view=(name, query)`` and
    ``snapshot=name`` (a copy of this table) are created after the table, in
    that order, each only if absent; a failure leaves what was created so far.
    """
    created = _create_plain(spark, name, schema, partitioning=partitioning,
                            clustering=clustering,
                            require_partition_filter=require_partition_filter,
                            description=description, friendly_name=friendly_name,
                            labels=labels, location=location,
                            column_overrides=column_overrides,
                            expiration_time=expiration_time, format=format, path=path,
                            options=options, properties=properties)
    if materialized_view or view or snapshot:
        from .views import create_materialized_view, create_snapshot, create_view

        def beside(obj: str) -> str | None:
            # stored objects go next to the table's folder when it has one
            if not path:
                return None
            return f"{path.rstrip('/').rsplit('/', 1)[0]}/{obj.replace('.', '_')}"
        if materialized_view:
            create_materialized_view(spark, *materialized_view, format=format,
                                     path=beside(materialized_view[0]))
        if view:
            create_view(spark, *view)
        if snapshot:
            create_snapshot(spark, name, snapshot, format=format, path=beside(snapshot))
    return created


def _create_plain(spark: SparkSession, name: str, schema: T.StructType, *, partitioning,
                  clustering, require_partition_filter, description, friendly_name, labels,
                  location, column_overrides, expiration_time, format, path, options,
                  properties) -> bool:
    if table_exists(spark, name):
        log.warning("table %s already exists", name)
        return False
    schema = apply_column_overrides(schema, column_overrides)
    for c in clustering or ():
        if c not in schema.fieldNames():
            raise KeyError(f"clustering column {c!r} is not in the schema")
    if partitioning is not None:
        if partitioning.column not in schema.fieldNames():
            raise KeyError(f"partition column {partitioning.column!r} is not in the schema")
        schema = T.StructType(schema.fields + [
            T.StructField(partitioning.partition_column, partitioning.partition_type, True)])
    props = settings_properties(partitioning=partitioning, clustering=clustering,
                         require_partition_filter=require_partition_filter,
                         friendly_name=friendly_name, labels=labels, location=location,
                         expiration_time=expiration_time, extra=properties)
    props.setdefault(versions.PROP_ID, versions.new_id())
    # kept beside Spark's own storage properties, whose text form cannot be parsed back
    if options:
        props[PROP_OPTIONS] = json.dumps({k: str(v) for k, v in options.items()})
    needed = _required(column_overrides)
    if needed:
        props[PROP_REQUIRED] = json.dumps(needed)
    sql = [f"CREATE TABLE {quote_table(name)} ({ddl_columns(schema)}) USING {format}"]
    if options:
        sql.append(f"OPTIONS ({ddl_properties(options)})")
    if partitioning is not None:
        sql.append(f"PARTITIONED BY ({quote_ident(partitioning.partition_column)})")
    elif clustering:
        sql.append("CLUSTER BY (" + ", ".join(quote_ident(c) for c in clustering) + ")")
    if path:
        sql.append(f"LOCATION {sql_string(path)}")
    if description:
        sql.append(f"COMMENT {sql_string(description)}")
    if props:
        sql.append(f"TBLPROPERTIES ({ddl_properties(props)})")
    spark.sql(" ".join(sql))
    return True


def _required(overrides: Sequence[Mapping[str, str]] | None) -> list[str]:
    return [o["name"] for o in overrides or () if (o.get("mode") or "").strip().upper() == "REQUIRED"]


# ------------------------------------------------------------------- update

def data_schema(spark: SparkSession, name: str) -> T.StructType:
    schema = spark.table(name).schema
    spec = partition_spec_of(spark, name)
    if spec is None:
        return schema
    return T.StructType([f for f in schema.fields if f.name != spec.partition_column])


def update_table_schema(spark: SparkSession, name: str, schema: T.StructType | None = None, *,
                        description: str | None = None,
                        friendly_name: str | None = None,
                        labels: Mapping[str, str] | None = None,
                        location: str | None = None,
                        column_overrides: Sequence[Mapping[str, str]] | None = None,
                        require_partition_filter: bool | None = None,
                        expiration_time=None,
                        clustering: Sequence[str] | None = None,
                        partition_expiration_ms: int | None = None,
                        properties: Mapping[str, str] | None = None,
                        view: tuple[str, str] | None = None) -> bool:
    """Bring an existing table to ``schema`` and settings; warn if it is missing.

    ``clustering`` (an empty list ends it) and ``partition_expiration_ms``
    (0 ends it) take effect for later writes and expiry runs.

    ``view=(name, query)`` also replaces that view's query when the view
    exists (warning otherwise), whether or not the table does.

    New top-level columns are added, changed comments altered in place.
    Spark refuses nested ALTERs on file-source tables: when only nested
    comments change on an external table, its catalog entry is rebuilt over
    the same files (no data touched). A type change, a dropped or reordered
    column, or a nested change on a managed table rewrites the table into a
    new one (one distributed ``INSERT … SELECT`` with casts) and renames it,
    keeping properties, options, partitioning and comments.
    """
    updated = _update_plain(spark, name, schema, description=description,
                            friendly_name=friendly_name, labels=labels, location=location,
                            column_overrides=column_overrides,
                            require_partition_filter=require_partition_filter,
                            expiration_time=expiration_time, clustering=clustering,
                            partition_expiration_ms=partition_expiration_ms, properties=properties)
    if view is not None:
        from .views import update_view
        update_view(spark, *view)
    return updated


def _update_plain(spark: SparkSession, name: str, schema: T.StructType | None, *, description,
                  friendly_name, labels, location, column_overrides, require_partition_filter,
                  expiration_time, clustering, partition_expiration_ms, properties) -> bool:
    if not table_exists(spark, name):
        log.warning("table %s does not exist; nothing updated", name)
        return False
    current = data_schema(spark, name)
    target = apply_column_overrides(schema or current, column_overrides)
    cur_by = {f.name: f for f in current.fields}
    tgt_names = target.fieldNames()
    keeps_columns = (all(n in tgt_names for n in cur_by)
                     and tgt_names[:len(cur_by)] == list(cur_by))
    same_types = keeps_columns and all(
        _strip(cur_by[f.name].dataType) == _strip(f.dataType)
        for f in target.fields if f.name in cur_by)
    same_nested = same_types and all(
        _nested_comments(cur_by[f.name].dataType) == _nested_comments(f.dataType)
        for f in target.fields if f.name in cur_by)
    if same_nested:
        added = [f for f in target.fields if f.name not in cur_by]
        if added:
            spark.sql(f"ALTER TABLE {quote_table(name)} ADD COLUMNS ({ddl_columns(T.StructType(added))})")
        for f in target.fields:
            if f.name in cur_by and comment_of(f) != comment_of(cur_by[f.name]):
                spark.sql(f"ALTER TABLE {quote_table(name)} ALTER COLUMN {quote_ident(f.name)} "
                          f"COMMENT {sql_string(comment_of(f))}")
    elif same_types and table_layout(spark, name)["external"]:
        # only nested comments change: Spark refuses a nested ALTER, but the
        # files need no change at all, so only the catalog entry is rebuilt
        _recreate_entry(spark, name, target)
    else:
        _rewrite(spark, name, current, target)
    props = settings_properties(partitioning=None, clustering=None, require_partition_filter=False,
                         friendly_name=friendly_name, labels=labels, location=location,
                         expiration_time=expiration_time, extra=properties)
    if require_partition_filter is not None:
        props[PROP_REQUIRE_FILTER] = "true" if require_partition_filter else "false"
    if clustering is not None:
        missing = set(clustering) - set(target.fieldNames())
        if missing:
            raise KeyError(f"clustering columns {sorted(missing)} are not in the schema")
        props[PROP_CLUSTERING] = json.dumps(list(clustering))
    if partition_expiration_ms is not None:
        spec = partition_spec_of(spark, name)
        if spec is None or not isinstance(spec.metadata, TimePartitioning):
            raise ValueError(f"table {name} has no time partitions to expire")
        props["tessera.partition.expiration_ms"] = str(partition_expiration_ms or "")
    now_required = _required(column_overrides)
    if now_required:
        props[PROP_REQUIRED] = json.dumps(sorted({*required_columns(table_properties(spark, name)), *now_required}))
    if props:
        spark.sql(f"ALTER TABLE {quote_table(name)} SET TBLPROPERTIES ({ddl_properties(props)})")
    if description is not None:
        spark.sql(f"COMMENT ON TABLE {quote_table(name)} IS {sql_string(description)}")
    return True


def _strip(dtp: T.DataType) -> str:
    return dtp.simpleString()


def _nested_comments(dtp: T.DataType) -> list:
    if isinstance(dtp, T.StructType):
        return [(f.name, comment_of(f), _nested_comments(f.dataType)) for f in dtp.fields]
    if isinstance(dtp, T.ArrayType):
        return _nested_comments(dtp.elementType)
    if isinstance(dtp, T.MapType):
        return [_nested_comments(dtp.keyType), _nested_comments(dtp.valueType)]
    return []


def table_layout(spark: SparkSession, name: str) -> dict:
    """What re-creating ``name`` needs: format, location, options, properties."""
    props = {k: v for k, v in table_properties(spark, name).items()
             if not k.startswith(("spark.", "transient_", "option."))}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(name)}").collect()
    info = {r["col_name"]: r["data_type"] for r in rows}
    options = json.loads(props.pop(PROP_OPTIONS, "null"))
    if options is None:  # a table that was not created here: Spark's text form, as far as it can be read
        options = {}
        storage = (info.get("Storage Properties") or "").strip("[]")
        for part in filter(None, (p.strip() for p in storage.split(","))):
            k, _, v = part.partition("=")
            if k and k != "path":
                options[k] = v
    own = {versions.PROP_HOME, versions.PROP_ID, versions.PROP_VERSION, versions.PROP_SUMMARISED}
    return {
        "format": info.get("Provider", "parquet"),
        "external": info.get("Type") == "EXTERNAL",
        "location": info.get("Location"),
        "description": info.get("Comment") or None,
        "options": options or None,
        "spec": PartitionSpec.from_properties(props),
        "clustering": clustering_of(props) or None,
        "properties": {k: v for k, v in props.items()
                       if not k.startswith("tessera.partition.") and k != PROP_CLUSTERING and k not in own},
        "home": props.get(versions.PROP_HOME),
        "id": props.get(versions.PROP_ID),
        "version": int(props.get(versions.PROP_VERSION, 0)),
    }


def _recreate_entry(spark: SparkSession, name: str, target: T.StructType) -> None:
    """Metadata-only schema change of an external table: same files, new entry.

    The catalog entry is dropped (an external table's files stay) and created
    again over the same folder with the new schema, properties and options;
    partitions are found again from the folders. No data is read or written.
    """
    base = versions.begin(spark, name)
    d = table_layout(spark, name)
    parts = partition_texts(spark, name) if d["spec"] is not None else []
    own = {versions.PROP_HOME: base.home, versions.PROP_ID: base.id, versions.PROP_VERSION: str(base.version)}
    old = unique_name(name.rsplit(".", 1)[-1] + "__old")
    aside = f"{name.rsplit('.', 1)[0]}.{old}" if "." in name else old
    spark.sql(f"ALTER TABLE {quote_table(name)} RENAME TO {quote_table(aside)}")
    try:
        create_table(spark, name, target, partitioning=d["spec"], clustering=d["clustering"],
                     description=d["description"], format=d["format"], path=d["location"],
                     options=d["options"], properties=d["properties"] | own)
        # the partitions that were listed, not all folders found: expired ones stay away
        for i in range(0, len(parts), DROP_CHUNK):
            specs = " ".join(f"PARTITION ({partition_clause(d['spec'], p)}) LOCATION {sql_string(base.folder_of(p))}"
                             for p in parts[i:i + DROP_CHUNK])
            spark.sql(f"ALTER TABLE {quote_table(name)} ADD IF NOT EXISTS {specs}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quote_table(name)}")
        spark.sql(f"ALTER TABLE {quote_table(aside)} RENAME TO {quote_table(name)}")
        raise
    spark.sql(f"DROP TABLE {quote_table(aside)}")


def _beside(name: str, what: str) -> str:
    """A fresh table name in the database of ``name``."""
    fresh = unique_name(f"{name.rsplit('.', 1)[-1]}__{what}")
    return f"{name.rsplit('.', 1)[0]}.{fresh}" if "." in name else fresh


def _rewrite(spark: SparkSession, name: str, current: T.StructType, target: T.StructType) -> None:
    """Copy into a new table with the target schema, then swap names; the old one goes last."""
    base = versions.begin(spark, name)
    d = table_layout(spark, name)
    spec = d["spec"]
    tmp, aside = _beside(name, "rewrite"), _beside(name, "old")
    # an external table keeps its data beside the old location
    path = None
    if d["external"] and d["location"]:
        path = f"{d['location'].rstrip('/')}__{tmp.rsplit('.', 1)[-1]}"
    create_table(spark, tmp, target, partitioning=spec, clustering=d["clustering"],
                 description=d["description"], format=d["format"], path=path,
                 options=d["options"], properties=d["properties"])
    cur = set(current.fieldNames())
    src = spark.table(name)
    cols = [(src[quote_ident(f.name)].cast(f.dataType) if f.name in cur
             else F.lit(None).cast(f.dataType)
             ).alias(f.name) for f in target.fields]
    if spec is not None:
        cols.append(src[quote_ident(spec.partition_column)])
    try:
        src.select(*cols).write.insertInto(tmp, overwrite=True)
        spark.sql(f"ALTER TABLE {quote_table(name)} RENAME TO {quote_table(aside)}")
    except BaseException:
        drop_table(spark, tmp, path)
        raise
    try:
        spark.sql(f"ALTER TABLE {quote_table(tmp)} RENAME TO {quote_table(name)}")
    except BaseException:
        spark.sql(f"ALTER TABLE {quote_table(aside)} RENAME TO {quote_table(name)}")
        drop_table(spark, tmp, path)
        raise
    drop_table(spark, aside)
    if d["external"]:
        versions.remove_all(spark, base)


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Drop a table, and its files at ``path`` where Spark leaves them."""
    spark.sql(f"DROP TABLE IF EXISTS {quote_table(name)}")
    if path:
        delete_folder(spark, path)


def _staged(spark: SparkSession, name: str, base: versions.Base, write) -> tuple[str, list[str]]:
    """Fill an empty table of the same definition in a fresh folder; that folder, and the partitions it got."""
    d = table_layout(spark, name)
    staging = base.fresh_folder()
    tmp = _beside(name, "staging")
    create_table(spark, tmp, data_schema(spark, name), partitioning=d["spec"], clustering=d["clustering"],
                 format=d["format"], path=staging, options=d["options"])
    try:
        write(tmp)
        parts = partition_texts(spark, tmp) if d["spec"] is not None else []
    except BaseException:
        drop_table(spark, tmp, staging)
        raise
    spark.sql(f"DROP TABLE {quote_table(tmp)}")
    return staging, parts


def overwrite_all(spark: SparkSession, name: str, write) -> None:
    """Replace all rows of ``name`` once the new ones are written.

    ``write(staging)`` fills a table in a fresh folder, so a failed job leaves
    the old rows, the new rows may be computed from them, and no setting of the
    session is touched. Then the table is pointed at that folder (`versions`);
    a second writer that began before that gets ``ConcurrentWrite``.
    """
    base = versions.begin(spark, name)
    staging, parts = _staged(spark, name, base, write)
    try:
        versions.commit(spark, base, "overwrite", location=staging, changes={p: f"{staging}/{p}" for p in parts})
    except versions.ConcurrentWrite:
        delete_folder(spark, staging)
        raise


def overwrite_partition(spark: SparkSession, name: str, value, write) -> None:
    """Replace one partition of ``name`` once its new rows are written; without any, it is emptied."""
    base = versions.begin(spark, name)
    held = NULL_PARTITION if value is None else str(value)
    staging, parts = _staged(spark, name, base, write)
    changes = {p: f"{staging}/{p}" for p in parts} or {
        p: None for p in partition_texts(spark, name) if unquote(p.split("=", 1)[1]) == held}
    try:
        versions.commit(spark, base, "partitions", changes=changes)
    except versions.ConcurrentWrite:
        delete_folder(spark, staging)
        raise


# --------------------------------------------------------------- lifetimes

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_texts(spark: SparkSession, name: str) -> list[str]:
    """Folder names (``column=value``, escaped) of the partitions the catalog lists."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {quote_table(name)}").collect()]


def partition_clause(spec: PartitionSpec | None, folder: str) -> str:
    """``column = literal`` of a partition's folder name (without a spec: of a text column)."""
    value = unquote(folder.split("=", 1)[1])
    if spec is None:
        return f"{quote_ident(unquote(folder.split('=', 1)[0]))} = {sql_string(value)}"
    if value == NULL_PARTITION:
        text = "null"
    elif isinstance(spec.partition_type, T.LongType):
        text = value
    else:
        kind = "TIMESTAMP_NTZ" if isinstance(spec.partition_type, T.TimestampNTZType) else "DATE"
        text = f"{kind} {sql_string(value)}"
    return f"{quote_ident(spec.partition_column)} = {text}"


def drop_partitions(spark: SparkSession, name: str, folders: Sequence[str]) -> None:
    """Drop partitions by folder name, with their files.

    Spark leaves the files of tables with a path of their own; a later append
    or partition recovery would bring the old rows back. Files that a snapshot
    reads stay until it is dropped.
    """
    versions.commit(spark, versions.begin(spark, name), "drop", changes={f: None for f in folders})


def expire_partitions(spark: SparkSession, name: str, as_of: dt.datetime) -> list:
    """Drop the partitions whose lifetime (from their start) ended by ``as_of``, files included.

    Works on the catalog's partition list only; returns the dropped values.
    """
    spec = partition_spec_of(spark, name)
    if spec is None:
        raise ValueError(f"table {name} is not partitioned")
    value = lambda folder: unquote(folder.split("=", 1)[1])
    gone = [f for f in partition_texts(spark, name)
            if value(f) != NULL_PARTITION and spec.expired(value(f), as_of)]
    if gone:
        drop_partitions(spark, name, gone)
    return [value(f) for f in gone]


def expire_tables(spark: SparkSession, as_of, database: str | None = None) -> list[str]:
    """Drop tables whose ``expires_at`` lies at or before ``as_of``, with the files they wrote."""
    limit = _epoch_ms(as_of)
    dropped = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW":
            continue
        full = f"{t.database}.{t.name}" if t.database else t.name
        props = table_properties(spark, full)
        exp = props.get(PROP_EXPIRES_AT)
        if exp is not None and int(exp) <= limit:
            # files registered as external data belong to their owner
            own = props.get(PROP_EXTERNAL) != "true"
            base = versions.begin(spark, full) if own else None
            files = own and table_layout(spark, full)["external"]
            drop_table(spark, full)
            if files:
                versions.remove_all(spark, base)
            dropped.append(full)
    return dropped
