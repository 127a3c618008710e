"""Views, stored (materialized) views and snapshots on Spark's catalog."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, quote_ident, quote_table, sql_string
from . import versions
from .tables import (PROP_EXTERNAL, create_table, data_schema, ddl_columns, ddl_properties, overwrite_all,
                     partition_clause, partition_texts, settings_properties, table_exists, table_layout, table_properties)

log = logging.getLogger(__name__)

PROP_MATVIEW_QUERY = "tessera.materialized_query"
PROP_SNAPSHOT_OF = "tessera.snapshot_of"
PROP_SNAPSHOT_TIME = "tessera.snapshot_time"
PROP_SNAPSHOT_NOTE = "tessera.snapshot_note"
PROP_SNAPSHOT_LIST = "tessera.snapshot_list"
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


def create_view(spark: SparkSession, name: str, query: str) -> bool:
    """Create a persistent view unless one exists (``query`` names catalog tables)."""
    if table_exists(spark, name):
        log.warning("view %s already exists", name)
        return False
    spark.sql(f"CREATE VIEW IF NOT EXISTS {quote_table(name)} AS {query}")
    return True


def update_view(spark: SparkSession, name: str, query: str) -> bool:
    """Replace the definition of an existing view; warn when it is missing."""
    if not table_exists(spark, name):
        log.warning("view %s does not exist; nothing updated", name)
        return False
    spark.sql(f"ALTER VIEW {quote_table(name)} AS {query}")
    return True


def create_materialized_view(spark: SparkSession, name: str, query: str, *,
                             format: str = "parquet", path: str | None = None) -> bool:
    """Store the result of ``query`` as a table (CTAS) that ``refresh`` recomputes.

    Any query will do. Aggregates over one table are cheaper to keep up to date
    with ``create_incremental_view``.
    """
    if table_exists(spark, name):
        log.warning("materialized view %s already exists", name)
        return False
    loc = f" LOCATION {sql_string(path)}" if path else ""
    spark.sql(f"CREATE TABLE {quote_table(name)} USING {format}{loc} "
              f"TBLPROPERTIES ({ddl_properties({PROP_MATVIEW_QUERY: query})}) AS {query}")
    return True


def refresh_materialized_view(spark: SparkSession, name: str) -> None:
    """Bring a stored view up to date; the old rows stay until the new ones are written.

    A query is computed again as a whole, an incremental view from the source
    partitions that changed.
    """
    from .incremental import PROP_INCREMENTAL, refresh_incremental_view
    props = table_properties(spark, name)
    if PROP_INCREMENTAL in props:
        refresh_incremental_view(spark, name)
        return
    query = props.get(PROP_MATVIEW_QUERY)
    if query is None:
        raise ValueError(f"{name} is not a materialized view")
    overwrite_all(spark, name, lambda staging: spark.sql(query).write.insertInto(staging, overwrite=True))


# ---------------------------------------------------------------- snapshots

def create_snapshot(spark: SparkSession, base: str, name: str, *,
                    as_of: dt.datetime | None = None, format: str = "parquet",
                    path: str | None = None, copy: bool = False) -> bool:
    """Keep the current rows of ``base`` under ``name``, partitioned and clustered like it.

    The files of a table with a path of its own are shared, not copied: the
    snapshot is a list of their names (a small table at ``path``), an entry over
    the folders they are in, and a view of the rows of exactly those files, so
    rows appended to the folders later do not show. A note beside the base's
    folder says which folders are read, and replacements, expiry and the end of
    the base leave them until `drop_snapshot`. An append that is being committed
    at that very moment may be in it in part, as for any reader of the table.

    ``copy=True`` writes the rows anew (in ``format``), as is always done for
    views and for managed tables, whose files go with their catalog entry.
    """
    if table_exists(spark, name):
        log.warning("snapshot %s already exists", name)
        return False
    when = (as_of or dt.datetime.now(dt.timezone.utc)).isoformat()
    d = table_layout(spark, base)
    told = {PROP_SNAPSHOT_OF: base, PROP_SNAPSHOT_TIME: when}
    if not copy and d["external"] and d["properties"].get(PROP_EXTERNAL) != "true" and d["format"].lower() in FILE_FORMATS:
        for _ in range(5):
            try:
                _share(spark, base, name, path, told)
                return True
            except versions.ConcurrentWrite:
                log.warning("%s changed while %s was taken; once more", base, name)
        raise versions.ConcurrentWrite(f"{base} keeps changing; snapshot {name} was not taken")
    create_table(spark, name, data_schema(spark, base), partitioning=d["spec"], clustering=d["clustering"],
                 description=d["description"], format=format, path=path, properties=told)
    rows = spark.table(base)
    if d["spec"] is not None:
        rows = rows.hint("rebalance", F.col(quote_ident(d["spec"].partition_column)))
    rows.write.insertInto(name, overwrite=True)
    return True


def _beside(name: str) -> tuple[str, str]:
    """Tables a shared snapshot is made of: the entry over the folders, and the list of files."""
    return f"{name}__folders", f"{name}__files"


def _share(spark: SparkSession, base: str, name: str, path: str | None, told: Mapping[str, str]) -> None:
    state = versions.begin(spark, base)
    d = table_layout(spark, base)
    spec = d["spec"]
    parts = partition_texts(spark, base) if spec is not None else []
    folders = [state.folder_of(p) for p in parts] if spec is not None else [state.location]
    entry, names = _beside(name)
    note = versions.refer(spark, state, folders, name)
    listed = path or f"{state.home}__refs/{uuid.uuid4().hex}_files"
    made = []
    try:
        columns = ddl_columns(spark.table(base).schema)
        sql = [f"CREATE TABLE {quote_table(entry)} ({columns}) USING {d['format']}"]
        if d["options"]:
            sql.append(f"OPTIONS ({ddl_properties(d['options'])})")
        if spec is not None:
            sql.append(f"PARTITIONED BY ({quote_ident(spec.partition_column)})")
        spark.sql(" ".join([*sql, f"LOCATION {sql_string(state.location)}"]))
        made.append(entry)
        for i in range(0, len(parts), versions.CHUNK):
            spark.sql(f"ALTER TABLE {quote_table(entry)} ADD " + " ".join(
                f"PARTITION ({partition_clause(spec, p)}) LOCATION {sql_string(state.folder_of(p))}"
                for p in parts[i:i + versions.CHUNK]))
        versions.files_of(spark, folders).select("name", "length", "modified").write.parquet(listed)
        spark.sql(f"CREATE TABLE {quote_table(names)} USING parquet LOCATION {sql_string(listed)}")
        made.append(names)
        # a bound that Spark applies while it lists: files added later are not even opened
        newest = spark.table(names).agg(F.max(F.unix_micros("modified"))).first()[0] or 0
        props = settings_properties(
            partitioning=spec, clustering=d["clustering"], require_partition_filter=False, friendly_name=None, labels=None,
            location=None, expiration_time=None,
            extra={**told, PROP_SNAPSHOT_NOTE: note, PROP_SNAPSHOT_LIST: listed})
        wanted = ", ".join(quote_ident(c) for c in spark.table(base).columns)
        comment = f" COMMENT {sql_string(d['description'])}" if d["description"] else ""
        spark.sql(f"CREATE VIEW {quote_table(name)}{comment} TBLPROPERTIES ({ddl_properties(props)}) AS "
                  f"SELECT {wanted} FROM {quote_table(entry)} WHERE _metadata.file_modification_time <= "
                  f"timestamp_micros({newest}) AND _metadata.file_name IN (SELECT name FROM {quote_table(names)})")
    except BaseException:
        for t in made:
            spark.sql(f"DROP TABLE IF EXISTS {quote_table(t)}")
        delete_folder(spark, listed)
        versions.forget(spark, note, versions.in_use(spark, base))
        raise


def drop_snapshot(spark: SparkSession, name: str) -> None:
    """Drop a snapshot, and the files that it alone still read."""
    props = table_properties(spark, name)
    if PROP_SNAPSHOT_OF not in props:
        raise ValueError(f"{name} is not a snapshot")
    if PROP_SNAPSHOT_NOTE not in props:
        d = table_layout(spark, name)
        spark.sql(f"DROP TABLE {quote_table(name)}")
        if d["external"]:
            delete_folder(spark, d["location"])
        return
    spark.sql(f"DROP VIEW {quote_table(name)}")
    for t in _beside(name):
        spark.sql(f"DROP TABLE IF EXISTS {quote_table(t)}")
    delete_folder(spark, props[PROP_SNAPSHOT_LIST])
    base = props[PROP_SNAPSHOT_OF]
    # a table of that name that now lives elsewhere reads none of these folders
    used = versions.in_use(spark, base) if table_exists(spark, base) else []
    versions.forget(spark, props[PROP_SNAPSHOT_NOTE], used)
