"""tessera: move DataFrames in and out of catalog tables without losing data or metadata."""

from .functions import (TAG, conform_types, decimal_text, encode_wide_decimals,
                        restore_decimals)
from .operators import (ConcurrentWrite, Measure, PartitionSpec, RangePartitioning, TimePartitioning,
                        create_incremental_view, create_materialized_view, create_snapshot, create_table, create_view,
                        drop_snapshot, expire_partitions, expire_tables, recluster, refresh_incremental_view,
                        refresh_materialized_view, summarise, update_table_schema, update_view)
from .sinks import list_archives, read_archive, read_archive_as_of, replace_partition, write_table
from .sources import (ExternalData, HivePartitioning, define_external_table, preview,
                      read_external, read_matching, read_raw, read_table)

__all__ = [
    "TAG", "ConcurrentWrite", "ExternalData", "HivePartitioning", "Measure", "PartitionSpec", "RangePartitioning",
    "TimePartitioning", "conform_types", "create_incremental_view", "create_materialized_view", "create_snapshot",
    "create_table", "create_view", "decimal_text", "define_external_table", "drop_snapshot", "encode_wide_decimals",
    "expire_partitions", "expire_tables", "list_archives", "preview", "read_archive", "read_archive_as_of", "read_external", "read_matching",
    "read_raw", "read_table", "recluster", "refresh_incremental_view", "refresh_materialized_view", "replace_partition",
    "restore_decimals", "summarise", "update_table_schema", "update_view", "write_table",
]
