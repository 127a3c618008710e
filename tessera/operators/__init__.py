"""Table-level operators: partitioning, table definition, views and snapshots."""

from .incremental import Measure, Refresh, create_incremental_view, refresh_incremental_view
from .partitioning import PartitionSpec, RangePartitioning, TimePartitioning
from .recluster import Reclustered, cluster_depth, recluster
from .summaries import candidate_files, summarise
from .tables import (apply_column_overrides, create_table, expire_partitions, expire_tables,
                     is_external, partition_spec_of, table_exists, table_properties,
                     update_table_schema)
from .versions import ConcurrentWrite, recover, references
from .views import (create_materialized_view, create_snapshot, create_view, drop_snapshot,
                    refresh_materialized_view, update_view)

__all__ = [
    "ConcurrentWrite", "Measure", "PartitionSpec", "RangePartitioning", "Reclustered", "Refresh", "TimePartitioning",
    "apply_column_overrides", "candidate_files", "cluster_depth", "create_incremental_view",
    "create_materialized_view", "create_snapshot", "create_table", "create_view", "drop_snapshot",
    "expire_partitions", "expire_tables", "is_external", "partition_spec_of", "recluster", "recover", "references",
    "refresh_incremental_view", "refresh_materialized_view", "summarise", "table_exists", "table_properties", "update_table_schema",
    "update_view",
]
