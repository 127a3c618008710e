"""Sources: catalog tables and external files."""

from .external import (ExternalData, HivePartitioning, TooManyBadRecords, choose_decimal_types,
                       define_external_table, read_external, read_external_table)
from .table import PartitionFilterRequired, preview, read_matching, read_raw, read_table

__all__ = [
    "ExternalData", "HivePartitioning", "PartitionFilterRequired", "TooManyBadRecords",
    "choose_decimal_types", "define_external_table", "preview", "read_external",
    "read_external_table", "read_matching", "read_raw", "read_table",
]
