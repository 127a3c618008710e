"""Sinks: writes into catalog tables, partition replace, archive copies."""

from .table import (WriteResult, archive_path, clustered, list_archives, read_archive, read_archive_as_of,
                    replace_partition, write_archive, write_table)

__all__ = ["WriteResult", "archive_path", "clustered", "list_archives", "read_archive", "read_archive_as_of",
           "replace_partition",
           "write_archive", "write_table"]
