"""Plan inspection: check that reads and codecs stay in Catalyst's hands."""

from .inspect import executed_plan, python_or_rdd_nodes, pushed_filters, read_schemas

__all__ = ["executed_plan", "python_or_rdd_nodes", "pushed_filters", "read_schemas"]
