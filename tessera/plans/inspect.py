"""Read facts off a DataFrame's physical plan (no execution).

Used by the tests and the benchmark to show that encode/restore keep filter
pushdown, column pruning and codegen: no Python evaluation, no RDD detour.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_ROW_DETOUR = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF",
               "ExistingRDD", "DeserializeToObject", "SerializeFromObject", "MapPartitions")


def executed_plan(df: DataFrame) -> str:
    """Text of the physical plan Spark would run (``explain()`` output)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def python_or_rdd_nodes(df: DataFrame) -> list[str]:
    plan = executed_plan(df)
    return [n for n in _ROW_DETOUR if n in plan]


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", executed_plan(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)(?:,|\s|$)", executed_plan(df))
