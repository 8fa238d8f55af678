"""Read facts off a physical plan (``explain("formatted")`` text).

Used by the tests to hold the plans to what the design promises: pruned
scans, pushed filters, a single scan where one suffices, top-k without a
full sort, no Python on the data path.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_PYTHON_NODES = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "MapInArrow",
    "PythonUDF",
)


def formatted_plan(df: DataFrame) -> str:
    """The text of ``df.explain(mode="formatted")``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scan_count(plan: str, source: str = "parquet") -> int:
    """Number of file scans of ``source`` (subqueries included)."""
    return len(re.findall(rf"^\(\d+\) Scan {source}", plan, flags=re.M))


def read_schemas(plan: str) -> list[set[str]]:
    """Column names of each scan's ``ReadSchema``."""
    out = []
    for m in re.finditer(r"^ReadSchema: struct<(.*)>$", plan, flags=re.M):
        out.append({part.split(":", 1)[0] for part in re.split(r",(?![^<]*>)", m.group(1))})
    return out


def pushed_filters(plan: str) -> list[str]:
    """The ``PushedFilters`` list of each scan."""
    return re.findall(r"^PushedFilters: \[(.*)\]$", plan, flags=re.M)


def has_python(plan: str) -> bool:
    """Whether any Python evaluation node is in the plan."""
    return any(node in plan for node in _PYTHON_NODES)


def has_node(plan: str, node: str) -> bool:
    """Whether a plan node of that name appears."""
    return re.search(rf"\b{re.escape(node)}\b", plan) is not None
