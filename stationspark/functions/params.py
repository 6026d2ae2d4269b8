"""Parameter checks, done while the plan is built (no Spark job runs).

Bad parameters raise ``ValueError``; errors from Spark propagate unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stationspark.sources import catalog


def check_state(state, known=None) -> str:
    """A non-empty state code; when ``known`` is given it must be in it."""
    if not isinstance(state, str) or not state.strip():
        raise ValueError("a state code is required")
    if known is not None and state not in known:
        raise ValueError(f"unknown state code {state!r}")
    return state


def check_month(month) -> int:
    if isinstance(month, bool) or not isinstance(month, int):
        raise ValueError(f"month must be an integer, got {month!r}")
    if not 1 <= month <= 12:
        raise ValueError(f"month must be within 1..12, got {month}")
    return month


def check_month_range(month_start, month_end) -> tuple[int, int]:
    a, b = check_month(month_start), check_month(month_end)
    if a > b:
        raise ValueError(f"month range {a}..{b}: start is after end")
    return a, b


def check_metric(df: DataFrame, kind: str, metric: str, in_catalog: bool = True) -> str:
    """``metric`` must be a column of ``df`` and (by default) in the catalog of ``kind``."""
    kind = catalog.kind_of(kind)
    if not isinstance(metric, str) or not metric:
        raise ValueError("a metric name is required")
    if in_catalog and metric not in catalog.METRICS[kind]:
        raise ValueError(f"{metric!r} is not a {kind} metric")
    if metric not in df.columns:
        raise ValueError(f"column {metric!r} not found in the {kind} data")
    return metric


def require_columns(df: DataFrame, kind: str, columns) -> None:
    """Every column a fixed-column question needs must be in the data."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the {kind} data lacks column(s) {missing}")


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def check_positive(name: str, value) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value
