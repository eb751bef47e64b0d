"""Plan inspection helpers (used by the plan-shape tests and for tuning)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

PYTHON_EVAL_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                     "MapInPandas", "PythonUDF")


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan text of ``df`` (what ``df.explain(mode)`` prints)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator name in the simple plan tree."""
    text = plan_string(df, "simple")
    return len(re.findall(rf"\b{re.escape(node)}\b", text))


def uses_python(df: DataFrame) -> bool:
    text = plan_string(df, "simple")
    return any(n in text for n in PYTHON_EVAL_NODES)


def exchanges(df: DataFrame) -> list[str]:
    """The Exchange lines of the simple plan (partitioning and origin)."""
    return [ln.strip() for ln in plan_string(df, "simple").splitlines() if "Exchange " in ln]
