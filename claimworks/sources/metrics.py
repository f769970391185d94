"""What a query read, from its executed plan."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame


def _scans(plan) -> Iterator:
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _scans(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _scans(plan.plan())
    elif kind == "FileSourceScanExec":
        yield plan
    elif kind != "ReusedExchangeExec":
        children = plan.children()
        for i in range(children.size()):
            yield from _scans(children.apply(i))


def rows_scanned(df: DataFrame, under: str) -> int:
    """Rows that the scans of files under that folder gave when ``df`` was run; its rows are only counted."""
    counted = df.groupBy().count()
    counted.collect()
    scans = _scans(counted._jdf.queryExecution().executedPlan())
    rows = [scan.metrics().get("numOutputRows") for scan in scans if under in scan.relation().location().rootPaths().mkString(",")]
    return sum(r.get().value() for r in rows if r.isDefined())
