"""Transform steps linked by ``after``, composed into one lazy DataFrame per target table."""

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..errors import DefinitionError
from ..operators import relational as R
from ..sources.tables import read_partition

# Transformations, and the snapshot that means the run-date partition.
TRANSFORMATIONS = ["select", "rename", "join", "filter"]
CURRENT_SNAPSHOT = "Currently"


def ordered(steps: Sequence[Mapping]) -> list[Mapping]:
    """Steps so that each follows the one it names; unknown ids, repeated ids and cycles are errors."""
    by_id = {s["id"]: s for s in steps}
    if len(by_id) != len(steps):
        raise DefinitionError("step ids repeat")
    unknown = sorted({s["after"] for s in steps if s.get("after")} - set(by_id))
    if unknown:
        raise DefinitionError(f"steps come after unknown steps: {unknown}")
    done: dict[str, Mapping] = {}
    while len(done) < len(steps):
        ready = [s for s in steps if s["id"] not in done and (not s.get("after") or s["after"] in done)]
        if not ready:
            raise DefinitionError("steps form a cycle")
        done.update((s["id"], s) for s in ready)
    return list(done.values())


def _pairs(text: str) -> dict[str, str]:
    return dict(part.strip().split(":", 1) for part in text.split(","))


def _names(text: str) -> list[str]:
    return [part.strip() for part in text.split(",")]


def run_steps(steps: Sequence[Mapping], sources: Mapping[str, DataFrame],
              run_date: dt.date | None = None) -> dict[str, DataFrame]:
    """Result of each step by its ``targetTable``.

    A step reads an earlier target or a source table. With ``snapshotDuration`` "Currently" the
    source is cut to the run-date partition. A join names its other side in the condition, as
    ``table.column``, or in ``joinTable``; ``joinAlias`` gives that side another name for later
    expressions. Nothing runs here: Spark plans each result as a whole.
    """
    tables: dict[str, DataFrame] = dict(sources)
    results: dict[str, DataFrame] = {}
    for step in ordered(steps):
        name, kind = step["sourceTable"], step["transformation"]
        if kind not in TRANSFORMATIONS:
            raise DefinitionError(f"{step['id']}: unknown transformation {kind!r}")
        if name not in tables:
            raise DefinitionError(f"{step['id']}: no table {name!r} yet")
        df = tables[name]
        if step.get("snapshotDuration") == CURRENT_SNAPSHOT:
            if run_date is None:
                raise DefinitionError(f"{step['id']}: a current snapshot needs a run date")
            df = read_partition(df, run_date, step.get("sourceTablePartitionField", "partition_dt"))
        results[step["targetTable"]] = tables[step["targetTable"]] = _apply(step, df, name, tables)
    return results


def _apply(step: Mapping, df: DataFrame, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    kind = step["transformation"]
    if kind == "select" and step.get("selectExpr"):
        return R.select_expr(df, _expressions(step["selectExpr"]))
    if kind == "select":
        return R.select(df, _names(step["sourceTableColumn"]))
    if kind == "rename":
        return R.rename(df, _pairs(step["sourceTableColumn"]))
    if kind == "filter":
        return R.filter_rows(df, step["condition"])
    other = step.get("joinTable") or next(
        (t for t in tables if t != name and re.search(rf"\b{re.escape(t)}\.", step.get("condition") or "")), None)
    if other is None or other not in tables:
        raise DefinitionError(f"{step['id']}: the join names no known table")
    how = step.get("joinType", "left")
    if how not in ("left", "inner"):
        raise DefinitionError(f"{step['id']}: unsupported join type {how!r}")
    join = R.join_left if how == "left" else R.join_inner
    if step.get("joinKeys"):
        return join(df, tables[other], on=_names(step["joinKeys"]), hot_share=step.get("hotShare"))
    right = tables[other].alias(step.get("joinAlias", other))
    return join(df.alias(name), right, step["condition"])


def _expressions(given: str | Sequence[str]) -> list[str]:
    """Select expressions: a list, or text split at the commas outside brackets and quotes."""
    if not isinstance(given, str):
        return list(given)
    parts = re.findall(r"(?:\([^()]*(?:\([^()]*\)[^()]*)*\)|'[^']*'|[^,'(])+", given)
    return [part.strip() for part in parts]
