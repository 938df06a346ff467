"""Verdict on a changed query before it starts on an old checkpoint.

The checkpoint records its stateful operators with the columns of their keys and values, and
``runtime.start`` adds the output mode and the plan. The changed query is run once over no
rows on a scratch checkpoint, which writes the same records for it, and the two are compared:

* ``refused``: the start would fail (operators, or types of state columns, or the output mode);
* ``dangerous``: it would start and mix old state with a new meaning: a state column under
  another name (another aggregate of the same type, another key column), or another plan at or
  below a stateful operator (a filter, a window's width, a watermark);
* ``safe``: what differs, if anything, lies above the state.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rivulet.session import run_dir
from rivulet.sources import state
from rivulet.streaming import runtime

SAFE, REFUSED, DANGEROUS = "safe", "refused", "dangerous"
_STATEFUL = re.compile(r"^(Aggregate|Deduplicate|DeduplicateWithinWatermark|Join|TransformWithState|GlobalLimit)\b")


@dataclass(frozen=True)
class Finding:
    verdict: str
    what: str
    columns: tuple[str, ...] = ()


def state_layout(spark: SparkSession, checkpoint: str) -> dict[tuple, dict[str, list[tuple[str, str]]]]:
    """Columns (name, type) of key and value for every ``(operator, its name, store)``."""
    out = {}
    for r in state.read_state_metadata(spark, checkpoint).select("operatorId", "operatorName", "stateStoreName").distinct().collect():
        df = state.read_state(spark, checkpoint, r["operatorId"], r["stateStoreName"])
        fields = {f.name: f.dataType for f in df.schema}
        out[r["operatorId"], r["operatorName"], r["stateStoreName"]] = {
            side: [(f.name, f.dataType.simpleString()) for f in fields[side].fields] if isinstance(fields.get(side), T.StructType) else []
            for side in ("key", "value")}
    return out


def _compare(side: str, old: list[tuple[str, str]], new: list[tuple[str, str]]) -> list[Finding]:
    if old == new:
        return []
    if [t for _, t in old] == [t for _, t in new]:  # Spark compares types only
        names = [f"{a} -> {b}" for (a, _), (b, _) in zip(old, new) if a != b]
        return [Finding(DANGEROUS, f"state {side} holds another column of the same type", tuple(names))]
    changed = sorted(set(old) ^ set(new))
    return [Finding(REFUSED, f"state {side} has other columns", tuple(dict.fromkeys(n for n, _ in changed)))]


def _plans(old: list[str], new: list[str], columns: set[str]) -> list[Finding]:
    """Differences of the plans from the topmost stateful operator down."""
    def below(lines: list[str]) -> list[str]:
        at = next((i for i, x in enumerate(lines) if _STATEFUL.match(x)), len(lines))
        return lines[at:]

    a, b = below(old), below(new)
    if a == b:
        return [] if old == new else [Finding(SAFE, "the plan differs above the state only")]
    if not a and not b:
        return [Finding(SAFE, "the query keeps no state")]
    lines = [x for x in a if x not in b] + [x for x in b if x not in a]
    named = sorted({w for x in lines for w in re.findall(r"\w+", x)} & columns)
    return [Finding(DANGEROUS, "the plan differs below the state: " + " | ".join(lines), tuple(named))]


def verdict(spark: SparkSession, checkpoint: str, build: Callable[[DataFrame], DataFrame], schema: T.StructType,
            output_mode: str = "append", confs: dict[str, str] | None = None) -> list[Finding]:
    """What starting ``build`` (a query over a stream of ``schema``) on ``checkpoint`` would do."""
    recorded = runtime.recorded(spark, checkpoint)
    scratch = run_dir(spark, "change_verdict")
    spark.createDataFrame([], schema).write.parquet(f"{scratch}/in/none")
    df = build(spark.readStream.schema(schema).parquet(f"{scratch}/in/*"))
    try:
        runtime.run_to_end(df, f"{scratch}/checkpoint", output_mode=output_mode, confs=confs,
                           foreach_batch=lambda batch, _: batch.write.format("noop").mode("overwrite").save())
    except AnalysisException as e:
        return [Finding(REFUSED, str(e).splitlines()[0])]
    found = []
    if recorded.get("outputMode", output_mode) != output_mode:
        found.append(Finding(REFUSED, f"output mode {recorded['outputMode']} -> {output_mode}"))
    old, new = state_layout(spark, checkpoint), state_layout(spark, f"{scratch}/checkpoint")
    for side, other, word in ((old, new, "gone"), (new, old, "new")):
        found += [Finding(REFUSED, f"stateful operator {k[1]} ({k[2]}) is {word}") for k in sorted(side) if k not in other]
    for k in sorted(old.keys() & new.keys()):
        for side in ("key", "value"):
            found += _compare(side, old[k][side], new[k][side])
    if recorded.get("plan"):
        columns = {*df.columns, *schema.fieldNames()}
        found += [f for f in _plans(recorded["plan"], runtime.plan_lines(df), columns)
                  if f.verdict != DANGEROUS or not any(x.verdict != SAFE for x in found)]
    return found or [Finding(SAFE, "nothing that the state depends on has changed")]


def worst(findings: list[Finding]) -> str:
    return max((f.verdict for f in findings), key=[SAFE, DANGEROUS, REFUSED].index)
