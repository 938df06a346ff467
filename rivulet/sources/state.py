"""State store contents as DataFrames (for audits and state migration).

``read_state`` exposes a stateful operator's keys and values as a table (``key`` and
``value`` structs, plus ``partition_id``); ``read_variable`` does so for a named state variable
of a stateful processor; ``read_changes`` gives what batches changed in either;
``operators`` lists the stateful operators of a checkpoint with their variables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``transformWithState`` and its kin by the names that the state metadata gives them.
_PROCESSORS = "transformWithState"


def _reader(spark: SparkSession, operator_id: int, **options):
    r = spark.read.format("statestore").option("operatorId", operator_id)
    for name, value in options.items():
        if value is not None:
            r = r.option(name, value)
    return r


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0,
               store_name: str | None = None, batch_id: int | None = None) -> DataFrame:
    return _reader(spark, operator_id, storeName=store_name, batchId=batch_id).load(checkpoint)


def read_state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    return spark.read.format("state-metadata").load(checkpoint)


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operatorId, operatorName, numPartitions, minBatchId, maxBatchId, variables``: the
    stateful operators, with the names of a processor's state variables (else null)."""
    meta = read_state_metadata(spark, checkpoint)
    props = F.from_json("operatorProperties", "stateVariables array<struct<stateName string>>")
    return meta.select("operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId",
                       props["stateVariables"]["stateName"].alias("variables")).distinct()


def find_operator(spark: SparkSession, checkpoint: str, variable: str) -> int:
    """The operator that has a state variable of this name."""
    found = operators(spark, checkpoint).where(F.array_contains("variables", variable)).select("operatorId").distinct().collect()
    if len(found) != 1:
        raise ValueError(f"{len(found)} operators of {checkpoint} have a state variable {variable!r}")
    return int(found[0][0])


def read_variable(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None,
                  operator_id: int | None = None) -> DataFrame:
    """Rows of a named state variable: ``key`` with ``value``, or ``user_map_key`` and
    ``user_map_value`` of a map, or ``list_element`` of a list."""
    op = find_operator(spark, checkpoint, variable) if operator_id is None else operator_id
    return _reader(spark, op, stateVarName=variable, batchId=batch_id).load(checkpoint)


def read_changes(spark: SparkSession, checkpoint: str, first_batch: int, last_batch: int | None = None,
                 variable: str | None = None, operator_id: int | None = None) -> DataFrame:
    """What the batches ``first_batch`` to ``last_batch`` wrote: ``batch_id, change_type`` and the
    rows. Needs state kept with a changelog (``runtime.CHANGELOG``)."""
    op = operator_id if operator_id is not None else (find_operator(spark, checkpoint, variable) if variable else 0)
    return _reader(spark, op, stateVarName=variable, readChangeFeed="true", changeStartBatchId=first_batch,
                   changeEndBatchId=last_batch).load(checkpoint)
