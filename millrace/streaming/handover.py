"""State handed over from a batch to a stream, and looked into from outside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import JSON_FORMATS
from millrace.streaming.keyed import Fold, Folding, _folds, _sortable

class Handed(Folding):
    """Running aggregates whose state begins with results of rows that came before the stream."""

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update(tuple(initialState[f"s{i}"] for i in range(len(self.kinds))))


def continued_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Fold], known: DataFrame
) -> DataFrame:
    """``keyed.running_stream`` that goes on from ``known``: one row per key with the outputs so far.

    ``known`` is the result of a batch, such as ``aggregate.grouped``, over the rows that
    the stream does not bring. Spark takes it over once, with the first micro-batch; keys
    without new rows stay in state as well.
    """
    if not keys:
        raise ValueError("a stream without keys would keep all its state in one task")
    values, kinds, types = _folds(stream, outputs)
    ks = [f"k{i}" for i in range(len(keys))]
    columns = [F.col(c).alias(k) for c, k in zip(keys, ks)]
    columns += [F.to_json(F.struct(*stream.columns), JSON_FORMATS).alias("row")]
    columns += [_sortable(stream, c).alias(f"o{i}") for i, c in enumerate(order)]
    rows = stream.select(*columns, *[c.alias(n) for n, c in values.items()])
    state = known.select(
        *[F.col(c).cast(stream.schema[c].dataType).alias(k) for c, k in zip(keys, ks)],
        *[F.col(n).cast(t).alias(f"s{i}") for i, (n, t) in enumerate(types.items())],
    )
    processor = Handed(kinds, list(types.values()))
    processor.places = [f"o{i}" for i in range(len(order))]
    processor.names = ["row", *[f"r{i}" for i in range(len(types))]]
    schema = ", ".join(f"{n} {t}" for n, t in zip(processor.names, ["string", *types.values()], strict=True))
    found = rows.groupBy(*ks).transformWithState(processor, schema, "append", "none", state.groupBy(*ks))
    text = F.from_json("row", stream.schema, JSON_FORMATS).alias("row")
    return found.select(text, *[F.col(f"r{i}").alias(n) for i, n in enumerate(types)]).select("row.*", *types)


def state_now(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], outputs: Sequence[str], *, batch: int | None = None,
    operator: int = 0,
) -> DataFrame:
    """The aggregates that ``running_stream`` or ``continued_stream`` holds, one row per key.

    Read from the checkpoint, as of the last micro-batch or the one named.
    """
    read = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    if batch is not None:
        read = read.option("batchId", batch)
    rows = read.option("stateVarName", "state").load()
    held = [F.col("key").getField(f"k{i}").alias(k) for i, k in enumerate(keys)]
    return rows.select(*held, *[F.col("value").getField(f"s{i}").alias(n) for i, n in enumerate(outputs)])
