"""Stateful deduplication, latest-wins and the failure state machine on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sievemill.operators.changes import EqualityDeleteTable


def first_seen(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key was never seen. Without a watermark the state never expires, as the meaning demands."""
    return stream.dropDuplicates(keys)


def upsert_into(table: EqualityDeleteTable, is_delete: str):
    """A foreachBatch function that appends each micro-batch once, by its batch number."""

    def write(batch: DataFrame, number: int) -> None:
        table.append(number, batch, F.expr(is_delete))

    return write


def open_failures(stream: DataFrame, key: str, kind: str, at: str, failure: str, success: str) -> DataFrame:
    """Each change of a key's state by its newest record: ``key, open, at``.

    State per key is the newest instant and whether it is a failure; a record
    older than the state changes nothing.
    """
    schema = f"{key} {stream.schema[key].dataType.simpleString()}, open boolean, at bigint"

    def step(ident: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, was_open = state.get if state.exists else (-(2**62), False)
        now = was_open
        for batch in batches:
            rows = batch[batch[kind].isin([failure, success])].sort_values(at, kind="mergesort")
            for k, t in zip(rows[kind], rows[at], strict=True):
                if t >= newest:
                    newest, now = int(t), k == failure
        state.update((newest, now))
        if now != was_open:
            yield pd.DataFrame({key: [ident[0]], "open": [now], "at": [newest]})

    return stream.groupBy(key).applyInPandasWithState(step, schema, "newest bigint, open boolean", "append", GroupStateTimeout.NoTimeout)
