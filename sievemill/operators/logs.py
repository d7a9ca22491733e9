"""Append-only logs whose state is derived when they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key, with ``first_seq``, the place at which the key was first seen.

    Listings come in the order of first_seq with the values of the last row.
    A maximum is taken before the shuffle, no rows are sorted. Null keys make
    one key.
    """
    row = F.struct(*log.columns)
    best = log.groupBy(F.col(key).alias("__key")).agg(F.max_by(row, F.col(seq)).alias("row"), F.min(seq).alias("first_seq"))
    return best.select("row.*", "first_seq")


def first_per_key(log: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    row = F.struct(*log.columns)
    return log.groupBy(F.col(key).alias("__key")).agg(F.min_by(row, F.col(order)).alias("row")).select("row.*")


def pending(queue: DataFrame, done: DataFrame, key: str, seq: str) -> DataFrame:
    """The latest queued row of each key that was never taken out.

    Time plays no role: a key that was taken out once stays out.
    """
    return latest_per_key(queue, key, seq).join(done.select(key).distinct(), key, "left_anti")


def retryable(ledger: DataFrame, key: str, seq: str, is_failure: Column, may_retry: Column) -> DataFrame:
    """The keys whose last record is a failure that may be tried again."""
    return latest_per_key(ledger, key, seq).where(is_failure & may_retry)


def seen_set(progress: DataFrame, numbers: str, is_final: Column) -> DataFrame:
    """All keys listed by final events, abandoned ones included."""
    return progress.where(is_final).select(F.explode(numbers).alias("number")).distinct()


def uncovered(windows: DataFrame, progress: DataFrame, key: list[str], is_final: Column) -> DataFrame:
    """The windows without a final event of exactly their key; null parts are equal to null parts."""
    done = progress.where(is_final).select(*(F.col(k).alias(f"__{k}") for k in key)).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return windows.join(done, same, "left_anti")
