"""Applying a stream of inserts, updates and deletes.

Equality deletes with sequence numbers: upserts and deletes are kept apart,
each with its sequence number; a reader takes the newest upsert of each key
and anti-joins it against deletes of the same key with a later number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def newest_upserts(changes: DataFrame, key: list[str], is_delete: Column, order: list[Column], arrival: str) -> DataFrame:
    """The newest upsert of each key: ``key``, ``__sn``, ``__arrival``.

    ``__sn`` is the sequence number, a struct of ``order``; nulls in it come
    first. A change delivered several times counts once, under its lowest
    ``arrival``. The maximum is pre-aggregated before the shuffle, so a key
    may hold any share of the changes.
    """
    sn = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    upserts = changes.where(~F.coalesce(is_delete, F.lit(False)))
    best = upserts.groupBy(*key).agg(F.max(F.struct(sn.alias("sn"), (-F.col(arrival)).alias("neg"))).alias("m"))
    return best.select(*key, F.col("m.sn").alias("__sn"), (-F.col("m.neg")).alias("__arrival"))


def newest_deletes(changes: DataFrame, key: list[str], is_delete: Column, order: list[Column]) -> DataFrame:
    """The newest delete of each key: ``key``, ``__del_sn``."""
    sn = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    return changes.where(F.coalesce(is_delete, F.lit(False))).groupBy(*key).agg(F.max(sn).alias("__del_sn"))


def current_state(changes: DataFrame, key: list[str], is_delete: Column, order: list[Column], arrival: str) -> DataFrame:
    """The keys that exist after all changes, with the change that holds.

    Columns: ``key`` and ``arrival``, the lowest arrival number under which
    the newest change of the key was delivered. Changes of a key are ordered
    by ``order``, whatever order they arrive in; a delete with an equal number
    as an upsert doesn't undo it, and a delete of an absent key is no error.
    A null key is a key of its own. An empty feed gives an empty state.
    """
    live = newest_upserts(changes, key, is_delete, order, arrival).alias("u")
    gone = newest_deletes(changes, key, is_delete, order).alias("d")
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"u.{k}").eqNullSafe(F.col(f"d.{k}"))
    left = live.join(gone, same & (F.col("d.__del_sn") > F.col("u.__sn")), "left_anti")
    return left.select(*key, F.col("__arrival").alias(arrival))


@dataclass
class EqualityDeleteTable:
    """A table kept as append-only upsert and delete files.

    ``append`` writes one batch of changes under ``path``; a batch written
    again replaces itself, so a restarted job doesn't count it twice. ``read``
    gives the current rows, ``compact`` rewrites them as one batch.
    """

    spark: SparkSession
    path: str
    key: list[str]
    order: list[str]
    arrival: str

    def append(self, batch: int, changes: DataFrame, is_delete: Column) -> None:
        """Append one batch of changes; upserts and deletes go to separate files."""
        flagged = changes.withColumn("__delete", F.coalesce(is_delete, F.lit(False)))
        flagged.where("not __delete").drop("__delete").write.mode("overwrite").parquet(f"{self.path}/upserts/batch={batch}")
        flagged.where("__delete").select(*self.key, *self.order).write.mode("overwrite").parquet(f"{self.path}/deletes/batch={batch}")

    def read(self) -> DataFrame:
        """The current rows: the newest upsert of each key that no later delete undoes."""
        upserts = self.spark.read.parquet(f"{self.path}/upserts")
        deletes = self.spark.read.parquet(f"{self.path}/deletes")
        columns = [c for c in upserts.columns if c != "batch"]
        sn = F.struct(*(F.col(c) for c in self.order))
        newest = upserts.groupBy(*self.key).agg(
            F.max_by(F.struct(*(F.col(c) for c in columns)), F.struct(sn, -F.col(self.arrival))).alias("row"), F.max(sn).alias("__sn")
        )
        gone = deletes.groupBy(*self.key).agg(F.max(sn).alias("__del_sn"))
        newest, gone = newest.alias("u"), gone.alias("d")
        same = F.lit(True)
        for k in self.key:
            same = same & F.col(f"u.{k}").eqNullSafe(F.col(f"d.{k}"))
        return newest.join(gone, same & (F.col("d.__del_sn") > F.col("u.__sn")), "left_anti").select("row.*")

    def compact(self, batch: int, target: str) -> "EqualityDeleteTable":
        """Write the current rows as the only batch of a new table at ``target``.

        The newest delete of each key goes with them, so that an older change
        that arrives later doesn't bring the key back.
        """
        compacted = EqualityDeleteTable(self.spark, target, self.key, self.order, self.arrival)
        compacted.append(batch, self.read(), F.lit(False))
        deletes = self.spark.read.parquet(f"{self.path}/deletes")
        newest = deletes.groupBy(*self.key).agg(F.max(F.struct(*self.order)).alias("__sn")).select(*self.key, "__sn.*")
        newest.write.mode("overwrite").parquet(f"{target}/deletes/batch={batch}")
        return compacted
