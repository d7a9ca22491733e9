"""References to records that don't exist.

Signed counts per key are maintained from deltas: +1 for each reference, +1
or -1 for each record that comes to exist or goes. Keys with references and
no existence are the orphan report; references of keys whose first record
came later than the reference are orphans of their time. ``ReferenceCounts``
keeps the counts between batches; deltas may come in any order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Signed counts of one key at one instant (microseconds): references made
#: then, records that came to exist then, and those of them that are gone.
STATE = "domain string, ref_key string, at bigint, is_ref boolean, refs bigint, made bigint, gone bigint"


def reference_deltas(domain: str, refs: DataFrame, key: Column, at: Column, sign: int = 1) -> DataFrame:
    """+1 reference per row, made at ``at`` (-1 to take it back); a null key refers to nothing and is left out."""
    return refs.select(
        F.lit(domain).alias("domain"), key.alias("ref_key"), at.cast("bigint").alias("at"), F.lit(True).alias("is_ref"),
        F.lit(sign).cast("bigint").alias("refs"), F.lit(0).cast("bigint").alias("made"), F.lit(0).cast("bigint").alias("gone"),
    ).where("ref_key is not null")


def existence_deltas(domain: str, records: DataFrame, key: Column, since: Column, removed: Column | None = None) -> DataFrame:
    """+1 existence per record since ``since``, and -1 where it has been ``removed``."""
    gone = F.lit(0) if removed is None else F.when(removed, 1).otherwise(0)
    return records.select(
        F.lit(domain).alias("domain"), key.alias("ref_key"), since.cast("bigint").alias("at"), F.lit(False).alias("is_ref"),
        F.lit(0).cast("bigint").alias("refs"), F.lit(1).cast("bigint").alias("made"), gone.cast("bigint").alias("gone"),
    ).where("ref_key is not null")


def removal_deltas(domain: str, records: DataFrame, key: Column, since: Column) -> DataFrame:
    """-1 existence per record that existed since ``since`` and was reported before."""
    return existence_deltas(domain, records, key, since, F.lit(True)).withColumn("made", F.lit(0).cast("bigint"))


def merge_deltas(deltas: list[DataFrame]) -> DataFrame:
    """The counts of any number of batches as one batch, of the same columns; rows are summed before the shuffle."""
    union = reduce(DataFrame.unionByName, deltas)
    return union.groupBy("domain", "ref_key", "at", "is_ref").agg(*(F.sum(c).alias(c) for c in ("refs", "made", "gone")))


def key_states(deltas: list[DataFrame]) -> DataFrame:
    """One row per domain and key: ``refs, made, gone, alive, first_at, ref_first``.

    ``first_at`` is the instant of the earliest record that still exists,
    ``ref_first`` that of the earliest reference. A removal must stand in one
    row with its record or be merged with it by :func:`merge_deltas` first.
    Rows are pre-aggregated before the shuffle, so a hot key costs one row
    per task.
    """
    union = reduce(DataFrame.unionByName, deltas)
    return union.groupBy("domain", "ref_key").agg(
        F.sum("refs").alias("refs"), F.sum("made").alias("made"), F.sum("gone").alias("gone"), (F.sum("made") - F.sum("gone")).alias("alive"),
        F.min(F.when(F.col("made") > F.col("gone"), F.col("at"))).alias("first_at"), F.min(F.when(F.col("refs") > 0, F.col("at"))).alias("ref_first"),
    )


@dataclass
class ReferenceCounts:
    """The signed counts of all keys, kept under ``path`` as one folder per batch of deltas.

    ``add`` sums a batch of deltas and appends it; a batch added again
    replaces itself, so a restarted job doesn't count it twice. ``read`` sums
    the batches, which may have come in any order. ``compact`` writes the sum
    as the only batch of a new state, without counts that have become zero.
    """

    spark: SparkSession
    path: str

    def add(self, batch: int, deltas: list[DataFrame]) -> None:
        merge_deltas(deltas).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        return merge_deltas([self.spark.read.schema(STATE).parquet(f"{self.path}/*")])

    def compact(self, target: str) -> "ReferenceCounts":
        kept = self.read().where("refs <> 0 or made <> 0 or gone <> 0")
        kept.write.mode("overwrite").parquet(f"{target}/batch=0")
        return ReferenceCounts(self.spark, target)

    def orphans(self) -> DataFrame:
        """The references without a valid target: ``domain, ref_key, ref_at, state, n`` (how many were made at that instant)."""
        state = self.read()
        refs = state.where("is_ref and refs > 0").select("domain", "ref_key", F.col("at").alias("ref_at"), F.col("refs").alias("n"))
        return orphan_rows(refs, key_states([state])).select("domain", "ref_key", "ref_at", "state", "n")


def orphan_rows(refs: DataFrame, states: DataFrame) -> DataFrame:
    """The references without a valid target, with their ``state``.

    ``refs`` has ``domain``, ``ref_key`` and ``ref_at`` (microseconds) beside
    any other columns. ``state`` is missing (no record ever existed), deleted
    (all are gone) or late (the earliest one that exists is younger than the
    reference). A reference or record without a readable instant is never
    late. Repeated references are reported each. Only keys that can be
    orphaned are joined: those without existence, or whose first record is
    younger than some reference to them.
    """
    orphaned = (F.col("made") == 0) | (F.col("alive") <= 0) | (F.col("first_at") > F.col("ref_first"))
    wanted = states.where((F.col("refs") > 0) & orphaned).select("domain", "ref_key", "made", "alive", "first_at")
    joined = refs.join(wanted, ["domain", "ref_key"])
    state = F.when(F.col("made") == 0, "missing").when(F.col("alive") <= 0, "deleted").when(F.col("first_at") > F.col("ref_at"), "late")
    return joined.withColumn("state", state).where("state is not null").drop("made", "alive", "first_at")


def month_utc(micros: Column) -> Column:
    """YYYY-MM of an instant in UTC, independent of the session's time zone."""
    days = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(86_400_000_000)).cast("int"))
    return F.date_format(days, "yyyy-MM")
