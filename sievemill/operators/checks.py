"""Reconciliations, budgets and runs over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.session import cut


def page_plan(declared: Column, page_size: Column, pager_pages: Column) -> Column:
    """The number of pages: from the declared total where both are known, else the pager's."""
    return F.coalesce(F.ceil(declared / page_size).cast("bigint"), pager_pages.cast("bigint"))


def page_advanced(kind: Column, page: Column, page_size: Column, first_index: Column, slider_value: Column) -> Column:
    """Whether a fetched page is the one asked for; with nothing to read it is accepted."""
    scrolled = F.coalesce(first_index == (page - 1) * page_size, F.lit(True))
    slid = F.coalesce(slider_value == page, F.lit(True))
    return F.when(kind == "slider", slid).otherwise(scrolled)


def reconcile_pages(pages: DataFrame, keys: list[str], rows: str, declared: str) -> DataFrame:
    """Rows collected over all pages against the declared total: ``keys, pages, collected, declared, matches``."""
    out = pages.groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"), F.sum(rows).alias("collected"), F.max(declared).alias("declared"))
    return out.withColumn("matches", F.col("declared").isNull() | (F.col("declared") == F.col("collected")))


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows cut into ranges of their order, of about equal size: ``__range`` counts up with the order.

    Spark picks the bounds from a sample, so no range grows with a hot value
    as long as the order is nearly unique. Written once, since what follows
    reads it twice.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))


def running_totals(rows: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """The rows with the sum of each total over all rows before them in the order.

    Two levels: ranges of the order are summed, and the total within a range
    starts from the ranges before it, so no task sees more than its range.
    """
    ranged = in_ranges(rows.withColumns({f"__{k}": c for k, c in totals.items()}), order)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(*(F.sum(f"__{k}").alias(f"__{k}_s") for k in totals))
    # One row per range, as many as shuffle partitions.
    starts = starts.select("__range", *(F.coalesce(F.sum(f"__{k}_s").over(before), F.lit(0)).alias(f"__{k}_0") for k in totals))
    inner = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(starts), "__range")
    return out.select(*rows.columns, *((F.col(f"__{k}_0") + F.coalesce(F.sum(f"__{k}").over(inner), F.lit(0))).alias(k) for k in totals))


def within_budget(work: DataFrame, order: str, cost: Column, limit: int) -> DataFrame:
    """The units of work before the first one at which the running cost has reached the limit."""
    return running_totals(work, [order], {"spent_before": cost}).where(F.col("spent_before") < limit)


def hit_runs(rows: DataFrame, group: str, order: list[str], hit: Column) -> DataFrame:
    """Every maximal run of consecutive hits of a group: ``group, n``.

    Rows are cut into ranges of (group, order) and runs found within each;
    those that touch an end of their range are joined with their neighbours,
    of which a group has two per range at most. No task sorts a whole group.
    """
    marked = rows.select(F.col(group).alias("g"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.coalesce(hit, F.lit(False)).alias("hit"))
    keys = [f"o{i}" for i in range(len(order))]
    ranged = in_ranges(marked, ["g", *keys])
    own = Window.partitionBy("g", "__range").orderBy(*keys)
    isles = ranged.withColumn("misses", F.sum(F.when(F.col("hit"), 0).otherwise(1)).over(own))
    ends = ranged.groupBy("g", "__range").agg(F.count_if(~F.col("hit")).alias("all_misses"))
    runs = isles.where("hit").groupBy("g", "__range", "misses").agg(F.count(F.lit(1)).alias("n")).join(ends, ["g", "__range"])
    runs = runs.select("g", "__range", "n", (F.col("misses") == 0).alias("first"), (F.col("misses") == F.col("all_misses")).alias("last"))
    inside = runs.where("not first and not last").select("g", "n")
    edge = Window.partitionBy("g").orderBy("__range", F.col("first").desc())
    touching = runs.where("first or last")
    joined = F.col("first") & F.coalesce(F.lag("last").over(edge) & (F.lag("__range").over(edge) == F.col("__range") - 1), F.lit(False))
    chains = touching.withColumn("new", F.when(joined, 0).otherwise(1)).withColumn("chain", F.sum("new").over(edge))
    whole = chains.groupBy("g", "chain").agg(F.sum("n").alias("n")).select("g", "n")
    return inside.unionByName(whole).withColumnRenamed("g", group)


def longest_runs(rows: DataFrame, group: str, order: list[str], hit: Column, least: int) -> DataFrame:
    """Groups with a run of at least ``least`` consecutive hits: ``group, longest, trips``.

    ``trips`` says how many runs reached the limit, as a breaker would count.
    """
    out = hit_runs(rows, group, order, hit).groupBy(group).agg(F.max("n").alias("longest"), F.count_if(F.col("n") >= least).alias("trips"))
    return out.where(F.col("longest") >= least)


def class_split_check(children: DataFrame, day: str, shown: str, is_final: Column, cap: int) -> DataFrame:
    """Whether the classes of a saturated day show at least as many rows as the day did.

    A day with a child that isn't final is not judged.
    """
    out = children.groupBy(day).agg(F.sum(shown).alias("children_rows"), F.bool_and(is_final).alias("all_final"))
    return out.select(day, "children_rows", F.when(F.col("all_final"), F.col("children_rows") >= cap).alias("ok"))
