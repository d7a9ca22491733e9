"""A source that shows at most a fixed number of rows per search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def capped_search(rows: DataFrame, window: list[str], number: list[str], cap: int, keep: list[str] | None = None) -> DataFrame:
    """The lowest ``cap`` rows of each window, with ``n`` and ``capped``.

    Rows are ranked by ``number``; ``n`` is the window's true count, which
    only the simulated source knows. The rank is taken with a limit that
    Spark pushes below the shuffle, so a window may hold any share of the rows.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(*window).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*window).orderBy(*number)
    top = rows.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= cap)
    return top.select(*window, *(keep or number), "__rank").withColumnRenamed("__rank", "rank").join(counts, window).withColumn("capped", F.col("n") >= cap)


def cap_signal(shown: Column, warned: Column, cap: int) -> Column:
    """Whether a response is capped, by its text, by its count, and whether the two disagree."""
    by_count = shown >= cap
    return F.struct((by_count | warned).alias("capped"), warned.alias("by_text"), by_count.alias("by_count"), (by_count != warned).alias("disagree"))
