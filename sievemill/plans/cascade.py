"""The saturating-window cascade, set by set.

A window that shows as many rows as the cap is split: by halving its dates,
a single day by class, a single class by overlapping filters until they stop
finding new rows. The halving tree depends on the first and last day only, so
it is laid out once; a window is visited if and only if its parent's count
reaches the cap. No step iterates over data on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.functions.scalars import matches_filter
from sievemill.session import cut

EPOCH = dt.date(1970, 1, 1)
#: Up to so many classes the catalog goes to the days as a broadcast.
SHARED_CLASSES = 10_000


def halving_tree(lo: int, hi: int) -> list[tuple[int, int, int, str, int | None, int | None]]:
    """All windows of the halving of [lo, hi]: lo, hi, depth, path, parent's lo and hi.

    The earlier half gets the odd day. In a path 0 is the later half and 1 the
    earlier, so paths sort in the order of the walk, later half first. There
    are at most twice as many windows as days.
    """
    out, stack = [], [(lo, hi, 0, "", None, None)]
    while stack:
        a, b, depth, path, pa, pb = stack.pop()
        out.append((a, b, depth, path, pa, pb))
        if a < b:
            mid = a + (b - a) // 2
            stack += [(a, mid, depth + 1, path + "1", a, b), (mid + 1, b, depth + 1, path + "0", a, b)]
    return out


def day_counts(rows: DataFrame, day: Column) -> DataFrame:
    """Rows per day (days since 1970), pre-aggregated before the shuffle."""
    return rows.groupBy(F.unix_date(day.cast("date")).alias("day")).agg(F.count(F.lit(1)).alias("n")).where("day is not null")


def date_cascade(rows: DataFrame, day: Column, cap: int, skip: DataFrame | None = None) -> DataFrame:
    """Each visited window: ``from_day, to_day, depth, path, n, shown, kind``.

    ``kind`` is window (final), capped (split by date) or saturated (a single
    day that has to be split otherwise). A window of ``skip`` (``from_day,
    to_day``) is not searched and cuts its subtree. An empty table has no windows.
    """
    spark = rows.sparkSession
    counts = day_counts(rows, day)
    ends = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    schema = "lo int, hi int, depth int, path string, plo int, phi int"
    if ends["lo"] is None:
        tree = spark.createDataFrame([], schema)
    else:
        tree = spark.createDataFrame(halving_tree(ends["lo"], ends["hi"]), schema)
    return _visited(tree, counts, cap, skip)


def window_counts(tree: DataFrame, counts: DataFrame) -> DataFrame:
    """The windows of a tree with ``n``, their rows, and ``pn``, those of their parent."""
    # A running total over the days that occur; the calendar bounds its size, not the data.
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(F.col("day"), F.sum("n").over(upto).alias("cum"))
    marks = tree.select(F.col("hi").alias("at")).union(tree.select((F.col("lo") - 1).alias("at"))).distinct()
    # The total at any bound: the last known total on or before it.
    both = marks.select("at", F.lit(None).cast("bigint").alias("cum"), F.lit(1).alias("q")).union(sums.select("day", "cum", F.lit(0)))
    carry = Window.orderBy("at", "q").rowsBetween(Window.unboundedPreceding, 0)
    totals = both.select("at", "q", F.coalesce(F.last("cum", ignorenulls=True).over(carry), F.lit(0)).alias("cum")).where("q = 1").select("at", "cum")
    to, before = totals.select(F.col("at").alias("hi"), F.col("cum").alias("c1")), totals.select((F.col("at") + 1).alias("lo"), F.col("cum").alias("c0"))
    counted = tree.join(to, "hi").join(before, "lo").select("lo", "hi", "depth", "path", "plo", "phi", (F.col("c1") - F.col("c0")).alias("n"))
    parents = counted.select(F.col("lo").alias("plo"), F.col("hi").alias("phi"), F.col("n").alias("pn"))
    return counted.join(parents, ["plo", "phi"], "left")


def _visited(tree: DataFrame, counts: DataFrame, cap: int, skip: DataFrame | None) -> DataFrame:
    visited = window_counts(tree, counts).where(F.col("plo").isNull() | (F.col("pn") >= cap))
    if skip is not None:
        # The windows above a window are the beginnings of its path; those skipped end what is below them.
        day = lambda c: F.unix_date(F.col(c).cast("date"))
        ended = visited.join(skip.select(day("from_day").alias("lo"), day("to_day").alias("hi")).distinct(), ["lo", "hi"], "left_semi").select(F.col("path").alias("__above"))
        upper = visited.select("path", F.explode(F.transform(F.sequence(F.lit(0), F.col("depth")), lambda i: F.substring("path", F.lit(1), i))).alias("__above"))
        visited = visited.join(upper.join(ended, "__above", "left_semi").select("path").distinct(), "path", "left_anti")
    kind = F.when(F.col("n") < cap, "window").when(F.col("lo") < F.col("hi"), "capped").otherwise("saturated")
    iso = lambda c: F.date_format(F.date_from_unix_date(c), "yyyy-MM-dd")
    return visited.select(
        iso(F.col("lo")).alias("from_day"), iso(F.col("hi")).alias("to_day"), "depth", "path", "n",
        F.least("n", F.lit(cap).cast("bigint")).alias("shown"), kind.alias("kind"),
    )


def class_leaves(days: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each saturated day with each class of the catalog: the columns of ``days``, ``class_id, ord``.

    Every class is one search, so that is what a split by class asks for. A
    class listed twice counts once, at its first place. An empty catalog is
    an error: it would drop the days silently. The catalog is one row that
    holds all classes; days are as many as the calendar has.
    """
    classes = catalog.where("class_id is not null").groupBy("class_id").agg(F.min("ord").alias("ord"))
    entries = cut(classes.agg(F.sort_array(F.collect_list(F.struct("ord", "class_id"))).alias("__classes")).withColumn("__k", F.lit(1)))
    size = entries.select(F.size("__classes").alias("n")).first()["n"]
    if not size:
        raise ValueError("the class catalog is empty")
    listed = days.withColumn("__k", F.lit(1)).join(F.broadcast(entries) if size <= SHARED_CLASSES else entries, "__k")
    return listed.select(*days.columns, F.explode("__classes").alias("__e")).select(*days.columns, "__e.class_id", "__e.ord")


def class_split(rows: DataFrame, day: Column, class_id: Column, catalog: DataFrame, cap: int) -> DataFrame:
    """The classes of each saturated day: ``day, class_id, ord, n, shown, kind``.

    Classes without rows stay. ``kind`` is window or saturated.
    """
    base = rows.select(F.date_format(day, "yyyy-MM-dd").alias("day"), class_id.alias("class_id"))
    counts = base.groupBy("day", "class_id").agg(F.count(F.lit(1)).alias("n"))
    days = counts.groupBy("day").agg(F.sum("n").alias("day_n")).where(F.col("day_n") >= cap).select("day")
    found = class_leaves(days, catalog).join(counts, ["day", "class_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    kind = F.when(F.col("n") < cap, "window").otherwise("saturated")
    return found.select("day", "class_id", "ord", "n", F.least("n", F.lit(cap).cast("bigint")).alias("shown"), kind.alias("kind"))


def cover(
    rows: DataFrame, leaf: list[str], number: str, name: str, filters: list[str], cap: int, plateau: int, most: int | None = None, rejected: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cover saturated leaves by overlapping filters: (events, found rows).

    ``rows`` are the rows of the saturated leaves. Each filter shows its lowest
    ``cap`` matches. A filter that adds a number to the union (the unfiltered
    rows come first) resets the streak; one that adds none and isn't capped
    adds to it; a capped one without news leaves it. The cover ends at a
    streak of ``plateau`` (covered) or after ``most`` filters (abandoned). A
    filter the source refuses (``rejected``) is tried and tells nothing.
    Events: ``leaf, kind, filters_tried, union_size``. Found rows: ``leaf,
    number, ord``, each number under the first filter that listed it.
    """
    most = len(filters) if most is None else most
    if plateau < 1 or most < plateau:
        raise ValueError("plateau must be at least 1 and at most the number of filters")
    used, refused = filters[:most], set(rejected or ())
    base = rows.select(*leaf, F.col(number).alias("number"), F.col(name).alias("name"))
    tried = F.array(F.struct(F.lit(0).alias("ord"), F.lit(None).cast("string").alias("filter")), *(F.struct(F.lit(k + 1).alias("ord"), F.lit(f).alias("filter")) for k, f in enumerate(used) if f not in refused))
    met = F.filter(tried, lambda t: t["filter"].isNull() | matches_filter(F.col("name"), t["filter"]))
    listed = base.select(*leaf, "number", F.explode(met["ord"]).alias("ord"))
    # The lowest rows are taken with a limit that Spark applies before the shuffle too; sizes are counted apart.
    per = Window.partitionBy(*leaf, "ord").orderBy("number")
    shown = listed.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= cap)
    firsts = cut(shown.groupBy(*leaf, "number").agg(F.min("ord").alias("ord")))
    news = firsts.groupBy(*leaf, "ord").agg(F.count(F.lit(1)).alias("news"))
    sizes = listed.groupBy(*leaf, "ord").agg(F.count(F.lit(1)).alias("n"))
    leaves = base.select(*leaf).distinct()
    grid = leaves.select(*leaf, F.explode(F.array(*(F.lit(k) for k in range(most + 1)))).alias("ord"))
    steps = grid.join(news, [*leaf, "ord"], "left").join(sizes, [*leaf, "ord"], "left").na.fill(0, ["news", "n"])
    walk = Window.partitionBy(*leaf).orderBy("ord")
    isle = steps.withColumn("isle", F.sum(F.when(F.col("news") > 0, 1).otherwise(0)).over(walk))
    heard = ~F.col("ord").isin(*(k + 1 for k, f in enumerate(used) if f in refused)) if refused & set(used) else F.lit(True)
    silent = (F.col("news") == 0) & (F.col("n") < cap) & (F.col("ord") > 0) & heard
    streaks = isle.withColumn("streak", F.sum(F.when(silent, 1).otherwise(0)).over(Window.partitionBy(*leaf, "isle").orderBy("ord")))
    streaks = streaks.withColumn("union_size", F.sum("news").over(walk))
    stops = streaks.groupBy(*leaf).agg(F.min(F.when(F.col("streak") >= plateau, F.col("ord"))).alias("stop"))
    ends = stops.withColumn("filters_tried", F.coalesce("stop", F.lit(most)))
    sized = ends.join(streaks.select(*leaf, F.col("ord").alias("filters_tried"), "union_size"), [*leaf, "filters_tried"])
    events = sized.select(*leaf, F.when(F.col("stop").isNotNull(), "covered").otherwise("abandoned").alias("kind"), "filters_tried", "union_size")
    found = firsts.join(ends.select(*leaf, "filters_tried"), leaf).where(F.col("ord") <= F.col("filters_tried")).drop("filters_tried")
    return events, found


def first_listing(listings: DataFrame, number: str, path: list[str], seen: DataFrame | None = None) -> DataFrame:
    """Each number under the first final listing of the walk; numbers seen before are dropped."""
    row = F.struct(*listings.columns)
    first = listings.groupBy(F.col(number).alias("__n")).agg(F.min_by(row, F.struct(*path)).alias("r")).select("r.*")
    return first if seen is None else first.join(seen.select(number).distinct(), number, "left_anti")


def history_start(years: DataFrame, year: str, today: int, depth: int = 50) -> DataFrame:
    """The first year with rows, at least ``today - depth``; without any rows this year. One row: ``first_year``.

    One aggregate gives what a bisection over the years would narrow down to.
    """
    floor = F.lit(today - depth)
    first = F.min(F.when(F.col(year) <= today, F.col(year)))
    return years.agg(F.when(first.isNull(), F.lit(today)).otherwise(F.greatest(first, floor)).cast("int").alias("first_year"))
