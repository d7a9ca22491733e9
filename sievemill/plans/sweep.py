"""The whole sweep of a capped source as one table of events.

Dates are halved, a saturated day is split by class, a saturated class is
covered by filters. The three steps are set operations: which windows are
visited follows from counts and from the windows above them. Walk order is the
order of ``path``: the digits of the halvings (later half first), then the
class's place behind a solidus.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.plans.cascade import EPOCH, class_leaves, cover, day_counts, halving_tree, window_counts
from sievemill.schemas import CAP, FILTERS, FINAL_EVENTS
from sievemill.session import cut

EVENT = ["type", "from_day", "to_day", "class_id", "depth", "path", "n", "split_by", "filters_tried", "union_size", "message"]
TREE = "lo int, hi int, depth int, path string, plo int, phi int"


def _iso(day: Column) -> Column:
    return F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd")


def _stops(covered: DataFrame | None, rejected: DataFrame | None) -> DataFrame | None:
    """Windows that aren't searched or are refused: ``from_day, to_day, class_id, stop, message``; skipping comes first."""
    parts = []
    if covered is not None:
        parts.append(covered.select("from_day", "to_day", "class_id", F.lit("skipped").alias("stop"), F.lit(None).cast("string").alias("message")))
    if rejected is not None:
        parts.append(rejected.select("from_day", "to_day", "class_id", F.lit("rejected").alias("stop"), "message"))
    if not parts:
        return None
    each = reduce(DataFrame.unionByName, parts)
    first = F.max_by(F.struct("stop", "message"), F.col("stop"))  # "skipped" is the larger word
    return each.groupBy("from_day", "to_day", "class_id").agg(first.alias("s")).select("from_day", "to_day", "class_id", "s.stop", "s.message")


def _stopped(windows: DataFrame, stops: DataFrame | None) -> DataFrame:
    """Windows with the ``stop`` and ``message`` of exactly theirs, null without one."""
    if stops is None:
        return windows.withColumns({"stop": F.lit(None).cast("string"), "message": F.lit(None).cast("string")})
    s = stops.select(F.col("from_day").alias("__f"), F.col("to_day").alias("__t"), F.col("class_id").alias("__c"), "stop", "message")
    same = (F.col("from_day") == F.col("__f")) & (F.col("to_day") == F.col("__t")) & F.col("class_id").eqNullSafe(F.col("__c"))
    return windows.join(s, same, "left").drop("__f", "__t", "__c")


def choose_strategy(from_day: Column, to_day: Column, class_id: Column, with_classes: bool = True) -> Column:
    """The first strategy that can split a window: date, then class; null if none can."""
    single = from_day == to_day
    chain = F.when(~single, "date")
    return chain.when(single & class_id.isNull(), "class") if with_classes else chain


def sweep(
    rows: DataFrame, day: Column, class_id: Column, number: Column, name: Column, catalog: DataFrame | None, cap: int = CAP,
    filters: list[str] | None = None, plateau: int = 5, most: int | None = None, covered: DataFrame | None = None,
    rejected: DataFrame | None = None, rejected_filters: list[str] | None = None, seen: DataFrame | None = None, with_cover: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The events of a sweep and the rows it lists: (events, listed).

    Events: ``type`` (window, capped, unsplittable, covered, abandoned,
    skipped, rejected), ``from_day, to_day, class_id, depth, path, n, rows,
    split_by, filters_tried, union_size, message, requests``. ``n`` is the
    window's true count, null where it wasn't searched; ``rows`` how many of
    its rows are listed for the first time. Listed: ``number, path, ord``,
    each number under the first final event that shows it, ``ord`` being the
    filter that did (0 for the window itself); numbers of ``seen`` are left
    out. Capped windows list nothing: their children do.

    ``covered`` (``from_day, to_day, class_id``) are windows done before: one
    is skipped if it is met, with everything below it. ``rejected`` has a
    ``message`` too: the source refuses these. Without a ``catalog`` days
    aren't split, without ``with_cover`` saturated leaves are unsplittable.
    Rows without a day or number are never found. Rows of a class that the
    catalog lacks are lost below a saturated day, as they would be.
    """
    spark = rows.sparkSession
    base = rows.select(F.unix_date(day.cast("date")).alias("day"), class_id.alias("class_id"), number.alias("number"), name.alias("name")).where("day is not null and number is not null")
    stops = _stops(covered, rejected)
    counts = cut(day_counts(rows.where(number.isNotNull()), day))
    ends = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    tree = spark.createDataFrame(halving_tree(ends["lo"], ends["hi"]) if ends["lo"] is not None else [], TREE)
    met = window_counts(tree, counts).where(F.col("plo").isNull() | (F.col("pn") >= cap))
    met = met.select("lo", "hi", "depth", "path", "n", _iso(F.col("lo")).alias("from_day"), _iso(F.col("hi")).alias("to_day"), F.lit(None).cast("string").alias("class_id"))
    met = cut(_stopped(met, stops))
    # The windows above a window are the beginnings of its path.
    above = met.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.greatest("depth", F.lit(1))), lambda i: F.substring("path", F.lit(1), i - 1))).alias("__above")).where("depth > 0")
    ended = met.where("stop is not null").select(F.col("path").alias("__above"))
    met = met.join(above.join(ended, "__above", "left_semi").select("path").distinct(), "path", "left_anti")
    searched = F.col("stop").isNull()
    full = searched & (F.col("n") >= cap)
    chosen = choose_strategy(F.col("from_day"), F.col("to_day"), F.col("class_id"), catalog is not None)
    kind = F.col("stop")
    dated = cut(met.withColumn("split_by", F.when(full, chosen)).withColumn("type", F.when(~searched, kind).when(~full, "window").when(F.col("split_by").isNotNull(), "capped").otherwise("leaf")))
    windows = dated.where("type <> 'leaf'").select("type", "from_day", "to_day", "class_id", "depth", "path", F.when(searched, F.col("n")).alias("n"), "split_by", "message", "lo", "hi")
    leaves = dated.where("type = 'leaf'")
    if catalog is None:
        leaf_rows = base.join(leaves.select(F.col("lo").alias("day"), "path"), "day")
        of_class = None
    else:
        days = dated.where("split_by = 'class'").select(F.col("lo").alias("day"), "path", "depth", "from_day")
        children = class_leaves(days, catalog).select(
            "day", "class_id", F.col("from_day"), F.col("from_day").alias("to_day"), (F.col("depth") + 1).alias("depth"),
            F.concat("path", F.lit("/"), F.lpad(F.col("ord").cast("string"), 6, "0")).alias("path"),
        )
        sizes = base.join(days.select("day"), "day", "left_semi").groupBy("day", "class_id").agg(F.count(F.lit(1)).alias("n"))
        children = _stopped(children.join(sizes, ["day", "class_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")), stops)
        children = cut(children.withColumn("type", F.when(~searched, kind).when(~full, "window").otherwise("leaf")))
        of_class = children.where("type <> 'leaf'").select("type", "from_day", "to_day", "class_id", "depth", "path", F.when(searched, F.col("n")).alias("n"), F.lit(None).cast("string").alias("split_by"), "message", "day")
        leaves = children.where("type = 'leaf'")
        leaf_rows = base.join(leaves.select("day", "class_id", "path"), ["day", "class_id"])
    heads = leaves.select("path", "from_day", "to_day", "class_id", "depth", "n")
    found = []
    if with_cover:
        ends_, shown = cover(leaf_rows, ["path"], "number", "name", FILTERS if filters is None else filters, cap, plateau, most, rejected_filters)
        leaf_events = heads.join(ends_, "path").select(F.col("kind").alias("type"), "from_day", "to_day", "class_id", "depth", "path", "n", "filters_tried", "union_size")
        found.append(shown.select("path", "ord", "number"))
    else:
        leaf_events = heads.select(F.lit("unsplittable").alias("type"), "from_day", "to_day", "class_id", "depth", "path", "n", F.lit(None).cast("int").alias("filters_tried"), F.lit(None).cast("bigint").alias("union_size"))
        lowest = Window.partitionBy("path").orderBy("number")
        found.append(leaf_rows.withColumn("__rank", F.row_number().over(lowest)).where(F.col("__rank") <= cap).select("path", F.lit(0).alias("ord"), "number"))
    none = {"filters_tried": F.lit(None).cast("int"), "union_size": F.lit(None).cast("bigint")}
    parts = [windows.withColumns(none).select(*EVENT)]
    if of_class is not None:
        parts.append(of_class.withColumns(none).select(*EVENT))
        found.append(base.join(of_class.where("type = 'window'").select("day", "class_id", "path"), ["day", "class_id"]).select("path", F.lit(0).alias("ord"), "number"))
    parts.append(leaf_events.withColumns({"split_by": F.lit(None).cast("string"), "message": F.lit(None).cast("string")}).select(*EVENT))
    # A final window of days: each of its days belongs to it alone. There are no more of them than days.
    spread = windows.where("type = 'window'").select("path", F.explode(F.sequence("lo", "hi")).alias("day"))
    found.append(base.join(spread, "day").select("path", F.lit(0).alias("ord"), "number"))
    first = reduce(DataFrame.unionByName, found).groupBy("number").agg(F.min(F.struct("path", "ord")).alias("m")).select("number", "m.path", "m.ord")
    listed = cut(first if seen is None else first.join(seen.select("number").distinct(), "number", "left_anti"))
    fresh = listed.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    final = F.col("type").isin(*FINAL_EVENTS)
    requests = F.when(F.col("type") == "skipped", 0).otherwise(F.coalesce("filters_tried", F.lit(0)) + 1)
    events = reduce(DataFrame.unionByName, parts).join(fresh, "path", "left").withColumn("rows", F.when(final, F.coalesce("rows", F.lit(0)).cast("bigint"))).withColumn("requests", requests.cast("bigint"))
    return events, listed


def class_check(events: DataFrame, cap: int = CAP) -> DataFrame:
    """For each day split by class whether its classes list at least ``cap`` rows: ``path, from_day, children_rows, ok``.

    ``ok`` is null where a class wasn't searched or was refused.
    """
    split = events.where("split_by = 'class'").select("path", "from_day")
    children = events.where(F.contains("path", F.lit("/"))).select(F.split_part("path", F.lit("/"), F.lit(1)).alias("path"), "type", "rows")
    sums = children.groupBy("path").agg(F.sum("rows").alias("children_rows"), F.bool_and(F.col("type").isin(*FINAL_EVENTS)).alias("whole"))
    return split.join(sums, "path").select("path", "from_day", F.coalesce("children_rows", F.lit(0)).alias("children_rows"), F.when(F.col("whole"), F.coalesce("children_rows", F.lit(0)) >= cap).alias("ok"))


def exact_day(day: str) -> int:
    """An ISO day as days since 1970."""
    return (dt.date.fromisoformat(day) - EPOCH).days
