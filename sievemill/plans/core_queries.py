"""Queries of the cascade, the logs and the reconciliations over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemill.functions import scalars as S
from sievemill.operators import checks, logs
from sievemill.plans import cascade, collection
from sievemill.schemas import CAP
from sievemill.session import scratch, table
from sievemill.sources import capped

#: Filters over the stand-in's text: two parts each, like those over names.
DIGIT_FILTERS = ["k 1", "k 2", "k 3", "k 4", "k 5", "k 6", "k 7", "k 8", "k 9", "k 0", "1 2", "3 4", "5 6", "7 8", "9 0"]


def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of one search window: an inclusive range of dates."""
    o = table(spark, sf, "orders")
    return o.where(F.col("o_orderdate").between(F.lit("1995-03-10").cast("timestamp_ntz"), F.lit("1995-03-14").cast("timestamp_ntz"))).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


def capped_topk(spark: SparkSession, sf: str) -> DataFrame:
    """What a capped search shows of each day: the lowest 30 and whether the cap was met."""
    rows = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey", "l_linenumber", "l_partkey")
    out = capped.capped_search(rows, ["day"], ["l_orderkey", "l_linenumber", "l_partkey"], CAP)
    return out.select("day", "l_orderkey", "l_linenumber", "l_partkey", "n", "capped")


def date_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Each window visited when orders are covered by halving their dates."""
    return cascade.date_cascade(table(spark, sf, "orders"), F.col("o_orderdate"), CAP)


def _catalog(rows: DataFrame, column: str) -> DataFrame:
    ids = rows.select(F.col(column).alias("class_id")).distinct()
    return ids.select("class_id", (F.dense_rank().over(Window.orderBy("class_id")) - 1).alias("ord"))


def class_split(spark: SparkSession, sf: str) -> DataFrame:
    """The classes of each saturated shipping day."""
    rows = table(spark, sf, "lineitem")
    return cascade.class_split(rows, F.col("l_shipdate"), F.col("l_returnflag"), _catalog(rows, "l_returnflag"), CAP)


def class_split_deep(spark: SparkSession, sf: str) -> DataFrame:
    """The classes of each saturated day of events; with more data they saturate as well."""
    rows = table(spark, sf, "events")
    return cascade.class_split(rows, F.col("ts"), F.col("event_type"), _catalog(rows, "event_type"), CAP)


def class_split_check(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the classes of a day show as many rows as the day did."""
    both = class_split(spark, sf).select(F.lit("lineitem").alias("src"), "day", "shown").union(class_split_deep(spark, sf).select(F.lit("events"), "day", "shown"))
    out = checks.class_split_check(both.withColumn("src_day", F.concat_ws(" ", "src", "day")), "src_day", "shown", F.lit(True), CAP)
    return out.select("src_day", F.col("children_rows").cast("bigint").alias("children_rows"), "ok")


def party_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Names in which every part of a filter occurs."""
    filters = ["co wi", "re in", "bo ue", "a"]
    tried = table(spark, sf, "part").select("p_partkey", "p_name", F.explode(F.array(*map(F.lit, filters))).alias("filter"))
    return tried.where(S.matches_filter(F.col("p_name"), F.col("filter"))).select("filter", "p_partkey")


def _leaves(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "event_id", "props")
    full = e.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CAP).select("day", "event_type")
    return e.join(full, ["day", "event_type"], "left_semi")


def party_cover(spark: SparkSession, sf: str) -> DataFrame:
    """How each saturated leaf was covered by filters: covered or abandoned, filters, union."""
    events, _ = cascade.cover(_leaves(spark, sf), ["day", "event_type"], "event_id", "props", DIGIT_FILTERS, CAP, 5)
    return events


def cover_budget(spark: SparkSession, sf: str) -> DataFrame:
    """The cover of the saturated leaves with eight filters at most: leaves that don't plateau by then are abandoned."""
    events, _ = cascade.cover(_leaves(spark, sf), ["day", "event_type"], "event_id", "props", DIGIT_FILTERS, CAP, 5, most=8)
    return events


def partition_sums(spark: SparkSession, sf: str) -> DataFrame:
    """For each window split by date, its rows and those of its two halves: they tile it."""
    windows = date_cascade(spark, sf)
    halves = windows.where("depth > 0").groupBy(F.expr("substring(path, 1, length(path) - 1)").alias("path")).agg(F.sum("n").alias("halves_n"), F.count(F.lit(1)).alias("halves"))
    return windows.where("kind = 'capped'").join(halves, "path").select("path", "n", "halves_n", "halves")


def sweep_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Each number the cover listed, under the first filter that did, without those seen before."""
    _, found = cascade.cover(_leaves(spark, sf), ["day", "event_type"], "event_id", "props", DIGIT_FILTERS, CAP, 5)
    seen = table(spark, sf, "events").where(F.col("event_id") % 10 == 0).select(F.col("event_id").alias("number"))
    return cascade.first_listing(found, "number", ["ord", "day", "event_type"], seen).select("number", "ord")


def latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return logs.latest_per_key(e, "user_id", "event_id").drop("first_seq")


def first_seen_last_value(spark: SparkSession, sf: str) -> DataFrame:
    """The last value of each user with the place at which the user was first seen."""
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    return logs.latest_per_key(e, "user_id", "event_id").select("user_id", "value", "first_seq")


def pending_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Users with a view and never a large purchase, with their last view."""
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return logs.pending(e.where("event_type = 'view'"), e.where("event_type = 'purchase' and value > 113"), "user_id", "event_id").select("user_id", "event_id", "first_seq")


def retry_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Users whose last record is an error that may be tried again."""
    e = table(spark, sf, "events").where("event_type in ('error', 'purchase')").select("user_id", "event_id", "event_type", "value")
    return logs.retryable(e, "user_id", "event_id", F.col("event_type") == "error", F.col("value") > 20).select("user_id", "event_id", "value")


def retry_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The next failure of each open record: its attempt and whether it stays retryable."""
    e = table(spark, sf, "events").where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("attempt"))
    return e.select("user_id", collection.next_failure(F.col("attempt")).alias("f")).select("user_id", "f.attempt", "f.retryable")


def seen_set(spark: SparkSession, sf: str) -> DataFrame:
    """All orders that the final events of a day's log have listed."""
    o = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.collect_list("o_orderkey").alias("numbers"), F.min("o_orderstatus").alias("type"))
    return logs.seen_set(o, "numbers", F.col("type") != "O").select(F.col("number").alias("o_orderkey"))


def covered_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of a day and class, some without a class, that no final event has covered."""
    base = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    windows = base.select("day", F.when(F.col("event_type") != "error", F.col("event_type")).alias("class_id")).distinct()
    done = base.where("value > 224").select("day", F.when(F.col("event_type") != "error", F.col("event_type")).alias("class_id"), F.lit("window").alias("type"))
    return logs.uncovered(windows, done, ["day", "class_id"], F.col("type") == "window").select("day", F.coalesce("class_id", F.lit("-")).alias("class_id"))


def case_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records put together from child rows and taken apart again, with the place of each child."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("documents")
    )
    cases = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    flat = cases.select("o_orderkey", F.posexplode("documents").alias("pos", "d"))
    return flat.select("o_orderkey", "pos", "d.l_linenumber", "d.l_partkey", "d.l_quantity")


def page_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The pages of each order's lines, three to a page, against the declared total."""
    per = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("declared"), F.count_if(F.col("l_quantity") < 49).alias("fetched"))
    paged = per.withColumn("plan", checks.page_plan(F.col("declared"), F.lit(3), F.lit(1)))
    each = paged.select("l_orderkey", "declared", F.explode(F.sequence(F.lit(1).cast("bigint"), "plan")).alias("page"), "fetched")
    rows = F.greatest(F.lit(0), F.least(F.lit(3), F.col("fetched") - (F.col("page") - 1) * 3))
    out = checks.reconcile_pages(each.withColumn("rows", rows), ["l_orderkey"], "rows", "declared")
    return out.select("l_orderkey", "pages", F.col("collected").cast("bigint").alias("collected"), "declared", "matches")


def budget_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The orders a run gets to within 5,000 lines, in the order of their keys."""
    cost = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("cost"))
    work = table(spark, sf, "orders").join(cost, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "cost")
    return checks.within_budget(work, "o_orderkey", F.col("cost"), 5000)


def breaker_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Users with three or more errors in a row."""
    return checks.longest_runs(table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", 3)


def history_start(spark: SparkSession, sf: str) -> DataFrame:
    """The first year with orders, no earlier than the floor."""
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return cascade.history_start(years, "year", 2001, 5).withColumn("floor", F.lit(1996))


def squash_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with their white space squashed."""
    return table(spark, sf, "documents").where("text is not null").select("doc_id", S.squash(F.col("text")).alias("squashed"))


def sanitise_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Names as one segment of a path."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), S.sanitise_segment(F.concat(F.lit("."), "p_name", F.lit(" / "), "p_brand")).alias("segment"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), S.sanitise_segment(F.concat_ws("//", "source", "kind", "docdate")).alias("segment"))
    return parts.union(docs)


def date_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Dates to the form of the search, back, and their month."""
    d = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    form = S.to_form_date(F.col("day"))
    return d.select("o_orderkey", form.alias("form"), S.to_iso_date(form).alias("iso"), S.reference_month(F.col("day")).alias("month"), S.epoch_day(F.col("day")).alias("epoch"))


def backoff(spark: SparkSession, sf: str) -> DataFrame:
    """Waits before the first twelve retries, without and with what the server asks."""
    n = spark.range(1, 13).select(F.col("id").alias("attempt"))
    asked = F.when(F.col("attempt") % 3 == 0, F.col("attempt") * 9000)
    return n.select("attempt", S.retry_delay_ms(F.col("attempt"), asked, F.lit(0.5)).alias("delay_ms"))


def scratch_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events*.parquet")


def drain(query_of, spark: SparkSession) -> None:
    query = query_of.trigger(availableNow=True).start()
    query.awaitTermination()


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The users of an event stream, each once."""
    from sievemill.streaming.streams import first_seen

    at = scratch(spark)
    out = first_seen(scratch_stream(spark, sf).select("user_id"), ["user_id"])
    drain(out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").outputMode("append"), spark)
    return spark.read.parquet(f"{at}/out")


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The last event of each user that isn't undone by a later purchase, from a stream."""
    from sievemill.operators.changes import EqualityDeleteTable
    from sievemill.streaming.streams import upsert_into

    at = scratch(spark)
    store = EqualityDeleteTable(spark, f"{at}/table", ["user_id"], ["event_id"], "event_id")
    rows = scratch_stream(spark, sf).select("user_id", "event_id", "event_type", "value")
    drain(rows.writeStream.foreachBatch(upsert_into(store, "event_type = 'purchase'")).option("checkpointLocation", f"{at}/checkpoint"), spark)
    return store.read()


QUERIES = {f.__name__: f for f in (
    window_filter, capped_topk, date_cascade, class_split, class_split_deep, class_split_check, party_filter, party_cover, cover_budget, partition_sums, sweep_dedup,
    latest_wins, first_seen_last_value, pending_queue, retry_ledger, retry_cap, seen_set, covered_windows, case_documents, page_reconcile,
    budget_cut, breaker_runs, history_start, squash_text, sanitise_segment, date_strings, backoff, stream_dedup, stream_latest,
)}
