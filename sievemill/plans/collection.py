"""A collection run over captured responses: detail, download, retry, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions.scalars import document_key
from sievemill.operators.checks import running_totals, within_budget
from sievemill.schemas import FINAL_EVENTS, MAX_ATTEMPTS
from sievemill.session import cut


def route_pending(pending: DataFrame, cases: DataFrame) -> DataFrame:
    """Each queued row with ``step``: download for a case that is stored, else detail."""
    known = cases.select("number", F.lit(True).alias("__known")).distinct()
    return pending.join(known, "number", "left").withColumn("step", F.when(F.col("__known"), "download").otherwise("detail")).drop("__known")


def budgeted(work: DataFrame, order: str, cost: Column, max_requests: int | None, max_cases: int | None) -> DataFrame:
    """The units a run gets to: requests are checked before cases."""
    out = work if max_requests is None else within_budget(work, order, cost, max_requests).withColumnRenamed("spent_before", "requests_before")
    return out if max_cases is None else within_budget(out, order, F.lit(1), max_cases).withColumnRenamed("spent_before", "cases_before")


def process_rows(rows: DataFrame, fetched: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to process against fetched cases: (completed, failures).

    A row whose fetch failed, or has no answer, becomes a ledger row with its
    reason; it leaves the queue like a completed one. No failure stops others.
    """
    done = fetched.join(rows.select("number"), "number", "left_semi")
    reasons = errors.select("number", F.col("error").alias("reason"))
    lost = rows.join(fetched.select("number"), "number", "left_anti").join(reasons, "number", "left")
    failures = lost.select(
        F.lit("failure").alias("type"), F.col("number").alias("key"), F.coalesce("reason", F.lit("no response")).alias("reason"),
        F.lit(1).alias("attempt"), F.lit(True).alias("retryable"), F.struct(F.col("number").alias("caseNumber"), F.col("ca")).alias("detail"),
    )
    return done, failures


def retried_documents(open_failures: DataFrame, cases: DataFrame) -> DataFrame:
    """Open document failures with the case's own document; those without one are left out."""
    held = cases.select(F.col("number").alias("caseNumber"), F.explode("documents").alias("document"))
    held = held.withColumn("documentId", F.col("document.download.idProcessoDocumento")).dropDuplicates(["caseNumber", "documentId"])
    return open_failures.join(held, ["caseNumber", "documentId"])


def next_failure(attempt: Column) -> Column:
    """The next failure of a record: struct(attempt, retryable)."""
    return F.struct((attempt + 1).alias("attempt"), (attempt + 1 < MAX_ATTEMPTS).alias("retryable"))


#: The lines of a summary in their order.
SUMMARY = [
    "windows", "windows_skipped", "windows_rejected", "cases_listed", "cases_detailed", "cases_failed", "documents_downloaded", "documents_skipped",
    "documents_failed", "requests", "retries", "cases_on_disk", "pending_rows", "retryable_cases", "retryable_documents", "stopped_by",
]


def run_summary(log: DataFrame) -> DataFrame:
    """The counters of a run from its log (``type``, ``rows``, ``cost``, ``retries``), one row."""
    names = {
        "windows": FINAL_EVENTS, "windows_skipped": ["skipped"], "windows_rejected": ["rejected"],
        "cases_detailed": ["case-detailed"], "cases_failed": ["case-failed"], "documents_downloaded": ["document-downloaded"],
        "documents_skipped": ["document-skipped"], "documents_failed": ["document-failed"],
    }
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias({"rows": "cases_listed", "cost": "requests"}.get(c, c))
    return log.agg(*(F.count_if(F.col("type").isin(*kinds)).alias(n) for n, kinds in names.items()), total("rows"), total("cost"), total("retries"))


ORDER = ["path", "stage", "ord", "number", "doc"]


def work_units(events: DataFrame, listed: DataFrame, details: DataFrame, documents: DataFrame, pending: DataFrame, stored: DataFrame) -> DataFrame:
    """Everything a run would do, one row per unit, in the order of ``ORDER``.

    Searches come in the order of the walk, each followed by the details of
    the rows it lists and each detail by its documents; rows that an earlier
    run left pending come last, stored ones with their documents only.
    ``type`` is what the captured response makes of the unit; ``gated`` says
    that the limit of cases holds for it. A row without a response has failed.
    """
    searches = events.select(
        "path", F.lit(0).alias("stage"), F.lit(0).alias("ord"), F.lit(None).cast(listed.schema["number"].dataType).alias("number"), F.lit(-1).cast("bigint").alias("doc"),
        "type", F.col("requests").alias("cost"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("retries"), F.lit(True).alias("gated"), F.col("message").alias("reason"),
        "from_day", "to_day", "class_id", "split_by", "filters_tried", "union_size",
    )
    late = pending.select("number").distinct().join(listed.select("number"), "number", "left_anti").select(F.lit("~").alias("path"), F.lit(0).alias("ord"), "number")
    rows = listed.select("path", "ord", "number").unionByName(late)
    known = stored.select("number", F.lit(True).alias("__stored")).distinct()
    tried = rows.join(details, "number", "left").join(known, "number", "left")
    resumed = (F.col("path") == "~") & F.coalesce("__stored", F.lit(False))
    reason = F.when(~resumed, F.when(F.col("requests").isNull(), "no response").otherwise(F.col("error")))
    fetched = tried.select(
        "path", F.lit(1).alias("stage"), "ord", "number", F.lit(-1).cast("bigint").alias("doc"),
        F.when(resumed, "resumed").when(reason.isNotNull(), "case-failed").otherwise("case-detailed").alias("type"),
        F.when(resumed, 0).otherwise(F.coalesce("requests", F.lit(1))).cast("bigint").alias("cost"), F.lit(0).cast("bigint").alias("rows"),
        F.when(resumed, 0).otherwise(F.coalesce("retries", F.lit(0))).cast("bigint").alias("retries"), F.lit(True).alias("gated"), reason.alias("reason"),
    )
    files = fetched.where("type <> 'case-failed'").select("path", "ord", "number").join(documents, "number").select(
        "path", F.lit(1).alias("stage"), "ord", "number", F.col("doc").cast("bigint").alias("doc"),
        F.when(F.col("skipped"), "document-skipped").when(F.col("error").isNull(), "document-downloaded").otherwise("document-failed").alias("type"),
        F.when(F.col("skipped"), 0).otherwise(F.col("requests")).cast("bigint").alias("cost"), F.lit(0).cast("bigint").alias("rows"),
        F.coalesce("retries", F.lit(0)).cast("bigint").alias("retries"), F.lit(False).alias("gated"), F.col("error").alias("reason"),
    )
    return searches.unionByName(fetched.unionByName(files), allowMissingColumns=True)


def run(
    events: DataFrame, listed: DataFrame, details: DataFrame, documents: DataFrame, pending: DataFrame, stored: DataFrame,
    max_requests: int | None = None, max_cases: int | None = None,
) -> dict[str, DataFrame]:
    """A run over captured responses, cut off where a live one would have stopped.

    ``events`` and ``listed`` are a sweep's; ``details`` has ``number,
    requests, error, retries`` and ``documents`` ``number, doc, document_id,
    requests, skipped, error, retries`` (error null: fetched); ``pending`` and
    ``stored`` have the ``number`` of rows an earlier run left queued and of
    cases it stored. The request limit is checked before every unit, the case
    limit before searches and rows; the unit at which a limit has been reached
    and all after it aren't done, and no failure stops the others.

    Results: ``log`` (units done), ``case_failures``, ``document_failures``
    and ``document_successes`` (ledger records), ``stored`` (numbers detailed),
    ``dequeued`` (rows done with: failed, or all documents tried),
    ``pending`` (rows left) and ``summary``, one row of ``SUMMARY`` without
    the two counts of the ledgers.
    """
    details = details.select("number", "requests", "error", "retries")
    documents = documents.select("number", "doc", "document_id", "requests", "skipped", "error", "retries")
    units = work_units(events, listed, details, documents, pending, stored)
    stop, why = None, None
    if max_requests is not None or max_cases is not None:
        totals = {"spent_before": F.col("cost"), "cases_before": (F.col("type") == "case-detailed").cast("bigint")}
        units = cut(running_totals(units, ORDER, totals))
        spent = F.col("spent_before") >= max_requests if max_requests is not None else F.lit(False)
        many = F.col("gated") & (F.col("cases_before") >= max_cases) if max_cases is not None else F.lit(False)
        over = units.where(spent | many).agg(F.min(F.struct(*ORDER, F.when(spent, "maxRequests").otherwise("maxCases").alias("why"))).alias("m")).first()["m"]
        if over is not None:
            why, stop = over["why"], [over[c] for c in ORDER]
    log = units.drop("spent_before", "cases_before")
    if stop is not None:
        kinds = {f.name: f.dataType for f in units.schema.fields}
        log = log.where(F.struct(*ORDER) < F.struct(*(F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(ORDER, stop, strict=True))))
    log = cut(log)
    failed = log.where("type = 'case-failed'").select("number", "reason")
    detailed = log.where("type = 'case-detailed'").select("number")
    tried = log.where("doc >= 0").groupBy("number").agg(F.count(F.lit(1)).alias("tried"))
    owed = documents.groupBy("number").agg(F.count(F.lit(1)).alias("owed"))
    begun = log.where("type in ('case-detailed', 'resumed')").select("number")
    ended = begun.join(tried, "number", "left").join(owed, "number", "left").where(F.coalesce("tried", F.lit(0)) == F.coalesce("owed", F.lit(0))).select("number")
    dequeued = ended.unionByName(failed.select("number"))
    queued = pending.select("number").unionByName(listed.join(log.where("stage = 0").select("path"), "path", "left_semi").select("number")).distinct()
    left = queued.join(dequeued, "number", "left_anti")
    of_documents = log.where("doc >= 0").join(documents.select("number", F.col("doc").cast("bigint").alias("doc"), "document_id"), ["number", "doc"])
    on_disk = stored.select("number").unionByName(detailed).distinct()
    summary = run_summary(log).withColumn("__k", F.lit(1))
    for name, counted in (("cases_on_disk", on_disk), ("pending_rows", left)):
        summary = summary.join(counted.agg(F.count(F.lit(1)).alias(name)).withColumn("__k", F.lit(1)), "__k")
    return {
        "log": log, "stored": detailed, "dequeued": dequeued, "pending": left,
        "case_failures": failed.select(F.lit("failure").alias("type"), F.col("number").alias("key"), "reason", F.lit(1).alias("attempt"), F.lit(True).alias("retryable")),
        "document_failures": of_documents.where("type = 'document-failed'").select(F.lit("failure").alias("type"), document_key(F.col("number").cast("string"), F.col("document_id").cast("string")).alias("key"), "reason"),
        "document_successes": of_documents.where("type <> 'document-failed'").select(F.lit("success").alias("type"), document_key(F.col("number").cast("string"), F.col("document_id").cast("string")).alias("key")),
        "summary": summary.drop("__k").withColumn("stopped_by", F.lit(why).cast("string")),
    }


def retry(open_failures: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger records of a second pass over open failures: ``key, type, attempt, retryable, reason``.

    ``open_failures`` has ``key`` and ``attempt``, ``outcomes`` ``key`` and
    ``error`` (null: it worked now). A failure counts one attempt more than
    the ledger's and stays retryable below the most attempts; a success
    clears its key. Keys without an outcome are left alone: there is nothing
    to try them on.
    """
    tried = open_failures.select("key", "attempt").join(outcomes.select("key", "error"), "key")
    failed = F.col("error").isNotNull()
    after = next_failure(F.col("attempt"))
    return tried.select(
        "key", F.when(failed, "failure").otherwise("success").alias("type"), F.when(failed, after["attempt"]).alias("attempt"),
        F.when(failed, after["retryable"]).alias("retryable"), F.col("error").alias("reason"),
    )


def event_line() -> Column:
    """One line of text for an event row: type, label, rows, union_size, filters, split_by, message."""
    label, shown = F.col("label"), F.concat(F.col("shown").cast("string"), F.lit(" rows"))
    tail = lambda text: F.concat(F.lit("search "), label, F.lit(" -> "), shown, text)
    cover = lambda end: F.concat(
        F.lit("cover "), label, F.lit(" -> "), F.col("union_size").cast("string"), F.lit(" cases ("), F.col("filters_tried").cast("string"), F.lit(f" filters, {end})")
    )
    return (
        F.when(F.col("type") == "window", tail(F.lit("")))
        .when(F.col("type") == "capped", tail(F.concat(F.lit(" (capped, splitting by "), F.col("split_by"), F.lit(")"))))
        .when(F.col("type") == "unsplittable", tail(F.lit(" (capped, unsplittable)")))
        .when(F.col("type") == "covered", cover("plateaued"))
        .when(F.col("type") == "abandoned", cover("abandoned"))
        .when(F.col("type") == "skipped", F.concat(F.lit("search "), label, F.lit(" skipped (already covered)")))
        .when(F.col("type") == "rejected", F.concat(F.lit("search "), label, F.lit(" rejected: "), F.col("message")))
        .when(F.col("type") == "case-detailed", F.concat(F.lit("detail "), label))
        .when(F.col("type") == "case-failed", F.concat(F.lit("detail "), label, F.lit(" failed: "), F.col("message")))
        .when(F.col("type") == "document-downloaded", F.concat(F.lit("document "), label))
        .when(F.col("type") == "document-failed", F.concat(F.lit("document "), label, F.lit(" failed: "), F.col("message")))
        .when(F.col("type") == "retry", F.concat(F.lit("retry "), label, F.lit(": "), F.col("message")))
    )


def request_log(responses: DataFrame, session: str, order: str, status: str, most_retries: int = 5, breaker: int = 10) -> DataFrame:
    """A recorded response log as the client would have acted: ``retry``, ``failed``, ``aborted`` per response.

    A retryable response is tried again up to ``most_retries`` times in a
    row; ``breaker`` rate-limit responses in a row abort the session.
    """
    from pyspark.sql import Window

    from sievemill.functions.scalars import is_retryable_status

    w = Window.partitionBy(session).orderBy(order)
    bad, limited = is_retryable_status(F.col(status)), F.col(status) == 429
    marked = responses.withColumn("__b", F.sum(F.when(bad, 0).otherwise(1)).over(w)).withColumn("__l", F.sum(F.when(limited, 0).otherwise(1)).over(w))
    runs = marked.withColumn("bad_run", F.sum(F.when(bad, 1).otherwise(0)).over(Window.partitionBy(session, "__b").orderBy(order)))
    runs = runs.withColumn("limit_run", F.sum(F.when(limited, 1).otherwise(0)).over(Window.partitionBy(session, "__l").orderBy(order)))
    runs = runs.withColumn("aborted", F.max(F.col("limit_run") >= breaker).over(w))
    return runs.withColumn("retry", bad & (F.col("bad_run") <= most_retries) & ~F.col("aborted")).withColumn("failed", bad & (F.col("bad_run") > most_retries)).drop("__b", "__l")
