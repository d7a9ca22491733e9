"""Queries of the chained sweep, the run and the second pass over failures, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions.text import case_number
from sievemill.operators import logs
from sievemill.plans import collection, sweep
from sievemill.plans.core_queries import DIGIT_FILTERS
from sievemill.plans.core_sql import COVER_FILTERS, number
from sievemill.schemas import CAP
from sievemill.session import cut, table


def _windows(spark: SparkSession, rows: DataFrame, day: Column) -> tuple[DataFrame, DataFrame]:
    """Windows done before (each fifth of a month, and class error on each seventh) and windows refused (two days from the 10th to the 16th on)."""
    days = rows.select(day.cast("date").alias("d")).distinct()
    one = lambda c: F.date_format(c, "yyyy-MM-dd")
    done = days.where(F.dayofmonth("d") == 5).select(one("d").alias("from_day"), one("d").alias("to_day"), F.lit(None).cast("string").alias("class_id"))
    errors = days.where(F.dayofmonth("d") == 7).select(one("d").alias("from_day"), one("d").alias("to_day"), F.lit("error").alias("class_id"))
    refused = days.where(F.dayofmonth("d").between(10, 16)).select(one("d").alias("from_day"), one(F.date_add("d", 1)).alias("to_day"), F.lit(None).cast("string").alias("class_id"), F.lit("refused").alias("message"))
    return done.unionByName(errors), refused


def _sweep(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "events")
    covered, rejected = _windows(spark, e, F.col("ts"))
    classes = e.select("event_type").distinct().where("event_type <> 'signup'")
    catalog = classes.select(F.col("event_type").alias("class_id"), F.ascii("event_type").alias("ord")).unionByName(classes.where("event_type = 'view'").select(F.col("event_type").alias("class_id"), F.lit(999).alias("ord")))
    seen = e.where(F.col("event_id") % 10 == 0).select(F.col("event_id").alias("number"))
    return sweep.sweep(
        e, F.col("ts"), F.col("event_type"), F.col("event_id"), F.col("props"), catalog, filters=DIGIT_FILTERS, covered=covered, rejected=rejected, rejected_filters=["k 3"], seen=seen
    )


def sweep_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events of a sweep over the event stream: dates, classes, filters, windows skipped and refused."""
    return _sweep(spark, sf)[0]


def sweep_listed(spark: SparkSession, sf: str) -> DataFrame:
    """Each number such a sweep lists, under its first final event."""
    return _sweep(spark, sf)[1]


def sweep_class_check(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the classes of each split day list as many rows as the cap."""
    return sweep.class_check(_sweep(spark, sf)[0])


def _run(spark: SparkSession, sf: str, max_requests: int | None, max_cases: int | None) -> dict[str, DataFrame]:
    o = table(spark, sf, "orders")
    month = F.trunc("o_orderdate", "month")
    priorities = o.select(F.col("o_orderpriority").alias("class_id")).distinct().withColumn("ord", F.ascii("class_id"))
    events, listed = sweep.sweep(o, month, F.col("o_orderpriority"), F.col("o_orderkey"), F.concat(F.lit("k"), F.col("o_orderkey").cast("string")), priorities, filters=DIGIT_FILTERS)
    key = F.col("o_orderkey")
    details = o.where(key % 17 != 0).select(
        key.alias("number"), (1 + key % 2).alias("requests"), F.when(F.col("o_orderstatus") == "P", "bad page").alias("error"), F.when(key % 3 == 0, 1).otherwise(0).alias("retries")
    )
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("number")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", "l_returnflag"))).alias("d"))
    documents = lines.select("number", F.posexplode("d").alias("doc", "d")).select(
        "number", "doc", F.col("d.l_partkey").alias("document_id"), F.lit(1).alias("requests"), (F.col("d.l_quantity") >= 45).alias("skipped"),
        F.when((F.col("d.l_returnflag") == "R") & (F.col("d.l_quantity") < 5), "no PDF content").alias("error"), F.lit(0).alias("retries"),
    )
    pending, stored = o.where(key % 50 == 1).select(key.alias("number")), o.where(key % 100 == 1).select(key.alias("number"))
    return collection.run(cut(events), listed, details, documents.join(o.select(key.alias("number")), "number", "left_semi"), pending, stored, max_requests, max_cases)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The summary of a run over all orders without limits."""
    return _run(spark, sf, None, None)["summary"]


def run_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The summary of a run that a limit of requests stops."""
    return _run(spark, sf, 900, None)["summary"]


def run_limited_cases(spark: SparkSession, sf: str) -> DataFrame:
    """What a run that a limit of cases stops has done, unit by unit."""
    return _run(spark, sf, 2000, 70)["log"].select("path", "stage", "ord", F.coalesce("number", F.lit(-1)).alias("number"), "doc", "type", "cost", "reason")


def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger records of that run: cases and documents that failed, documents that were fetched."""
    done = _run(spark, sf, 2000, 70)
    parts = [done["case_failures"].select(F.lit("cases").alias("ledger"), "type", F.col("key").cast("string").alias("key"), "reason"), done["document_failures"].select(F.lit("documents").alias("ledger"), "type", "key", "reason")]
    return parts[0].unionByName(parts[1]).unionByName(done["document_successes"].select(F.lit("documents").alias("ledger"), "type", "key", F.lit(None).cast("string").alias("reason")))


def open_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The failures of documents that may be tried again, with their details laid flat."""
    open_rows = logs.retryable(table(spark, sf, "failed_documents"), "ledger_key", "seq", F.col("record_type") == "failure", F.col("retryable"))
    return open_rows.select("ledger_key", "reason", "httpstatus", "attempt", "detail.casenumber", "detail.documentid", "detail.downloadref.idbin", "seq", "first_seq")


def _open(spark: SparkSession, sf: str, ledger: str) -> DataFrame:
    return logs.retryable(table(spark, sf, ledger), "ledger_key", "seq", F.col("record_type") == "failure", F.col("retryable"))


def retried_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Open document failures with the document of their case's latest record."""
    return _retried(spark, sf).select("ledger_key", "caseNumber", "documentId", F.col("document.name").alias("name"), "attempt")


def _retried(spark: SparkSession, sf: str) -> DataFrame:
    cases = logs.latest_per_key(table(spark, sf, "cases").withColumn("number", case_number(F.col("number"))), "number", "seq")
    failures = _open(spark, sf, "failed_documents").select("ledger_key", "attempt", case_number(F.col("detail.casenumber")).alias("caseNumber"), F.col("detail.documentid").alias("documentId"))
    return collection.retried_documents(failures, cases.select("number", "documents"))


def retry_run(spark: SparkSession, sf: str) -> DataFrame:
    """The records of a second pass over both ledgers: what worked now, what failed once more and whether it stays open."""
    known = table(spark, sf, "cases").select(case_number(F.col("number")).alias("number")).distinct().withColumn("here", F.lit(True))
    failed = _open(spark, sf, "failed_cases").select(F.col("ledger_key").alias("key"), "attempt", case_number(F.col("detail.casenumber")).alias("number"))
    answers = failed.join(known, "number", "left").select("key", F.when(F.col("here").isNull(), "no response").alias("error"))
    cases = collection.retry(failed, answers)
    again = _retried(spark, sf).select(F.col("ledger_key").alias("key"), "attempt", F.when(F.col("document.localpath").isNull(), "no PDF content").alias("error"))
    documents = collection.retry(again.select("key", "attempt"), again.select("key", "error"))
    return cases.select(F.lit("cases").alias("ledger"), "*").unionByName(documents.select(F.lit("documents").alias("ledger"), "*"))


QUERIES = {f.__name__: f for f in (
    sweep_events, sweep_listed, sweep_class_check, run_summary, run_limited, run_limited_cases, run_ledger, open_ledger, retried_documents, retry_run,
)}


def _sweep_sql(rows: str, stop: str, class_stop: str, catalog: str, seen: str, mute: int) -> str:
    """The sweep as common table expressions: ev (events) and ls (listed rows)."""
    return f"""
with recursive b as ({rows}),
c as (select d, count(*) as n from b group by 1),
w(lo, hi, depth, path) as (
  select min(d), max(d), 0, '' from c
  union all
  select case when h.k = 0 then w.lo + cast(datediff('day', w.lo, w.hi) // 2 + 1 as integer) else w.lo end,
         case when h.k = 0 then w.hi else w.lo + cast(datediff('day', w.lo, w.hi) // 2 as integer) end, w.depth + 1, w.path || cast(h.k as varchar)
  from w, (values (0), (1)) h(k)
  where w.lo < w.hi and ({stop}) is null and (select coalesce(sum(n), 0) from c where d between w.lo and w.hi) >= {CAP}),
v as (select w.*, (select coalesce(sum(n), 0) from c where d between w.lo and w.hi) as n, {stop} as stop from w where lo is not null),
cat as (select cls, min(ord) as ord from ({catalog}) group by 1),
k as (
  select x.lo as d, cat.cls, x.depth + 1 as depth, x.path || '/' || lpad(cast(cat.ord as varchar), 6, '0') as path,
         (select count(*) from b where b.d = x.lo and b.cls = cat.cls) as n, {class_stop} as stop
  from v x, cat where x.stop is null and x.lo = x.hi and x.n >= {CAP}),
leaf as (select * from k where stop is null and n >= {CAP}),
lb as (select leaf.path, b.num, b.name from b join leaf on leaf.d = b.d and leaf.cls = b.cls),
hits as (select path, num, 0 as ord from lb union all select path, num, f.ord from lb join {COVER_FILTERS} on contains(lb.name, f.a) and contains(lb.name, f.b) where f.ord <> {mute}),
ranked as (select *, row_number() over (partition by path, ord order by num) as rk from hits),
firsts as (select path, num, min(ord) as ord from ranked where rk <= {CAP} group by 1, 2),
news as (select path, ord, count(*) as news from firsts group by 1, 2),
sizes as (select path, ord, count(*) as n from hits group by 1, 2),
steps as (
  select l.path, o.ord, coalesce(x.news, 0) as news, coalesce(s.n, 0) as n from leaf l cross join (select unnest(range(0, 16)) as ord) o
  left join news x on x.path = l.path and x.ord = o.ord left join sizes s on s.path = l.path and s.ord = o.ord),
isles as (select *, sum(case when news > 0 then 1 else 0 end) over (partition by path order by ord) as isle from steps),
streaks as (
  select *, sum(case when news = 0 and n < {CAP} and ord > 0 and ord <> {mute} then 1 else 0 end) over (partition by path, isle order by ord) as streak,
         sum(news) over (partition by path order by ord) as union_size from isles),
ends as (select path, min(case when streak >= 5 then ord end) as stop from streaks group by 1),
fin as (
  select v.path, 0 as ord, b.num from v join b on b.d between v.lo and v.hi where v.stop is null and v.n < {CAP}
  union all select k.path, 0, b.num from k join b on b.d = k.d and b.cls = k.cls where k.stop is null and k.n < {CAP}
  union all select f.path, f.ord, f.num from firsts f join ends t on t.path = f.path where f.ord <= coalesce(t.stop, 15)),
ls as (select num as number, path, cast(ord as integer) as ord from (select *, row_number() over (partition by num order by path, ord) as r from fin) where r = 1 and {seen}),
e0 as (
  select case when stop is not null then stop when n < {CAP} then 'window' else 'capped' end as type, lo, hi, cast(null as varchar) as class_id, depth, path,
         case when stop is null then n end as n, case when stop is null and n >= {CAP} then case when lo < hi then 'date' else 'class' end end as split_by,
         cast(null as bigint) as filters_tried, cast(null as bigint) as union_size, case when stop = 'rejected' then 'refused' end as message from v
  union all select coalesce(stop, 'window'), d, d, cls, depth, path, case when stop is null then n end, null, null, null, null from k where stop is not null or n < {CAP}
  union all select case when t.stop is not null then 'covered' else 'abandoned' end, l.d, l.d, l.cls, l.depth, l.path, l.n, null, coalesce(t.stop, 15), s.union_size, null
  from leaf l join ends t on t.path = l.path join streaks s on s.path = l.path and s.ord = coalesce(t.stop, 15)),
fresh as (select path, count(*) as k from ls group by 1),
ev as (
  select type, strftime(lo, '%Y-%m-%d') as from_day, strftime(hi, '%Y-%m-%d') as to_day, class_id, cast(depth as integer) as depth, e0.path, cast(n as bigint) as n, split_by,
         cast(filters_tried as integer) as filters_tried, cast(union_size as bigint) as union_size, message,
         case when type in ('window', 'covered', 'abandoned') then cast(coalesce(fresh.k, 0) as bigint) end as rows,
         cast(case when type = 'skipped' then 0 else coalesce(filters_tried, 0) + 1 end as bigint) as requests
  from e0 left join fresh on fresh.path = e0.path)
"""


_EVENTS = _sweep_sql(
    "select cast(ts as date) as d, event_type as cls, event_id as num, props as name from events",
    "case when w.lo = w.hi and day(w.lo) = 5 then 'skipped' when datediff('day', w.lo, w.hi) = 1 and day(w.lo) between 10 and 16 and exists (select 1 from c where c.d = w.lo) then 'rejected' end",
    "case when cat.cls = 'error' and day(x.lo) = 7 then 'skipped' end",
    "select distinct event_type as cls, ascii(event_type) as ord from events where event_type <> 'signup'", "num % 10 <> 0", 3,
)
_ORDERS = _sweep_sql(
    "select cast(date_trunc('month', o_orderdate) as date) as d, o_orderpriority as cls, o_orderkey as num, 'k' || cast(o_orderkey as varchar) as name from orders",
    "cast(null as varchar)", "cast(null as varchar)", "select distinct o_orderpriority as cls, ascii(o_orderpriority) as ord from orders", "true", -1,
)
_RUN = _ORDERS + """,
det as (select o_orderkey as number, 1 + o_orderkey % 2 as requests, case when o_orderstatus = 'P' then 'bad page' end as error, case when o_orderkey % 3 = 0 then 1 else 0 end as retries from orders where o_orderkey % 17 <> 0),
doc as (
  select l_orderkey as number, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_returnflag) - 1 as doc, l_partkey as document_id, l_quantity >= 45 as skipped,
         case when l_returnflag = 'R' and l_quantity < 5 then 'no PDF content' end as error from lineitem where l_orderkey in (select o_orderkey from orders)),
pend as (select o_orderkey as number from orders where o_orderkey % 50 = 1),
stor as (select o_orderkey as number from orders where o_orderkey % 100 = 1),
allrows as (select path, ord, number from ls union all select '~', 0, number from pend where number not in (select number from ls)),
rowunits as (
  select r.path, r.ord, r.number, det.requests, det.retries, r.path = '~' and r.number in (select number from stor) as resumed,
         case when det.number is null then 'no response' else det.error end as reason from allrows r left join det on det.number = r.number),
units as (
  select path, 0 as stage, 0 as ord, cast(null as bigint) as number, -1 as doc, type, requests as cost, coalesce(rows, 0) as rows, 0 as retries, true as gated, message as reason, cast(null as bigint) as document_id from ev
  union all
  select path, 1, ord, number, -1, case when resumed then 'resumed' when reason is not null then 'case-failed' else 'case-detailed' end, case when resumed then 0 else coalesce(requests, 1) end, 0,
         case when resumed then 0 else coalesce(retries, 0) end, true, case when not resumed then reason end, null from rowunits
  union all
  select r.path, 1, r.ord, r.number, d.doc, case when d.skipped then 'document-skipped' when d.error is null then 'document-downloaded' else 'document-failed' end,
         case when d.skipped then 0 else 1 end, 0, 0, false, d.error, d.document_id
  from rowunits r join doc d on d.number = r.number where r.resumed or r.reason is null),
summed as (
  select *, row_number() over win as rn, coalesce(sum(cost) over (win rows between unbounded preceding and 1 preceding), 0) as spent,
         coalesce(sum(case when type = 'case-detailed' then 1 else 0 end) over (win rows between unbounded preceding and 1 preceding), 0) as cases
  from units window win as (order by path, stage, ord, number nulls first, doc)),
lim as (select min(rn) as stop, arg_min(case when {requests} then 'maxRequests' else 'maxCases' end, rn) as why from summed where {requests} or gated and {cases}),
done as (select * from summed where rn < (select coalesce(stop, 9223372036854775807) from lim)),
begun as (select number from done where type in ('case-detailed', 'resumed')),
ended as (select number from begun b where (select count(*) from done where done.number = b.number and done.doc >= 0) = (select count(*) from doc where doc.number = b.number)),
dequeued as (select number from ended union select number from done where type = 'case-failed'),
queued as (select number from pend union select ls.number from ls join done on done.path = ls.path and done.stage = 0)
"""
_SUMMARY = """
select count(*) filter (where type in ('window', 'unsplittable', 'covered', 'abandoned')) as windows, count(*) filter (where type = 'skipped') as windows_skipped,
  count(*) filter (where type = 'rejected') as windows_rejected, count(*) filter (where type = 'case-detailed') as cases_detailed, count(*) filter (where type = 'case-failed') as cases_failed,
  count(*) filter (where type = 'document-downloaded') as documents_downloaded, count(*) filter (where type = 'document-skipped') as documents_skipped,
  count(*) filter (where type = 'document-failed') as documents_failed, cast(coalesce(sum(rows), 0) as bigint) as cases_listed, cast(coalesce(sum(cost), 0) as bigint) as requests,
  cast(coalesce(sum(retries), 0) as bigint) as retries, (select count(*) from (select number from stor union select number from done where type = 'case-detailed')) as cases_on_disk,
  (select count(*) from queued where number not in (select number from dequeued)) as pending_rows, (select why from lim) as stopped_by
from done"""


def _limits(sql: str, requests: str, cases: str) -> str:
    return sql.replace("{requests}", requests).replace("{cases}", cases)


_OPEN = "select * from (select *, min(seq) over (partition by ledger_key) as first_seq, row_number() over (partition by ledger_key order by seq desc) as r from {0}) where r = 1 and record_type = 'failure' and retryable"
_RETRIED = f"""
kc as (select * from (select {number('number')} as number, documents, row_number() over (partition by {number('number')} order by seq desc) as r from cases) where r = 1),
kd as (select number, d.download.idprocessodocumento as id, d from (select number, unnest(documents) as d from kc) qualify row_number() over (partition by number, d.download.idprocessodocumento) = 1),
od as (select ledger_key, attempt, {number('detail.casenumber')} as casenumber, detail.documentid as documentid from ({_OPEN.format('failed_documents')})),
rd as (select od.*, kd.d from od join kd on kd.number = od.casenumber and kd.id = od.documentid)"""
_LEDGER_ROW = "case when error is null then 'success' else 'failure' end as type, case when error is not null then attempt + 1 end as attempt, case when error is not null then attempt + 1 < 3 end as retryable, error as reason"

ORACLES = {
    "sweep_events": _EVENTS + "select * from ev",
    "sweep_listed": _EVENTS + "select * from ls",
    "sweep_class_check": _EVENTS + f"""
select p.path, p.from_day, cast(coalesce(sum(c.rows), 0) as bigint) as children_rows, case when bool_and(c.type in ('window', 'covered', 'abandoned')) then coalesce(sum(c.rows), 0) >= {CAP} end as ok
from ev p join ev c on contains(c.path, '/') and split_part(c.path, '/', 1) = p.path where p.split_by = 'class' group by 1, 2""",
    "run_summary": _limits(_RUN, "false", "false") + _SUMMARY,
    "run_limited": _limits(_RUN, "spent >= 900", "false") + _SUMMARY,
    "run_limited_cases": _limits(_RUN, "spent >= 2000", "cases >= 70") + "select path, cast(stage as integer) as stage, cast(ord as integer) as ord, coalesce(number, -1) as number, cast(doc as bigint) as doc, type, cast(cost as bigint) as cost, reason from done",
    "run_ledger": _limits(_RUN, "spent >= 2000", "cases >= 70") + """
select 'cases' as ledger, 'failure' as type, cast(number as varchar) as key, reason from done where type = 'case-failed'
union all select 'documents', case when type = 'document-failed' then 'failure' else 'success' end, cast(number as varchar) || '::' || cast(document_id as varchar), case when type = 'document-failed' then reason end from done where doc >= 0""",
    "open_ledger": f"select ledger_key, reason, httpstatus, attempt, detail.casenumber, detail.documentid, detail.downloadref.idbin, seq, first_seq from ({_OPEN.format('failed_documents')})",
    "retried_documents": f"with {_RETRIED} select ledger_key, casenumber as \"caseNumber\", documentid as \"documentId\", d.name as name, attempt from rd",
    "retry_run": f"""
with {_RETRIED},
c as (select ledger_key as key, attempt, case when {number('detail.casenumber')} not in (select number from kc where number is not null) then 'no response' end as error from ({_OPEN.format('failed_cases')}))
select 'cases' as ledger, key, {_LEDGER_ROW} from c
union all select 'documents', ledger_key, {_LEDGER_ROW} from (select ledger_key, attempt, case when d.localpath is null then 'no PDF content' end as error from rd)""",
}
