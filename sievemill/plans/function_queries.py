"""Queries of the scalar functions, the log views and the file rules over the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions import scalars as S
from sievemill.functions.text import case_number, file_path
from sievemill.operators import checks, logs
from sievemill.plans import collection
from sievemill.plans.core_queries import drain, scratch_stream
from sievemill.plans.core_sql import SQUASH, instant, number, path
from sievemill.schemas import FINAL_EVENTS, FILTERS
from sievemill.session import scratch, table
from sievemill.sources import capped, files


def window_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of a day and class with their canonical key and the label people see."""
    w = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("class_id")).distinct()
    until = F.when(F.col("class_id") == "view", F.date_format(F.date_add("day", 1), "yyyy-MM-dd")).otherwise(F.col("day"))
    party = F.when(F.col("class_id") == "click", F.lit("DA S"))
    return w.select("day", F.coalesce("class_id", F.lit("-")).alias("class_id"), S.window_key(F.col("day"), until, F.col("class_id"), party).alias("key"), S.range_label(F.col("day"), until, F.col("class_id"), party).alias("label"))


def keyed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that no final event has covered, told apart by their canonical key."""
    base = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("class_id"), "value")
    keyed = base.withColumn("key", S.window_key(F.col("day"), F.col("day"), F.col("class_id"), F.lit(None).cast("string")))
    done = keyed.where("value > 224").select("key", F.lit("covered").alias("type"))
    return logs.uncovered(keyed.select("key").distinct(), done, ["key"], F.col("type").isin(*FINAL_EVENTS))


def routed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each listed case with its next step: download if it is stored, else detail."""
    listed = table(spark, sf, "search_rows").select(case_number(F.col("number")).alias("number")).where("number is not null").distinct()
    return collection.route_pending(listed, table(spark, sf, "cases").select(case_number(F.col("number")).alias("number")))


def first_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The first listing of each case."""
    return logs.first_per_key(table(spark, sf, "search_rows").select("number", "ca", "seq"), "number", "seq")


def latest_cases(spark: SparkSession, sf: str) -> DataFrame:
    """The last record of each case, with the place at which it was first stored."""
    cases = table(spark, sf, "cases").withColumn("number", case_number(F.col("number")))
    return logs.latest_per_key(cases, "number", "seq").select("number", "seq", "first_seq", F.size("documents").alias("n_documents"))


def processed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Listed cases against fetched ones: what is completed, and the ledger row of each that isn't."""
    rows = table(spark, sf, "search_rows").groupBy("number").agg(F.max("ca").alias("ca")).where("number is not null")
    known = table(spark, sf, "cases").select(case_number(F.col("number")).alias("number")).distinct()
    errors = table(spark, sf, "failed_cases").groupBy(case_number(F.col("detail.casenumber")).alias("number")).agg(F.max("reason").alias("error")).where("number is not null")
    done, failures = collection.process_rows(rows, known, errors)
    return done.select("number", F.lit("completed").alias("outcome"), F.lit(None).cast("string").alias("reason")).unionByName(failures.select(F.col("key").alias("number"), F.col("type").alias("outcome"), "reason"))


def pdf_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Where the file of each document is kept."""
    d = table(spark, sf, "cases").select("seq", case_number(F.col("number")).alias("number"), F.posexplode("documents").alias("pos", "d"))
    return d.select("seq", "pos", S.pdf_path(F.lit("pdfs"), F.col("number"), F.col("d.date"), F.col("d.kind"), F.col("d.name"), F.coalesce("d.download.idprocessodocumento", F.lit("0"))).alias("path"))


def missing_files(spark: SparkSession, sf: str) -> DataFrame:
    """The documents whose file isn't stored yet."""
    d = table(spark, sf, "cases").select("seq", F.posexplode("documents").alias("pos", "d")).where("d.localpath is not null")
    stored = table(spark, sf, "pdf_files").where("removedat is null and n_bytes > 0 and path is not null").select(file_path(F.col("path")).alias("path"))
    return files.to_download(d.select("seq", "pos", "d.localpath"), F.col("localpath"), stored).select("seq", "pos", "path")


def download_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What responses to downloads come to: fetched, or why not and whether it is worth another try."""
    r = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    status = F.when(F.col("l_quantity") < 5, 429).when(F.col("l_quantity") < 8, 404).when(F.col("l_quantity") < 10, 503).otherwise(200)
    kind = F.when(F.col("l_returnflag") == "R", "text/html").when(F.col("l_returnflag") == "A", "Application/PDF; x=1")
    kind = F.coalesce(kind, F.when(F.col("l_partkey") % 3 > 0, F.lit("application/pdf")))
    body = F.when(F.col("l_partkey") % 5 == 0, F.lit("<html>")).otherwise(F.lit("%PDF-1.7")).cast("binary")
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", files.outcome(status, kind, body).alias("o")).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "o.ok", "o.reason", "o.retryable")


def party_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a parties table put together from the party rows and read back."""
    p = table(spark, sf, "party_rows").where("name is not null")
    line = F.concat(
        F.col("name"), F.coalesce(F.concat(F.lit(" - OAB "), "oab"), F.lit("")), F.coalesce(F.concat(F.lit(" - "), "doc_kind", F.lit(": "), "doc_value"), F.lit("")),
        F.coalesce(F.concat(F.lit(" ("), "role", F.lit(")  ")), F.lit("")),
    )
    x = p.select("party_id", S.party_line(line, F.col("status")).alias("p")).where("p is not null")
    return x.select("party_id", "p.name", "p.role", F.col("p.document.kind").alias("doc_kind"), F.col("p.document.value").alias("doc_value"), "p.oab", "p.status")


def dated_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of a movements table put together from the movements and read back; undated ones are left out."""
    m = table(spark, sf, "cases").select("seq", F.posexplode("movements").alias("pos", "m")).where("m.description is not null")
    day = S.to_form_date(F.col("m.date"))
    entry = F.concat(F.coalesce(day, F.lit("")), F.when(F.col("pos") % 2 == 0, " 10:00:00").otherwise(""), F.lit(" - "), "m.description")
    return m.select("seq", "pos", S.dated_entry(entry).alias("e")).where("e is not null").select("seq", "pos", "e.date", "e.text")


def waits(spark: SparkSession, sf: str) -> DataFrame:
    """Waits the server asks for, by seconds or by date, and what a pause between requests has left."""
    e = table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("now"), "value", F.col("ts").cast("timestamp").alias("t"))
    later = F.date_format(F.timestamp_seconds(F.floor(F.col("now") / 1000) + F.col("event_id") % 90 - 20), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    header = F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 100).cast("string")).when(F.col("event_id") % 4 == 1, later).when(F.col("event_id") % 4 == 2, "soon")
    before = F.when(F.col("event_id") % 3 > 0, F.col("now") - F.col("event_id") % 2500)
    return e.select("event_id", S.retry_after_ms(header, F.col("now")).alias("asked_ms"), S.throttle_wait_ms(F.col("now"), before, 1500).alias("pause_ms"))


def cap_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Whether days of events are capped, by count and by a warning, and where the two disagree."""
    d = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("v"))
    return d.select("day", "event_type", capped.cap_signal(F.col("n"), F.col("v") > 150, 60).alias("s")).select("day", "event_type", "s.*")


def page_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Whether fetched pages are those asked for, and how many a table has."""
    p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    kind = F.when(F.col("l_returnflag") == "R", "slider").otherwise("datascroller")
    first = F.when(F.col("l_suppkey") % 4 > 0, (F.col("l_linenumber") - 1) * 10 + F.col("l_suppkey") % 2)
    slid = F.when(F.col("l_suppkey") % 3 > 0, F.col("l_linenumber") + F.col("l_partkey") % 2)
    declared = F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey") % 97)
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", checks.page_advanced(kind, F.col("l_linenumber"), F.lit(10), first, slid).alias("advanced"),
        checks.page_plan(declared, F.lit(10), F.col("l_linenumber")).alias("pages"),
    )


def search_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Windows as the fields of the search form, in order."""
    w = table(spark, sf, "class_catalog").select("ord", F.col("class_id"), F.when(F.col("ord") % 5 > 0, F.col("class_name")).alias("class_name"))
    party = F.element_at(F.array(*map(F.lit, FILTERS)), (F.col("ord") % 15 + 1).cast("int"))
    fields = S.search_fields(F.lit("2025-03-05"), F.lit("2025-03-14"), F.col("class_id"), F.col("class_name"), party, ["from", "to", "classId", "className", "party"])
    return w.select("ord", F.posexplode(fields).alias("pos", "f")).select("ord", "pos", "f.name", "f.value")


def download_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The address of each document, and its parts read back out of it."""
    d = table(spark, sf, "cases").select("seq", F.posexplode("documents").alias("pos", "d")).select("seq", "pos", "d.download.*")
    ref = F.struct(F.col("idbin").alias("idBin"), F.col("numerodocumento").alias("numeroDocumento"), F.col("nomearqprocdocbin").alias("nomeArqProcDocBin"), F.col("idprocessodocumento").alias("idProcessoDocumento"), F.col("actionmethod").alias("actionMethod"))
    url = S.download_url(F.lit("https://example.org/view.seam"), ref)
    return d.select("seq", "pos", url.alias("url")).select("seq", "pos", *(S.query_parameter(F.col("url"), n).alias(n) for n in ("idBin", "numeroDocumento", "nomeArqProcDocBin", "idProcessoDocumento", "other")))


def latin1_values(spark: SparkSession, sf: str) -> DataFrame:
    """File names of a query string that were encoded as Latin-1, decoded."""
    n = table(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("Inspe%E7%E3o+"), "n_name", F.lit("%20%zz%2")).alias("raw"))
    return n.select("n_nationkey", S.decode_latin1_query(F.col("raw")).alias("value"))


def text_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """Case numbers, subjects, tokens, joined lines and ledger keys taken from texts."""
    r = table(spark, sf, "search_rows").select("seq", "number", "ca", "subject", "parties")
    text = F.concat(F.lit("Processo "), F.coalesce("number", F.lit("?")), F.lit(" e "), F.coalesce("number", F.lit("?")))
    link = F.concat(F.lit("openPopUp('x','/listView.seam?ca="), F.coalesce("ca", F.lit("-")), F.lit("&y=1')"))
    return r.select(
        "seq", S.extract_case_number(text).alias("case_number"), S.extract_token(link).alias("token"), S.subject_after_number(F.concat(F.lit(" - "), "subject")).alias("subject"),
        S.joined_lines(F.col("parties")).alias("lines"), S.document_key(F.col("number"), F.col("ca")).alias("ledger_key"),
    )


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Which failures are worth another try: by their status, by the network's code, by what was thrown."""
    f = table(spark, sf, "failed_documents").where("record_type = 'failure'").select("seq", "httpstatus", "reason", "attempt")
    code = F.element_at(F.array(*map(F.lit, ["ECONNRESET", "ENOENT", "EPIPE", "EAI_AGAIN"])), (F.col("seq") % 4 + 1).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ["RateLimited", "ParseError", "BreakerOpen", "SessionExpired"])), (F.col("seq") % 4 + 1).cast("int"))
    thrown = files.thrown_outcome(kind, F.col("reason"))
    return f.select(
        "seq", S.is_retryable_status(F.col("httpstatus")).alias("by_status"), S.is_transient(code).alias("by_code"), thrown["reason"].alias("thrown"), thrown["retryable"].alias("by_error"),
        collection.next_failure(F.col("attempt"))["retryable"].alias("again"),
    )


def decoded_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Response bodies as text, UTF-8 or Latin-1, with lower-case header names."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 2 == 0, "Ação: ").otherwise("").alias("a"))
    text = F.concat("a", "p_name")
    body = F.when(F.col("p_partkey") % 4 == 0, F.encode(text, "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    r = S.response_to_text(F.create_map(F.lit("Content-Type"), F.col("p_name")), body)
    return p.select("p_partkey", r.alias("r")).select("p_partkey", F.col("r.headers")["content-type"].alias("content_type"), "r.text")


def progress_records(spark: SparkSession, sf: str) -> DataFrame:
    """What a progress log keeps of the final events: the numbers of their rows; other events leave no record."""
    o = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("number"), "o_orderstatus"))).alias("rows"), F.min("o_orderstatus").alias("s")
    )
    kind = F.when(F.col("s") == "F", "window").when(F.col("s") == "O", "capped").otherwise("abandoned")
    kept = o.withColumn("type", kind).where(F.col("type").isin(*FINAL_EVENTS))
    return kept.select("day", "type", F.array_join(S.listed_numbers(F.col("rows")).cast("array<string>"), ",").alias("numbers"))


def alphabet_filter(spark: SparkSession, sf: str) -> DataFrame:
    """How many party names each filter of the alphabet finds."""
    names = table(spark, sf, "party_rows").where("name is not null").select(F.upper("name").alias("name"), F.posexplode(F.array(*map(F.lit, FILTERS))).alias("ord", "filter"))
    return names.where(S.matches_filter(F.col("name"), F.col("filter"))).groupBy("ord", "filter").agg(F.count(F.lit(1)).alias("n"))


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One line of text for each kind of event."""
    e = table(spark, sf, "events").where("event_id < 4000")
    kinds = ["window", "capped", "unsplittable", "covered", "abandoned", "skipped", "rejected", "case-detailed", "case-failed", "document-downloaded", "document-failed", "retry"]
    rows = e.select(
        "event_id", F.element_at(F.array(*map(F.lit, kinds)), (F.col("event_id") % 12 + 1).cast("int")).alias("type"), F.concat(F.lit("day "), "event_type").alias("label"), (F.col("event_id") % 31).alias("shown"),
        F.lit("class").alias("split_by"), (F.col("user_id") % 50).alias("union_size"), (F.col("user_id") % 15).alias("filters_tried"), F.col("event_type").alias("message"),
    )
    return rows.select("event_id", collection.event_line().alias("line"))


def open_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The keys that are open after a stream of failures and successes, from the state changes it gave out."""
    from sievemill.streaming import streams

    at = scratch(spark)
    stream = scratch_stream(spark, sf).where("event_type in ('error', 'purchase')").select("user_id", "event_type", F.col("event_id").alias("at"))
    out = streams.open_failures(stream, "user_id", "event_type", "at", "error", "purchase")
    drain(out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").outputMode("append"), spark)
    changes = spark.read.schema(out.schema).parquet(f"{at}/out")
    return changes.groupBy("user_id").agg(F.max_by("open", "at").alias("open")).where("open").select("user_id")


def response_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A log of responses as the client acts on it: tried again, failed, aborted after too many refusals."""
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", 429).when(F.col("event_type") == "click", 503).otherwise(200).alias("status"))
    return collection.request_log(e, "user_id", "event_id", "status", 1, 3).select("user_id", "event_id", "retry", "failed", "aborted")


QUERIES = {f.__name__: f for f in (
    window_keys, keyed_windows, routed_rows, first_listings, latest_cases, processed_rows, pdf_paths, missing_files, download_outcomes, party_lines, dated_entries, waits, cap_signals,
    page_checks, search_forms, download_urls, latin1_values, text_extracts, statuses, decoded_bodies, progress_records, alphabet_filter, event_lines, open_keys, response_runs,
)}

_DAY_CLASS = "select distinct strftime(ts, '%Y-%m-%d') as day, nullif(event_type, 'error') as class_id from events"


def _squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SQUASH}', ' ', 'g'))"


def _sane(x: str) -> str:
    safe = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}._-]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), '^\\.+', '')"
    return f"(case when {safe} = '' then '_' else {safe} end)"


_ROLE, _OAB, _TAX = r"\(([^()]+)\)\s*$", r"OAB\s+([A-Z]{2}\d+[A-Z]?)", r"(CPF|CNPJ):\s*([\d./-]+)"
_LINE = "name || coalesce(' - OAB ' || oab, '') || coalesce(' - ' || doc_kind || ': ' || doc_value, '') || coalesce(' (' || role || ')  ', '')"
_DATED = r"^(\d{2})/(\d{2})/(\d{4})(?:\s+\d{2}:\d{2}:\d{2})?\s*-\s*((?s:.)+)$"
_DETAIL_NUMBER = number("detail.casenumber")

ORACLES = {
    "window_keys": f"""
with w as (select day, class_id, case when class_id = 'view' then strftime(cast(day as date) + 1, '%Y-%m-%d') else day end as until, case when class_id = 'click' then 'DA S' end as party from ({_DAY_CLASS}))
select day, coalesce(class_id, '-') as class_id,
  '{{"from":"' || day || '","to":"' || until || '","judicialClassId":' || coalesce('"' || class_id || '"', 'null') || ',"partyName":' || coalesce('"' || party || '"', 'null') || '}}' as key,
  case when day = until then day else day || '..' || until end || coalesce(' class=' || class_id, '') || coalesce(' party=' || party, '') as label from w""",
    "keyed_windows": """
with w as (select strftime(ts, '%Y-%m-%d') as day, nullif(event_type, 'error') as c, max(value) as v from events group by 1, 2)
select '{"from":"' || day || '","to":"' || day || '","judicialClassId":' || coalesce('"' || c || '"', 'null') || ',"partyName":null}' as key from w where v <= 224""",
    "routed_rows": f"""
select number, case when number in (select {number('number')} from cases where number is not null) then 'download' else 'detail' end as step
from (select distinct {number('number')} as number from search_rows where number is not null)""",
    "first_listings": "select number, arg_min(ca, seq) filter (where true) as ca, min(seq) as seq from search_rows group by number",
    "latest_cases": f"""
select number, seq, first_seq, coalesce(len(documents), -1) as n_documents from (
  select {number('number')} as number, seq, documents, min(seq) over (partition by {number('number')}) as first_seq, row_number() over (partition by {number('number')} order by seq desc) as r from cases) where r = 1""",
    "processed_rows": f"""
with r as (select distinct number from search_rows where number is not null), k as (select distinct {number('number')} as number from cases),
e as (select {_DETAIL_NUMBER} as number, max(reason) as error from failed_cases where detail.casenumber is not null group by 1)
select number, 'completed' as outcome, null as reason from r where number in (select number from k where number is not null)
union all select r.number, 'failure', coalesce(e.error, 'no response') from r left join e on e.number = r.number where r.number not in (select number from k where number is not null)""",
    "pdf_paths": f"""
with d as (select seq, number, cast(i.i as integer) as pos, documents[i.i + 1] as d from (select seq, {number('number')} as number, documents from cases) c, lateral (select unnest(range(0, len(documents))) as i) i)
select seq, pos, 'pdfs/' || {_sane('number')} || '/' || {_sane("coalesce(nullif(d.date, ''), 'undated')")} || '_' || substring({_sane("coalesce(nullif(d.kind, ''), nullif(d.name, ''), 'documento')")}, 1, 80)
  || '_' || {_sane("coalesce(d.download.idprocessodocumento, '0')")} || '.pdf' as path from d""",
    "missing_files": f"""
with d as (select seq, cast(i.i as integer) as pos, documents[i.i + 1].localpath as p from cases c, lateral (select unnest(range(0, len(documents))) as i) i)
select seq, pos, path from (select seq, pos, {path('p')} as path from d where p is not null)
where path not in (select {path('path')} from pdf_files where removedat is null and n_bytes > 0 and path is not null)""",
    "download_outcomes": """
with r as (
  select l_orderkey, l_linenumber, l_partkey, l_quantity, case when l_quantity < 5 then 429 when l_quantity < 8 then 404 when l_quantity < 10 then 503 else 200 end as status,
    case when l_returnflag = 'R' then false when l_returnflag = 'A' then true else l_partkey % 3 > 0 end as said, l_partkey % 5 > 0 as pdf from lineitem),
x as (select *, case when status <> 200 then 'HTTP ' || status when not said then 'not a PDF' when not pdf then 'no PDF content' end as reason from r)
select l_orderkey, l_linenumber, l_partkey, l_quantity, reason is null as ok, reason, status in (429, 502, 503, 504) as retryable from x""",
    "party_lines": f"""
with l as (select party_id, status, {_squash(_LINE)} as t from party_rows where name is not null),
b as (select *, trim(regexp_replace(t, '{_ROLE}', '')) as body from l),
x as (select *, trim(regexp_replace(trim(regexp_replace(body, '(?s)(?:{_OAB}|{_TAX}).*$', '')), '-\\s*$', '')) as name from b)
select party_id, name, trim(regexp_extract(t, '{_ROLE}', 1)) as role, nullif(regexp_extract(body, '{_TAX}', 1), '') as doc_kind,
  case when regexp_matches(body, '{_TAX}') then regexp_extract(body, '{_TAX}', 2) end as doc_value, nullif(regexp_extract(body, '{_OAB}', 1), '') as oab, nullif(status, '') as status from x where name <> ''""",
    "dated_entries": f"""
with m as (select seq, cast(i.i as integer) as pos, movements[i.i + 1] as m from cases, lateral (select unnest(range(0, len(movements))) as i) i),
t as (select seq, pos, coalesce(case when len(string_split(m.date, '-')) = 3 and not list_contains(string_split(m.date, '-'), '') then string_split(m.date, '-')[3] || '/' || string_split(m.date, '-')[2] || '/' || string_split(m.date, '-')[1] end, '')
  || case when pos % 2 = 0 then ' 10:00:00' else '' end || ' - ' || m.description as t from m where m.description is not null)
select seq, pos, regexp_extract(t, '{_DATED}', 3) || '-' || regexp_extract(t, '{_DATED}', 2) || '-' || regexp_extract(t, '{_DATED}', 1) as date, trim(regexp_extract(t, '{_DATED}', 4)) as text from t where regexp_matches(t, '{_DATED}')""",
    "waits": """
with e as (select event_id, epoch_us(ts) // 1000 as now from events)
select event_id, cast(case when event_id % 4 = 0 then (event_id % 100) * 1000 when event_id % 4 = 1 then greatest(0, (now // 1000 + event_id % 90 - 20) * 1000 - now) else 0 end as bigint) as asked_ms,
  cast(case when event_id % 3 > 0 then greatest(0, 1500 - event_id % 2500) else 0 end as bigint) as pause_ms from e""",
    "cap_signals": """
select day, event_type, n >= 60 or v > 150 as capped, v > 150 as by_text, n >= 60 as by_count, (n >= 60) <> (v > 150) as disagree
from (select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, max(value) as v from events group by 1, 2)""",
    "page_checks": """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  case when l_returnflag = 'R' then l_suppkey % 3 = 0 or l_partkey % 2 = 0 else l_suppkey % 4 = 0 or l_suppkey % 2 = 0 end as advanced,
  cast(case when l_partkey % 3 > 0 then ceil((l_partkey % 97) / 10.0) else l_linenumber end as bigint) as pages from lineitem""",
    "search_forms": f"""
with c as (select ord, class_id, case when ord % 5 > 0 then class_name end as class_name, {FILTERS!r}[ord % 15 + 1] as party from class_catalog)
select ord, 0 as pos, 'from' as name, '05/03/2025' as value from c union all select ord, 1, 'to', '14/03/2025' from c
union all select ord, 2, 'classId', case when class_id is not null and class_name is not null then class_id else '' end from c
union all select ord, 3, 'className', case when class_id is not null and class_name is not null then class_name else '' end from c union all select ord, 4, 'party', party from c""",
    "download_urls": """
with d as (select seq, cast(i.i as integer) as pos, documents[i.i + 1].download as d from cases, lateral (select unnest(range(0, len(documents))) as i) i)
select seq, pos, d.idbin as "idBin", d.numerodocumento as "numeroDocumento", d.nomearqprocdocbin as "nomeArqProcDocBin", d.idprocessodocumento as "idProcessoDocumento", cast(null as varchar) as other from d""",
    "latin1_values": "select n_nationkey, 'Inspeção ' || n_name || ' %zz%2' as value from nation",
    "text_extracts": f"""
select seq, nullif(regexp_extract('Processo ' || coalesce(number, '?'), '(\\d{{7}}-\\d{{2}}\\.\\d{{4}}\\.\\d\\.\\d{{2}}\\.\\d{{4}})', 1), '') as case_number, nullif(regexp_extract(coalesce(ca, '-') || '&', '^([0-9a-fA-F]+)', 1), '') as token,
  nullif(trim(regexp_replace(trim(' - ' || subject), '^-\\s*', '')), '') as subject,
  array_to_string(list_filter(list_transform(string_split(parties, chr(10)), lambda x: {_squash('x')}), lambda x: x <> ''), '; ') as lines, number || '::' || ca as ledger_key from search_rows""",
    "statuses": """
select seq, coalesce(httpstatus in (429, 502, 503, 504), false) as by_status, seq % 4 <> 1 as by_code, ['RateLimited', 'ParseError', 'BreakerOpen', 'SessionExpired'][seq % 4 + 1] || ': ' || coalesce(reason, '') as thrown,
  seq % 4 in (0, 2) as by_error, attempt + 1 < 3 as again from failed_documents where record_type = 'failure'""",
    "decoded_bodies": "select p_partkey, p_name as content_type, case when p_partkey % 2 = 0 then 'Ação: ' else '' end || p_name as text from part",
    "progress_records": """
select day, case when s = 'F' then 'window' else 'abandoned' end as type, numbers from (
  select strftime(o_orderdate, '%Y-%m-%d') as day, min(o_orderstatus) as s, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as numbers from orders group by 1) where s <> 'O'""",
    "alphabet_filter": f"""
with f as (select unnest(range(0, 15)) as ord, unnest({FILTERS!r}) as filter)
select cast(ord as integer) as ord, filter, count(*) as n from f join party_rows on contains(upper(name), split_part(filter, ' ', 1)) and contains(upper(name), split_part(filter, ' ', 2)) group by 1, 2""",
    "event_lines": """
with e as (select event_id, event_id % 12 as k, 'day ' || event_type as label, event_id % 31 as shown, user_id % 50 as u, user_id % 15 as f, event_type as message from events where event_id < 4000)
select event_id, case k when 0 then 'search ' || label || ' -> ' || shown || ' rows' when 1 then 'search ' || label || ' -> ' || shown || ' rows (capped, splitting by class)'
  when 2 then 'search ' || label || ' -> ' || shown || ' rows (capped, unsplittable)' when 3 then 'cover ' || label || ' -> ' || u || ' cases (' || f || ' filters, plateaued)'
  when 4 then 'cover ' || label || ' -> ' || u || ' cases (' || f || ' filters, abandoned)' when 5 then 'search ' || label || ' skipped (already covered)' when 6 then 'search ' || label || ' rejected: ' || message
  when 7 then 'detail ' || label when 8 then 'detail ' || label || ' failed: ' || message when 9 then 'document ' || label when 10 then 'document ' || label || ' failed: ' || message
  when 11 then 'retry ' || label || ': ' || message end as line from e""",
    "open_keys": "select user_id from (select user_id, arg_max(event_type, event_id) as last from events where event_type in ('error', 'purchase') group by 1) where last = 'error'",
    "response_runs": """
with e as (select user_id, event_id, event_type in ('error', 'click') as bad, event_type = 'error' as lim from events),
m as (select *, sum(case when bad then 0 else 1 end) over w as b, sum(case when lim then 0 else 1 end) over w as l from e window w as (partition by user_id order by event_id)),
r as (select *, sum(case when bad then 1 else 0 end) over (partition by user_id, b order by event_id) as bad_run, sum(case when lim then 1 else 0 end) over (partition by user_id, l order by event_id) as lim_run from m),
a as (select *, bool_or(lim_run >= 3) over (partition by user_id order by event_id) as aborted from r)
select user_id, event_id, bad and bad_run <= 1 and not aborted as retry, bad and bad_run > 1 as failed, aborted from a""",
}
