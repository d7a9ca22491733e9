"""Queries of the page readers, logs and stores: pages are made from the given tables and read back; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.functions.text import case_number
from sievemill.operators import logs
from sievemill.plans.core_sql import SQUASH, number
from sievemill.session import scratch, table
from sievemill.sources import ndjson, pages
from sievemill.sources.store import Store

#: Rows a page of a table shows.
SIZE = 10


def _esc(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _cat(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Result pages of thirty rows made from all search rows, read back: every field of every row with a number and a token."""
    r = table(spark, sf, "search_rows")
    row = _cat(
        "<tr><td><a onclick=\"openPopUp('x','/listView.seam?ca=", _esc(F.col("ca")), "')\">open</a></td><td>", _esc(F.col("judicialclass")), " <b>Cls ", _esc(F.col("number")), " - ",
        _esc(F.col("subject")), "</b> ", _esc(F.col("parties")), "</td><td>", _esc(F.col("lastmovement")), "</td></tr>",
    )
    made = r.select(F.floor(F.col("seq") / 30).alias("page"), F.struct("seq", row.alias("row")).alias("r")).groupBy("page").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    html = _cat('<table id="f:processosTable"><tbody>', F.array_join(F.transform("rows", lambda x: x["row"]), "\n"), "</tbody></table>")
    return made.select("page", F.posexplode(pages.result_rows_udf(html)).alias("pos", "x")).select("page", "pos", "x.*")


def catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The class catalog made to an answer of the search form and read back: the first name of each id."""
    row = _cat("<tr><td></td><td>", _esc(F.col("class_id")), "</td><td> </td><td>", _esc(F.col("class_name")), "</td></tr>")
    c = table(spark, sf, "class_catalog").select(F.struct("ord", "class_id", row.alias("row")).alias("r")).agg(F.array_sort(F.collect_list("r")).alias("rows"))
    answer = F.array_join(F.transform("rows", lambda x: x["row"]), "")
    return c.select(F.explode(pages.class_catalog_udf(answer)).alias("c")).select("c.*")


def search_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Search pages with more and fewer rows, with warnings and messages: what each says."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    row = F.lit("<tr><td><a onclick=\"o('/listView.seam?ca=ab12')\">o</a></td><td><b>0000001-23.2025.4.05.0000</b></td></tr>")
    html = F.concat(
        F.lit('<table id="f:processosTable"><tbody>'), F.repeat(row, (F.col("n_nationkey") * 3).cast("int")), F.lit("</tbody></table>"),
        F.when(F.col("n_nationkey") % 4 == 1, F.lit("muitos processos")).otherwise(""), F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit('<dl class="rich-messages"><dt></dt><dd> '), "n_name", F.lit(" </dd></dl>"))).otherwise(""),
    )
    out = pages.search_response(n.withColumn("html", html), "html", "muitos processos")
    return out.select("n_nationkey", F.size("rows").alias("n_rows"), "message", "cap.*", pages.session_expired(F.col("html"), F.lit("search")).alias("expired"))


def form_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of a page's form, its view token, and the body that asks for its second page."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    html = F.concat(
        F.lit('<form id="other"><input name="z" value="0"></form><form action="x" id="j_1"><input name="a" value="'), _esc(F.col("n_name")), F.lit('"><input type="submit" name="b" value="1">'),
        F.lit('<input type="hidden" name="javax.faces.ViewState" value="v'), F.col("n_nationkey").cast("string"), F.lit('"><input name="javax.faces.ViewState" value="again">'), F.lit('<input name="j_1:s" value="1"><input type="radio" name="r" value="1"></form>'),
    )
    made = n.withColumn("html", html)
    fields = made.select("n_nationkey", pages.view_token(F.col("html")).alias("token"), pages.outer_form_id(F.lit("j_1:s:x")).alias("form"), F.posexplode(pages.form_fields_udf("j_1")("html")).alias("pos", "f"))
    return fields.select("n_nationkey", "token", "form", "pos", "f.name", "f.value")


def pagers(spark: SparkSession, sf: str) -> DataFrame:
    """The pagers of the four tables of a page, some with a slider, some with a scroller, some with neither."""
    r = table(spark, sf, "nation").select("n_nationkey")
    k = F.col("n_nationkey")
    scroller = lambda name: F.concat(
        F.lit('<table class="dr rich-dtascroller-table"><tr>'), F.array_join(F.transform(F.sequence(F.lit(1), (k % 7 + 1).cast("int")), lambda i: F.concat(F.lit('<td class="rich-datascr-inact">'), i.cast("string"), F.lit("</td>"))), ""),
        F.lit(f"</tr></table><script>new Richfaces.Datascroller('j:{pages.TABLES[name]}:sc', function(event){{A4J.AJAX.Submit('j:base',event)}})</script>"),
    )
    slider = F.concat(F.lit("""<script>new Richfaces.Slider("j:s",{'minValue':'1','maxValue':'"""), (k % 5 + 2).cast("string"), F.lit("""','onchange':'A4J.AJAX.Submit(\\'j:form\\',event,{\\'parameters\\':{\\'j:ev\\':\\'j:ev\\'}})'})</script>"""))
    html = F.concat(
        F.lit(f'<table id="j:{pages.TABLES["activeParties"]}"></table>'), scroller("activeParties"), F.lit(f'<table id="j:{pages.TABLES["passiveParties"]}"></table>'),
        F.lit(f'<table id="j:{pages.TABLES["movements"]}"></table>'), F.when(k % 3 > 0, slider).otherwise(""), F.lit(f'<table id="j:{pages.TABLES["documents"]}"></table>'), F.when(k % 2 > 0, slider).otherwise(scroller("documents")),
    )
    p = r.withColumn("p", pages.all_pagers_udf(html))
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("tbl"), F.col(f"p.{t}").alias("p")) for t in pages.TABLES))).alias("e")
    return p.select("n_nationkey", each).where("e.p is not null").select("n_nationkey", "e.tbl", F.col("e.p.kind").alias("kind"), F.col("e.p.baseId").alias("base"), F.col("e.p.pageFieldId").alias("field"), F.col("e.p.eventFieldId").alias("event"), F.col("e.p.pageCount").alias("pages"))


def _details(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Detail pages of all cases, long movements on further pages; some sealed, broken, of another number, or paged wrongly."""
    c = table(spark, sf, "cases").select("seq", case_number(F.col("number")).alias("number"), "subject", "jurisdiction", "referencecase", "activeparties", "passiveparties", "movements", "documents", "sealed")
    view = lambda label, value: _cat(f'<div class="propertyView"><div class="name"><label>{label}</label></div><div class="value">', _esc(value), "</div></div>")
    kinds = {f.name: f.dataType for f in c.schema.fields}
    c_type = lambda name: kinds[name].simpleString()
    items = lambda name: F.coalesce(F.col(name), F.array().cast(c_type(name)))
    total = lambda name: _cat(F.size(items(name)).cast("string"), " resultados encontrados")

    def parties(name: str, table_: str) -> Column:
        rows = F.transform(items(name), lambda p, i: _cat(
            f'<tr id="x:{pages.TABLES[table_]}:', i.cast("string"), ':y"><td><span><div class="col-sm-12">&#160;<span>', _esc(p["name"]), " (", _esc(F.coalesce(p["role"], F.lit("X"))), ")</span></div></span></td><td>", _esc(p["status"]), "</td></tr>"
        ))
        return _cat(f'<table id="j:{pages.TABLES[table_]}"><tbody>', F.array_join(rows, ""), "</tbody></table>", total(name))

    def moves(part: Column) -> Column:
        rows = F.transform(part, lambda m: _cat("<tr><td>01/02/2025 10:00:00 - ", _esc(m["description"]), "x</td></tr>"))
        return _cat(f'<table id="j:{pages.TABLES["movements"]}"><tbody>', F.array_join(rows, ""), "</tbody></table>")

    files = F.transform(items("documents"), lambda d: _cat(
        '<tr><td><a href="/x?idBin=', F.url_encode(F.coalesce(d["download"]["idbin"], F.lit("0"))), "&numeroDocumento=1&nomeArqProcDocBin=a&idProcessoDocumento=", F.url_encode(F.coalesce(d["download"]["idprocessodocumento"], F.lit("0"))),
        '&actionMethod=m">01/02/2025 10:00:00 - Peça (', _esc(F.coalesce(F.nullif(F.trim(F.translate(d["kind"], "()", "")), F.lit("")), F.lit("k"))), ")</a></td></tr>",
    ))
    slider = _cat(
        """<script>new Richfaces.Slider("j:s",{'minValue':'1','maxValue':'""", F.ceil(F.size(items("movements")) / SIZE).cast("string"),
        """','onchange':'A4J.AJAX.Submit(\\'j:form\\',event,{\\'parameters\\':{\\'j:ev\\':\\'j:ev\\'}})'})</script>""",
    )
    declared = F.when(F.col("seq") % 11 == 0, F.lit("9999 resultados encontrados")).otherwise(total("movements"))
    whole = F.concat(
        F.lit(f"<h1>{pages.HEADING}</h1>"), view("Número Processo", F.when(F.col("seq") % 17 > 0, F.col("number"))), view("Assunto", F.col("subject")), view("Jurisdição", F.col("jurisdiction")), view("Processo referência", F.col("referencecase")),
        parties("activeparties", "activeParties"), parties("passiveparties", "passiveParties"), moves(F.slice(items("movements"), 1, SIZE)), declared, slider,
        F.lit(f'<table id="j:{pages.TABLES["documents"]}"><tbody>'), F.array_join(files, ""), F.lit("</tbody></table>"),
    )
    html = F.when(F.col("sealed"), '<dl class="rich-messages"><dd>Processo em segredo de justiça</dd></dl>').when(F.col("seq") % 19 == 0, "<pre>PSQLException</pre>").otherwise(whole)
    first = c.select(F.col("seq").alias("ca"), F.lit(None).cast("string").alias("table_id"), F.lit(1).alias("page"), html.alias("html"))
    more = c.where(F.size(items("movements")) > SIZE).select("seq", items("movements").alias("m"), F.explode(F.sequence(F.lit(2), F.ceil(F.size(items("movements")) / SIZE).cast("int"))).alias("page"))
    shown = F.when((F.col("seq") % 13 == 0) & (F.col("page") == 2), 1).otherwise(F.col("page"))
    further = more.select(F.col("seq").alias("ca"), F.lit("movements").alias("table_id"), "page", F.concat(moves(F.slice("m", (F.col("page") - 1) * SIZE + 1, F.lit(SIZE))), F.lit("<script>x={'sliderValue':'"), shown.cast("string"), F.lit("'}</script>")).alias("html"))
    expected = c.select(F.col("seq").alias("ca"), F.when(F.col("seq") % 23 == 0, "0000000-00.0000.0.00.0000").otherwise(F.col("number")).alias("number"))
    return pages.assemble_cases(first.unionByName(further), expected)


def assembled_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Cases put together from their captured pages: header and children."""
    good, _ = _details(spark, sf)
    return good.select(
        "ca", "number", "subject", "jurisdiction", "referenceCase", "sealed", F.size("activeParties").alias("n_active"), F.size("passiveParties").alias("n_passive"), F.size("movements").alias("n_movements"),
        F.array_join(F.transform("movements", lambda m: m["description"]), "|").alias("descriptions"), F.array_join(F.transform("documents", lambda d: F.concat_ws(" ", d["date"], d["name"], d["kind"], d["download"]["idProcessoDocumento"])), "|").alias("documents"),
    )


def assembly_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The cases whose pages don't add up, with the first reason."""
    return _details(spark, sf)[1].select("ca", "error")


def log_views(spark: SparkSession, sf: str) -> DataFrame:
    """Views of users written as NDJSON in two batches and read back: the last line of each user."""
    at = f"{scratch(spark)}/log"
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"))
    ndjson.write_log(e.where("event_id % 2 = 0"), at, 1)
    ndjson.write_log(e.where("event_id % 2 = 1").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"), F.max("event_id").alias("event_id")), at, 2)
    log = ndjson.read_log(spark, at, "user_id bigint, event_id bigint, event_type string")
    latest = logs.latest_per_key(log, "user_id", "seq")
    # Within the first batch a user's lines have no order of their own; only users of the second batch are compared.
    return latest.where("event_id % 2 = 1").select("user_id", "event_id", "event_type")


def _store(spark: SparkSession, sf: str) -> Store:
    """A store filled in the order of a run: rows and final events, cases, failures."""
    store = Store(spark, scratch(spark))
    listed = table(spark, sf, "search_rows").select("number", "ca", F.col("judicialclass").alias("judicialClass"), "subject", "parties", F.col("lastmovement").alias("lastMovement"), "seq")
    days = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("numbers"), F.min("o_orderkey").alias("seq"))
    none = F.lit(None).cast("string")
    query = F.struct(F.col("d").alias("from"), F.col("d").alias("to"), none.alias("judicialClassId"), none.alias("judicialClassName"), none.alias("partyName"))
    kind = F.when(F.col("seq") % 3 == 0, "abandoned").when(F.col("seq") % 3 == 1, "covered").otherwise("window")
    events = days.where("seq % 4 > 0").select(kind.alias("type"), query.alias("query"), F.lit(1).alias("depth"), F.col("numbers").alias("cnjNumbers"), F.lit(None).cast("int").alias("filtersTried"), F.lit(None).cast("int").alias("unionSize"), none.alias("recordedAt"), "seq")
    store.record_final(1, events, listed)
    cases = table(spark, sf, "cases").select(case_number(F.col("number")).alias("number"), "ca", "seq")
    empty = spark.createDataFrame([], schemas.RELATIONS["cases"])
    store.complete(1, empty.unionByName(cases.where("seq % 2 = 0"), allowMissingColumns=True))
    store.append("failed_cases", 1, table(spark, sf, "failed_cases").select(
        F.col("record_type").alias("type"), F.col("ledger_key").alias("key"), "reason", F.col("httpstatus").alias("httpStatus"), "attempt", "retryable",
        F.struct(F.col("detail.casenumber").alias("caseNumber"), F.col("detail.ca").alias("ca")).alias("detail"), F.col("recordedat").alias("recordedAt"), "seq",
    ))
    return store


def store_pending(spark: SparkSession, sf: str) -> DataFrame:
    """The rows a store still has queued after its cases were completed."""
    return _store(spark, sf).pending().select("number", "ca", "seq", "first_seq")


def store_progress(spark: SparkSession, sf: str) -> DataFrame:
    """The windows of a store that have to be searched again, and how many numbers it has seen."""
    store = _store(spark, sf)
    days = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).distinct()
    none = F.lit(None).cast("string")
    windows = days.select(F.struct(F.col("d").alias("from"), F.col("d").alias("to"), none.alias("judicialClassId"), none.alias("judicialClassName"), none.alias("partyName")).alias("query"))
    seen = store.seen().agg(F.count(F.lit(1)).alias("n_seen"))
    return store.uncovered(windows).select(F.col("query.from").alias("day"), F.lit(1).alias("k")).join(seen.withColumn("k", F.lit(1)), "k").drop("k")


def store_retryable(spark: SparkSession, sf: str) -> DataFrame:
    """The open case failures of a store, laid flat, that belong to a case it hasn't stored."""
    store = _store(spark, sf)
    open_rows = store.retryable("failed_cases").withColumn("number", case_number(F.col("caseNumber")))
    stored = store.has_case(open_rows.select("number").where("number is not null").distinct())
    return open_rows.join(stored, "number", "left_anti").select("key", "reason", "attempt", "caseNumber", "ca", "first_seq")


QUERIES = {f.__name__: f for f in (
    page_rows, catalog_rows, search_responses, form_bodies, pagers, assembled_cases, assembly_errors, log_views, store_pending, store_progress, store_retryable,
)}


def _squash(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{SQUASH}', ' ', 'g')), '')"


_ASSEMBLED = f"""
with c as (select seq, {number('number')} as number, subject, jurisdiction, referencecase, coalesce(activeparties, []) as a, coalesce(passiveparties, []) as p, coalesce(movements, []) as m, coalesce(documents, []) as d, coalesce(sealed, false) as sealed from cases),
j as (
  select *, case when sealed then null when seq % 19 = 0 then 'database error page' when seq % 17 = 0 or not regexp_matches(coalesce(number, ''), '\\S') then 'no case number'
    when seq % 23 = 0 or {_squash('number')} <> number then 'another case number' when seq % 11 = 0 and (9999 + len(m) - 1) // greatest(least(len(m), {SIZE}), 1) > 500 and len(m) > 0 then null end as e0 from c),
k as (
  select *, case when sealed then null when e0 is not null then e0
    when seq % 11 = 0 and len(m) > 0 and ceil(9999.0 / least(len(m), {SIZE})) > 500 then 'movements: ' || cast(ceil(9999.0 / least(len(m), {SIZE})) as bigint) || ' pages are too many'
    when seq % 13 = 0 and len(m) > {SIZE} then 'movements: page 2 isn''t the one asked for' when seq % 11 = 0 then 'movements: rows differ from the declared total' end as error from j)
"""
_PARTY_NAMES = "len(list_filter({0}, lambda x: regexp_matches(coalesce(x.name, ''), '[^\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{3000}}\\x{{FEFF}}]')))"
_STORE_CASES = f"select {number('number')} as number from cases where seq % 2 = 0"

ORACLES = {
    "page_rows": f"""
with r as (select seq // 30 as page, seq, number, ca, judicialclass, subject, parties, lastmovement from search_rows
  where regexp_matches(number, '\\d{{7}}-\\d{{2}}\\.\\d{{4}}\\.\\d\\.\\d{{2}}\\.\\d{{4}}') and regexp_matches(ca, '^[0-9a-fA-F]'))
select page, cast(row_number() over (partition by page order by seq) - 1 as integer) as pos, number, regexp_extract(ca, '^[0-9a-fA-F]+') as ca, {_squash('judicialclass')} as "judicialClass", {_squash('subject')} as subject,
  {_squash('parties')} as parties, {_squash('lastmovement')} as "lastMovement" from r""",
    "catalog_rows": f"""
with c as (select class_id, {_squash('class_name')} as name, ord from class_catalog where regexp_matches(class_id, '^[0-9]+$') and regexp_matches(class_name, '\\S')),
f as (select class_id, arg_min(name, ord) as name, min(ord) as o from c group by 1)
select class_id as id, name, cast(row_number() over (order by o) - 1 as integer) as ord from f""",
    "search_responses": """
select n_nationkey, n_nationkey * 3 as n_rows, case when n_nationkey % 5 = 0 then n_name end as message, n_nationkey * 3 >= 30 or n_nationkey % 4 = 1 as capped, n_nationkey % 4 = 1 as by_text,
  n_nationkey * 3 >= 30 as by_count, (n_nationkey * 3 >= 30) <> (n_nationkey % 4 = 1) as disagree, true as expired from nation""",
    "form_bodies": """
select n_nationkey, 'v' || n_nationkey as token, 'j_1' as form, f.pos, f.name, case f.pos when 0 then n_name when 1 then 'v' || n_nationkey else '1' end as value
from nation, (values (0, 'a'), (1, 'javax.faces.ViewState'), (2, 'j_1:s')) f(pos, name)""",
    "pagers": f"""
select n_nationkey, 'activeParties' as tbl, 'datascroller' as kind, 'j:base' as base, 'j:{pages.TABLES["activeParties"]}:sc' as field, null as event, n_nationkey % 7 + 1 as pages from nation
union all select n_nationkey, 'movements', 'slider', 'j:form', 'j:s', 'j:ev', n_nationkey % 5 + 2 from nation where n_nationkey % 3 > 0
union all select n_nationkey, 'documents', 'slider', 'j:form', 'j:s', 'j:ev', n_nationkey % 5 + 2 from nation where n_nationkey % 2 > 0
union all select n_nationkey, 'documents', 'datascroller', 'j:base', 'j:{pages.TABLES["documents"]}:sc', null, n_nationkey % 7 + 1 from nation where n_nationkey % 2 = 0""",
    "assembled_cases": _ASSEMBLED + f"""
select seq as ca, case when sealed and seq % 23 = 0 then '0000000-00.0000.0.00.0000' else number end as number, case when not sealed then {_squash('subject')} end as subject, case when not sealed then {_squash('jurisdiction')} end as jurisdiction,
  case when not sealed then {_squash('referencecase')} end as "referenceCase", sealed, cast(case when sealed then 0 else {_PARTY_NAMES.format('a')} end as integer) as n_active,
  cast(case when sealed then 0 else {_PARTY_NAMES.format('p')} end as integer) as n_passive, cast(case when sealed then 0 else len(m) end as integer) as n_movements,
  case when sealed then '' else array_to_string(list_transform(m, lambda x: {_squash("coalesce(x.description, '') || 'x'")}), '|') end as descriptions,
  case when sealed then '' else array_to_string(list_transform(d, lambda x: '2025-02-01 Peça ' || {_squash("coalesce(nullif(trim(translate(x.kind, '()', '')), ''), 'k')")} || ' ' || coalesce(x.download.idprocessodocumento, '0')), '|') end as documents
from k where error is null""",
    "assembly_errors": _ASSEMBLED + "select seq as ca, error from k where error is not null",
    "log_views": """
select user_id, max(event_id) as event_id, nullif(arg_max(event_type, event_id), 'error') as event_type from events where event_id % 2 = 1 group by 1""",
    "store_pending": f"""
select number, ca, seq, first_seq from (select number, ca, seq, min(seq) over (partition by number) as first_seq, row_number() over (partition by number order by seq desc) as r from search_rows)
where r = 1 and (number is null or number not in (select number from ({_STORE_CASES}) where number is not null))""",
    "store_progress": """
with d as (select strftime(o_orderdate, '%Y-%m-%d') as day, min(o_orderkey) as seq from orders group by 1)
select day, (select count(distinct o_orderkey) from orders join d on d.day = strftime(o_orderdate, '%Y-%m-%d') where d.seq % 4 > 0) as n_seen from d where seq % 4 = 0 or seq % 3 = 0""",
    "store_retryable": f"""
with o as (select * from (select *, min(seq) over (partition by ledger_key) as first_seq, row_number() over (partition by ledger_key order by seq desc) as r from failed_cases) where r = 1 and record_type = 'failure' and retryable)
select ledger_key as key, reason, attempt, detail.casenumber as "caseNumber", detail.ca, first_seq from o
where detail.casenumber is null or {number('detail.casenumber')} not in (select number from ({_STORE_CASES}) where number is not null)""",
}
