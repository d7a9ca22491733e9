"""The SQL of the core queries, for a second engine to check them."""

from __future__ import annotations

SQUASH = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def _halving(rows: str, day: str, cap: int) -> str:
    return f"""
with recursive c as (select cast({day} as date) as d, count(*) as n from {rows} where {day} is not null group by 1),
w(lo, hi, depth, path) as (
  select min(d), max(d), 0, '' from c
  union all
  select case when h.k = 0 then w.lo + cast(datediff('day', w.lo, w.hi) // 2 + 1 as integer) else w.lo end,
         case when h.k = 0 then w.hi else w.lo + cast(datediff('day', w.lo, w.hi) // 2 as integer) end,
         w.depth + 1, w.path || cast(h.k as varchar)
  from w, (values (0), (1)) h(k)
  where w.lo < w.hi and (select coalesce(sum(n), 0) from c where d between w.lo and w.hi) >= {cap}
),
v as (select w.*, (select coalesce(sum(n), 0) from c where d between w.lo and w.hi) as n from w)
select strftime(lo, '%Y-%m-%d') as from_day, strftime(hi, '%Y-%m-%d') as to_day, depth, path, cast(n as bigint) as n,
       cast(least(n, {cap}) as bigint) as shown,
       case when n < {cap} then 'window' when lo < hi then 'capped' else 'saturated' end as kind
from v"""


def _classes(rows: str, day: str, cls: str) -> str:
    return f"""
with b as (select strftime({day}, '%Y-%m-%d') as day, {cls} as class_id from {rows}),
days as (select day from b group by day having count(*) >= 30),
cat as (select class_id, cast(row_number() over (order by class_id) - 1 as integer) as ord from (select distinct class_id from b)),
n as (select day, class_id, count(*) as n from b group by 1, 2)
select d.day, c.class_id, c.ord, cast(coalesce(n.n, 0) as bigint) as n, cast(least(coalesce(n.n, 0), 30) as bigint) as shown,
       case when coalesce(n.n, 0) < 30 then 'window' else 'saturated' end as kind
from days d cross join cat c left join n on n.day = d.day and n.class_id = c.class_id"""


_LINE_CLASSES = _classes("lineitem", "l_shipdate", "l_returnflag")
_EVENT_CLASSES = _classes("events", "ts", "event_type")
COVER_FILTERS = "(values (1,'k','1'),(2,'k','2'),(3,'k','3'),(4,'k','4'),(5,'k','5'),(6,'k','6'),(7,'k','7'),(8,'k','8'),(9,'k','9'),(10,'k','0'),(11,'1','2'),(12,'3','4'),(13,'5','6'),(14,'7','8'),(15,'9','0')) f(ord, a, b)"
_COVER = f"""
with e as (select strftime(ts, '%Y-%m-%d') as day, event_type, event_id, props from events),
leaf as (select day, event_type from e group by 1, 2 having count(*) >= 30),
b as (select e.* from e join leaf using (day, event_type)),
hits as (
  select day, event_type, event_id, 0 as ord from b
  union all select b.day, b.event_type, b.event_id, f.ord from b join {COVER_FILTERS} on contains(b.props, f.a) and contains(b.props, f.b)
),
ranked as (select *, row_number() over (partition by day, event_type, ord order by event_id) as rk from hits),
firsts as (select day, event_type, event_id, min(ord) as ord from ranked where rk <= 30 group by 1, 2, 3),
news as (select day, event_type, ord, count(*) as news from firsts group by 1, 2, 3),
sizes as (select day, event_type, ord, count(*) as n from hits group by 1, 2, 3),
steps as (
  select l.day, l.event_type, o.ord, coalesce(w.news, 0) as news, coalesce(s.n, 0) as n
  from leaf l cross join (select unnest(range(0, 16)) as ord) o
  left join news w on w.day = l.day and w.event_type = l.event_type and w.ord = o.ord
  left join sizes s on s.day = l.day and s.event_type = l.event_type and s.ord = o.ord
),
isles as (select *, sum(case when news > 0 then 1 else 0 end) over (partition by day, event_type order by ord) as isle from steps),
streaks as (
  select *, sum(case when news = 0 and n < 30 and ord > 0 then 1 else 0 end) over (partition by day, event_type, isle order by ord) as streak,
         sum(news) over (partition by day, event_type order by ord) as union_size
  from isles
),
stops as (select day, event_type, min(case when streak >= 5 then ord end) as stop from streaks group by 1, 2)
"""

ORACLES = {
    "window_filter": "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders where o_orderdate between timestamp '1995-03-10' and timestamp '1995-03-14'",
    "capped_topk": """
select day, l_orderkey, l_linenumber, l_partkey, n, n >= 30 as capped from (
  select strftime(l_shipdate, '%Y-%m-%d') as day, l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_shipdate) as n,
         row_number() over (partition by l_shipdate order by l_orderkey, l_linenumber, l_partkey) as rk from lineitem) where rk <= 30""",
    "date_cascade": _halving("orders", "o_orderdate", 30),
    "class_split": _LINE_CLASSES,
    "class_split_deep": _EVENT_CLASSES,
    "class_split_check": f"""
select src || ' ' || day as src_day, cast(sum(shown) as bigint) as children_rows, sum(shown) >= 30 as ok
from (select 'lineitem' as src, day, shown from ({_LINE_CLASSES}) union all select 'events', day, shown from ({_EVENT_CLASSES})) group by src, day""",
    "party_filter": """
select f.a || ' ' || f.b as filter, p_partkey from part join (values ('co', 'wi'), ('re', 'in'), ('bo', 'ue')) f(a, b) on contains(p_name, f.a) and contains(p_name, f.b)""",
    "party_cover": _COVER + """
select t.day, t.event_type, case when stop is not null then 'covered' else 'abandoned' end as kind,
       cast(coalesce(stop, 15) as integer) as filters_tried, cast(s.union_size as bigint) as union_size
from stops t join streaks s on s.day = t.day and s.event_type = t.event_type and s.ord = coalesce(stop, 15)""",
    "cover_budget": _COVER.replace("range(0, 16)", "range(0, 9)") + """
select t.day, t.event_type, case when stop is not null then 'covered' else 'abandoned' end as kind,
       cast(coalesce(stop, 8) as integer) as filters_tried, cast(s.union_size as bigint) as union_size
from stops t join streaks s on s.day = t.day and s.event_type = t.event_type and s.ord = coalesce(stop, 8)""",
    "partition_sums": f"select path, n, n as halves_n, cast(2 as bigint) as halves from ({_halving('orders', 'o_orderdate', 30)}) where kind = 'capped'",
    "sweep_dedup": _COVER + """
select f.event_id as number, cast(min(f.ord) as integer) as ord from firsts f join stops t on t.day = f.day and t.event_type = f.event_type
where f.ord <= coalesce(t.stop, 15) and f.event_id % 10 <> 0 group by 1""",
    "latest_wins": "select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by event_id desc) = 1",
    "first_seen_last_value": "select user_id, max_by(value, event_id) as value, min(event_id) as first_seq from events group by 1",
    "pending_queue": """
select user_id, max(event_id) as event_id, min(event_id) as first_seq from events
where event_type = 'view' and user_id not in (select user_id from events where event_type = 'purchase' and value > 113) group by 1""",
    "retry_ledger": """
select user_id, event_id, value from (select * from events where event_type in ('error', 'purchase')
  qualify row_number() over (partition by user_id order by event_id desc) = 1) where event_type = 'error' and value > 20""",
    "retry_cap": "select user_id, count(*) + 1 as attempt, count(*) + 1 < 3 as retryable from events where event_type = 'error' group by 1",
    "seen_set": """
select distinct unnest(numbers) as o_orderkey from (
  select list(o_orderkey) as numbers, min(o_orderstatus) as type from orders group by cast(o_orderdate as date)) where type <> 'O'""",
    "covered_windows": """
with w as (select distinct strftime(ts, '%Y-%m-%d') as day, nullif(event_type, 'error') as class_id from events),
d as (select distinct strftime(ts, '%Y-%m-%d') as day, nullif(event_type, 'error') as class_id from events where value > 224)
select w.day, coalesce(w.class_id, '-') as class_id from w where not exists (
  select 1 from d where d.day = w.day and d.class_id is not distinct from w.class_id)""",
    "case_documents": """
select o_orderkey, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity) - 1 as integer) as pos,
       l_linenumber, l_partkey, l_quantity from orders join lineitem on o_orderkey = l_orderkey""",
    "page_reconcile": """
with p as (select l_orderkey, count(*) as declared, count(*) filter (where l_quantity < 49) as fetched from lineitem group by 1)
select l_orderkey, cast((declared + 2) // 3 as bigint) as pages, cast(least(fetched, ((declared + 2) // 3) * 3) as bigint) as collected,
       declared, declared = least(fetched, ((declared + 2) // 3) * 3) as matches from p""",
    "budget_cut": """
select o_orderkey, cost, cast(spent_before as bigint) as spent_before from (
  select o_orderkey, cost, coalesce(sum(cost) over (order by o_orderkey rows between unbounded preceding and 1 preceding), 0) as spent_before
  from orders join (select l_orderkey, count(*) as cost from lineitem group by 1) on o_orderkey = l_orderkey) where spent_before < 5000""",
    "breaker_runs": """
with m as (select user_id, event_type = 'error' as hit, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) as isle from events),
r as (select user_id, isle, count(*) as n from m where hit group by 1, 2)
select user_id, max(n) as longest, count(*) filter (where n >= 3) as trips from r group by 1 having max(n) >= 3""",
    "history_start": "select cast(greatest(min(year(o_orderdate)), 1996) as integer) as first_year, cast(1996 as integer) as floor from orders where year(o_orderdate) <= 2001",
    "squash_text": f"select doc_id, trim(regexp_replace(text, '{SQUASH}', ' ', 'g')) as squashed from documents where text is not null",
    "sanitise_segment": r"""
with v as (
  select p_partkey as id, '.' || p_name || ' / ' || p_brand as raw from part
  union all select doc_id, concat_ws('//', source, kind, docdate) from documents),
s as (select id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '[^\p{L}\p{N}._-]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), '^\.+', '') as x from v)
select id, case when x = '' then '_' else x end as segment from s""",
    "date_strings": """
select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as form, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%m/%Y') as month,
       cast(datediff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as epoch from orders""",
    "backoff": """
select attempt, cast(case when attempt % 3 = 0 then least(attempt * 9000, 60000) else least(1000 * power(2, attempt - 1), 60000) end as bigint) as delay_ms
from (select unnest(range(1, 13)) as attempt)""",
    "stream_dedup": "select distinct user_id from events",
    "stream_latest": """
with u as (select * from events where event_type <> 'purchase' qualify row_number() over (partition by user_id order by event_id desc) = 1),
d as (select user_id, max(event_id) as e from events where event_type = 'purchase' group by 1)
select u.user_id, u.event_id, u.event_type, u.value from u left join d on d.user_id = u.user_id where d.e is null or d.e < u.event_id""",
}

_INSTANT = "cast(replace({}, ' ', 'T') as timestamptz)"
_NUMBER = (
    "case when length(regexp_replace({0}, '[^0-9]', '', 'g')) = 20 then regexp_replace(regexp_replace({0}, '[^0-9]', '', 'g'), "
    "'^(\\d{{7}})(\\d{{2}})(\\d{{4}})(\\d)(\\d{{2}})(\\d{{4}})$', '\\1-\\2.\\3.\\4.\\5.\\6') else trim({0}) end"
)


def instant(column: str) -> str:
    """An ISO string of the tables as an instant in SQL."""
    return _INSTANT.format(column)


def number(column: str) -> str:
    """A canonical case number in SQL."""
    return _NUMBER.format(column)


_PATH = (
    "nfc_normalize(regexp_replace(regexp_replace(regexp_replace(trim({0}), '\\\\', '/', 'g'), '/(\\.?/)+', '/', 'g'), '^(\\./)+', ''))"
)



def path(column: str) -> str:
    """One spelling per file in SQL."""
    return _PATH.format(column)


ORACLES["p2_found"] = f"""
with c as (
  select 'failed_documents' as ledger, ledger_key, record_type, {instant('recordedat')} as instant, attempt, seq from failed_documents
  union all select 'failed_cases', ledger_key, record_type, {instant('recordedat')}, attempt, seq from failed_cases)
select ledger, ledger_key, seq from c
qualify row_number() over (partition by ledger, ledger_key order by instant desc, coalesce(attempt, -1) desc, seq) = 1 and record_type = 'failure'"""

ORACLES["p4_found"] = f"""
with k as (select seq, {number('number')} as number, {instant('extractedat')} as instant, documents from cases),
f as (select seq, {number('detail.casenumber')} as number, detail.documentid as doc, {instant('recordedat')} as instant from failed_documents where record_type = 'failure'),
by_case as (select number, min(instant) as first_at from k group by 1),
d as (select k.seq, k.number, k.instant, cast(i.i as integer) as pos, documents[i.i + 1] as d from k, lateral (select unnest(range(0, len(documents))) as i) i),
by_doc as (select number, d.download.idprocessodocumento as doc, min(instant) as first_at from d where d.download.idprocessodocumento is not null group by 1, 2),
by_file as (select {_PATH.format('path')} as path, min(case when removedat is null then storedat end) as first_at, count(*) filter (where removedat is null) as alive from pdf_files where path is not null group by 1),
a as (
  select 'failed_documents' as tbl, 'casenumber' as field, f.seq, 0 as pos, f.instant,
         case when c.number is null then 'missing' when c.first_at > f.instant then 'late' end as state
  from f left join by_case c on c.number = f.number where f.number is not null),
b as (
  select 'failed_documents', 'documentid', f.seq, 0, f.instant, case when x.number is null then 'missing' when x.first_at > f.instant then 'late' end
  from f left join by_doc x on x.number = f.number and x.doc = f.doc
  where f.doc is not null and f.number is not null and f.seq not in (select seq from a where state is not null)),
p as (
  select 'cases', 'localpath', d.seq, d.pos, d.instant, case when y.path is null then 'missing' when y.alive = 0 then 'deleted' when y.first_at > d.instant then 'late' end
  from d left join by_file y on y.path = {_PATH.format('d.localpath')} where d.localpath is not null)
select tbl, field, seq, pos, state, strftime(instant at time zone 'UTC', '%Y-%m') as month_utc
from (select * from a union all select * from b union all select * from p) where state is not null"""

ORACLES["p4_report"] = f"select tbl, field, state, month_utc, count(*) as n from ({ORACLES['p4_found']}) group by all"


def _unstring(x: str) -> str:
    return f"(case when json_type({x}) = 'VARCHAR' then case when json_valid({x} ->> '$') then cast({x} ->> '$' as json) end else {x} end)"


_EMPTY = "cast([] as json[])"
ORACLES["p6_found"] = rf"""
with l as (select line_id, regexp_replace(line, '^[\s\x{{FEFF}}\x{{00A0}}]+|[\s\x{{FEFF}}\x{{00A0}}]+$', '', 'g') as t from case_lines),
j as (select line_id, cast(t as json) as j from l where json_valid(t)),
r0 as (select line_id, coalesce({_unstring("json_extract(j, '$.case')")}, {_unstring("json_extract(j, '$.record')")}, j) as r from j where json_type(j) = 'OBJECT'),
f0 as (select line_id, n.child, json_extract(r, '$.' || n.name) as v from r0, (values ('activeparties', 'activeParties'), ('passiveparties', 'passiveParties'), ('movements', 'movements'), ('documents', 'documents')) n(child, name) where json_type(r) = 'OBJECT'),
f as (select line_id, child, {_unstring('v')} as v from f0),
i as (
  select line_id, child, case
    when json_type(v) = 'ARRAY' then json_extract(v, '$[*]')
    when json_type(v) = 'OBJECT' and json_type(json_extract(v, '$.pages')) = 'ARRAY' then flatten(list_transform(
      list_sort(list_transform(json_extract(v, '$.pages[*]'), lambda p, k: {{'n': coalesce(try_cast(p ->> '$.page' as bigint), k - 1), 'k': k, 'r': json_extract({_unstring("json_extract(p, '$.rows')")}, '$[*]')}})), lambda x: coalesce(x.r, {_EMPTY})))
    when json_type(v) = 'OBJECT' and json_type({_unstring("json_extract(v, '$.items')")}) = 'ARRAY' then json_extract({_unstring("json_extract(v, '$.items')")}, '$[*]')
    when json_type(v) = 'OBJECT' then [v] end as items from f),
e as (select line_id, child, cast(g.g as integer) as pos, items[g.g + 1] as e from i, lateral (select unnest(range(0, len(items))) as g) g),
d as (select line_id, pos, {_unstring("json_extract(e, '$.download')")} as d from e where child = 'documents' and json_type(e) = 'OBJECT')
select line_id, child, pos from e where json_type(e) = 'OBJECT' and len(json_keys(e)) > 0
union all select line_id, 'downloads', pos from d where json_type(d) = 'OBJECT' and len(list_filter(json_keys(d), lambda k: json_type(json_extract(d, '$."' || k || '"')) <> 'NULL')) > 0"""
