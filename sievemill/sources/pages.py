"""Captured pages to records.

Each reader is a plain function from a page to values, and a Pandas UDF of
the same name with ``_udf`` for columns. A null page has no records. One page
that can't be read gives empty values and never fails a job.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote, unquote_to_bytes

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.functions.scalars import dated_entry, party_line
from sievemill.operators.checks import page_advanced, page_plan
from sievemill.session import cut
from sievemill.sources import scripts
from sievemill.sources.markup import Element, squash, table_rows, tree

#: Table id endings of a detail page. Fixed values.
TABLES = {
    "activeParties": "processoPartesPoloAtivoResumidoList",
    "passiveParties": "processoPartesPoloPassivoResumidoList",
    "movements": "processoEvento",
    "documents": "processoDocumentoGridTab",
}
RESULTS = "processosTable"
#: Header labels of a detail page and the fields they hold. Fixed values.
LABELS = {
    "Número Processo": "number", "Data da Distribuição": "filingDate", "Classe Judicial": "judicialClass",
    "Assunto": "subject", "Jurisdição": "jurisdiction", "Processo referência": "referenceCase",
}
#: What pages say. Fixed values.
HEADING = "Dados do Processo"
_SEALED = re.compile(r"segredo de justi[çc]a|autos? sigiloso", re.I)
_DATABASE = re.compile(r"PSQLException|SQLException|Stacktrace completo", re.I)
_NUMBER = re.compile(r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}")


def _root(html: str | Element | None) -> Element:
    """A page's tree; readers also take one that is there already."""
    return html if isinstance(html, Element) else tree(html or "")


def result_rows(html: str | None) -> list[dict]:
    """The rows of a result page that have both a token and a case number."""
    out = []
    for row in table_rows(_root(html), RESULTS):
        link = row.find(lambda e: "onclick" in e.attrs and re.search(r"(?i)listview\.seam\?ca=[0-9a-f]+", e.attrs["onclick"]) is not None)
        cells = row.kids("td")
        if link is None or len(cells) < 2:
            continue
        found = packed_cell(cells[1])
        if not found.get("number"):
            continue
        token = re.search(r"(?i)listview\.seam\?ca=([0-9a-f]+)", link.attrs["onclick"]).group(1)
        last = cells[2].text() if len(cells) > 2 else ""
        out.append({"number": found["number"], "ca": token, "judicialClass": found.get("judicialClass"), "subject": found.get("subject"), "parties": found.get("parties"), "lastMovement": last or None})
    return out


def packed_cell(cell: Element) -> dict[str, str]:
    """Class before the bold part, number and subject in it, parties after it."""
    bold = cell.find(lambda e: e.name == "b")
    inside, whole = (bold.text() if bold else ""), cell.text()
    source = inside or whole
    m = _NUMBER.search(source)
    if m is None:
        return {}
    before, _, after = whole.partition(inside) if inside else ("", "", "")
    values = {"number": m.group(), "subject": re.sub(r"^-\s*", "", source[m.end() :].strip()).strip(), "judicialClass": before.strip(), "parties": after.strip()}
    return {k: v for k, v in values.items() if v}


def rejection_message(html: str | None) -> str | None:
    """The first text of a message panel, null without one."""
    panels = _root(html).find_all(lambda e: e.name == "dl" and e.has_class("rich-messages") or e.name == "span" and e.has_class("rich-messages-label"))
    return next((t for t in (p.text() for p in panels) if t), None)


def class_catalog(html: str | None) -> list[dict]:
    """The classes of an autocomplete answer: a numeric id and a name per row, the first of an id holds."""
    out: dict[str, dict] = {}
    for row in tree(f"<table>{html or ''}</table>").find_all(lambda e: e.name == "tr"):
        cells = [t for t in (c.text() for c in row.kids("td")) if t]
        if len(cells) >= 2 and cells[0].isdigit() and cells[0] not in out:
            out[cells[0]] = {"id": cells[0], "name": cells[1], "ord": len(out)}
    return list(out.values())


def page_kind(html: str | None, root: Element | None = None) -> dict[str, str | None]:
    """sealed (said in the notice panel only), detail (has the heading) or unexpected with a reason."""
    text = html or ""
    panels = (root or tree(text)).find_all(lambda e: e.name == "dl" and e.has_class("rich-messages") or e.name == "span" and e.has_class("rich-messages-label"))
    notice = " ".join(p.text() for p in panels)
    if _SEALED.search(notice):
        return {"kind": "sealed", "reason": None}
    if HEADING in text:
        return {"kind": "detail", "reason": None}
    return {"kind": "unexpected", "reason": "database error page" if _DATABASE.search(text) else "no detail panel"}


def case_header(html: str | Element | None) -> dict[str, str | None]:
    """The labelled values of the header; the two cells without a label are told by what they say."""
    out: dict[str, str | None] = dict.fromkeys(["number", *schemas.HEADER_FIELDS])
    for view in _root(html).find_all(lambda e: e.has_class("propertyView")):
        name = view.find(lambda e: e.has_class("name"))
        label = name.find(lambda e: e.name == "label").text() if name and name.find(lambda e: e.name == "label") else ""
        box = view.find(lambda e: e.has_class("value"))
        value = box.text() if box else ""
        if not value:
            continue
        if label == "Assunto":
            out["subject"] = "; ".join(t for t in map(squash, box.raw_text().split("\n")) if t)
        elif label == "Data da Distribuição":
            out["filingDate"] = re.sub(r"^(\d{2})/(\d{2})/(\d{4})$", r"\3-\2-\1", value)
        elif label in LABELS:
            out[LABELS[label]] = value
        elif not label and "Endereço" in value:
            body, _, address = value.partition("Endereço")
            out["court"] = body.replace("Órgão Julgador Colegiado", "").strip() or out["court"]
            out["address"] = address.strip() or out["address"]
        elif not label and "Órgão Julgador" in value:
            out["judgingBody"] = value.partition("Órgão Julgador")[2].strip() or out["judgingBody"]
    return out


def party_lines(html: str | Element | None, table: str) -> list[dict[str, str]]:
    """One side's participants as ``line`` and ``status``: the first span of each row's block, and the row's second cell."""
    out = []
    for row in table_rows(_root(html), TABLES[table]):
        cells = row.kids("td")
        block = cells[0].find(lambda e: e.name == "div" and e.has_class("col-sm-12")) if len(cells) >= 2 else None
        spans = block.kids("span") if block else []
        if spans:
            out.append({"line": spans[0].text(), "status": cells[1].text()})
    return out


def movement_lines(html: str | Element | None) -> list[str]:
    """The first cells of the movements table."""
    return [row.kids("td")[0].text() for row in table_rows(_root(html), TABLES["movements"]) if row.kids("td")]


def latin1_value(raw: str) -> str:
    return unquote_to_bytes(bytes(ord(c) & 0xFF for c in raw.replace("+", " "))).decode("latin-1")


def document_links(html: str | Element | None) -> list[dict]:
    """The download links that carry all their ids, as ``text`` and ``download``."""
    out = []
    for row in table_rows(_root(html), TABLES["documents"]):
        link = row.find(lambda e: e.name == "a" and "idBin=" in e.attrs.get("href", ""))
        if link is None:
            continue
        query = link.attrs["href"].partition("?")[2].partition("?")[0]
        values: dict[str, str] = {}
        for pair in query.split("&"):
            k, _, v = pair.partition("=")
            values.setdefault(k, v)
        if not all(k in values for k in ("idBin", "numeroDocumento", "idProcessoDocumento", "actionMethod")):
            continue
        ref = {k: unquote(values[k].replace("+", " "), errors="replace") for k in ("idBin", "numeroDocumento", "idProcessoDocumento", "actionMethod")}
        ref["nomeArqProcDocBin"] = latin1_value(values.get("nomeArqProcDocBin", ""))
        out.append({"text": link.text(), "download": ref})
    return out


def stretch(root: Element, table: str) -> list[Element | str]:
    """What follows a table's first id in the page, up to the first id of another table."""
    own, others = TABLES[table], tuple(v for k, v in TABLES.items() if k != table)
    out: list[Element | str] = []
    for n in root.nodes():
        ident = n.attrs.get("id", "") if isinstance(n, Element) else ""
        if out and ident.endswith(others):
            break
        if out or ident.endswith(own):
            out.append(n)
    return out


def _declared(texts: list[str]) -> int | None:
    before, found, _ = "".join(texts).partition("resultados encontrados")
    digits = re.search(r"[0-9]+$", before.rstrip()) if found else None
    return int(digits.group()) if digits else None


def _first_index(root: Element, table: str) -> int | None:
    """The number after the table's name in the first attribute that has one."""
    for e in root.walk():
        for value in e.attrs.values():
            index, colon, _ = value.partition(f"{TABLES[table]}:")[2].partition(":")
            if colon and index.isdigit():
                return int(index)
    return None


def page_facts(html: str | Element | None, table: str) -> dict:
    """What a page says of a table: rows of any kind, the declared total, the first row's index, the slider's value, its pager and page count."""
    root = _root(html)
    slid = next((v for n in root.nodes() if isinstance(n, str) and "sliderValue" in n and (v := scripts.text_after(list(scripts.tokens(n)), "sliderValue"))), None)
    found = _pager(root, table)
    return {
        "rows": len(table_rows(root, TABLES[table])), "declared": _declared([n for n in stretch(root, table) if isinstance(n, str)]), "firstIndex": _first_index(root, table),
        "sliderValue": int(slid) if slid is not None and slid.isdigit() else None, "pager": found and found["kind"], "pageCount": found and found["pageCount"],
    }


def _slider(root: Element, table: str) -> dict | None:
    """A slider registered in the table's stretch: its own id, and the form and event named by the submission it makes when moved."""
    for n in stretch(root, table):
        for call in scripts.calls(n, "Richfaces.Slider") if isinstance(n, str) else ():
            listed = scripts.texts(call)
            action = next((x for x in listed if "A4J.AJAX.Submit(" in x), "")
            submit = next(scripts.calls(action, "A4J.AJAX.Submit"), [])
            event, highest = scripts.text_after(submit, "parameters"), scripts.text_after(call, "maxValue")
            if listed and event and highest is not None and highest.isdigit():
                return {"kind": "slider", "baseId": scripts.texts(submit)[0], "pageFieldId": listed[0], "eventFieldId": event, "pageCount": int(highest)}
    return None


def _scroller(root: Element, table: str) -> dict | None:
    """The scroller whose id holds the table's name; pages are counted by the links of the scroller table last begun before it."""
    links: list[int] | None = None
    for n in root.nodes():
        if isinstance(n, Element):
            if n.has_class("rich-dtascroller-table"):
                links = []
            elif links is not None and (n.has_class("rich-datascr-act") or n.has_class("rich-datascr-inact")) and n.text().isdigit():
                links.append(int(n.text()))
            continue
        for call in scripts.calls(n, "Richfaces.Datascroller"):
            ident, base = next(iter(scripts.texts(call)), ""), scripts.text_after(call, "Submit")
            if TABLES[table] in ident and base:
                return {"kind": "datascroller", "baseId": base, "pageFieldId": ident, "eventFieldId": None, "pageCount": max(links or [1])}
    return None


def _pager(root: Element, table: str) -> dict | None:
    return _slider(root, table) or _scroller(root, table)


def read_page(html: str | None) -> dict:
    """All that a detail page or a further page of one of its tables says, from one reading of it."""
    root = tree(html or "")
    return {
        "kind": page_kind(html, root), "h": case_header(root), "activeParties": party_lines(root, "activeParties"), "passiveParties": party_lines(root, "passiveParties"),
        "movements": movement_lines(root), "documents": document_links(root), "facts": {table: page_facts(root, table) for table in TABLES},
    }


def pager(html: str | None, table: str) -> dict | None:
    """How a table is paged: a slider if there is one, else a scroller, else null."""
    return _pager(_root(html), table)


def all_pagers(html: str | None) -> dict[str, dict | None]:
    """The pagers of the four tables of a detail page."""
    root = _root(html)
    return {table: _pager(root, table) for table in TABLES}


def search_component(html: str | None) -> str | None:
    """The id under which the search form submits itself, null if the page doesn't say."""
    for n in _root(html).nodes():
        if isinstance(n, str) and "executarPesquisa" in n:
            submit = next(scripts.calls(n[n.index("executarPesquisa") :], "A4J.AJAX.Submit"), [])
            return scripts.text_after(submit, "parameters")
    return None


def form_fields(html: str | None, form_id: str) -> list[dict[str, str]]:
    """The submitted inputs of a form in their order; of the view token only the first."""
    text = html or ""
    start = text.rfind("<form", 0, text.find(f'id="{form_id}"')) if f'id="{form_id}"' in text else -1
    if start < 0:
        return []
    out, token = [], False
    for e in tree(text[start:]).find_all(lambda e: e.name == "input" and e.attrs.get("name")):
        if e.attrs.get("type", "text").lower() in ("submit", "button", "image", "checkbox", "radio"):
            continue
        name = e.attrs["name"]
        if name == "javax.faces.ViewState":
            if token:
                continue
            token = True
        out.append({"name": name, "value": e.attrs.get("value", "")})
    return out


def paging_body(page_pager: dict, page: int, fields: list[dict[str, str]]) -> list[dict[str, str]]:
    """The fields of a page request: all fields again, the page field set, and the widget's own field."""
    target = page_pager["pageFieldId"]
    body = [{"name": "AJAXREQUEST", "value": "_viewRoot"}]
    body += [{**f, "value": str(page)} if f["name"] == target else f for f in fields]
    if all(f["name"] != target for f in fields):
        body.append({"name": target, "value": str(page)})
    slider = page_pager["kind"] == "slider"
    body.append({"name": page_pager["eventFieldId"] if slider else "ajaxSingle", "value": page_pager["eventFieldId"] if slider else target})
    return [*body, {"name": "AJAX:EVENTS_COUNT", "value": "1"}]


def view_token(html: Column) -> Column:
    """The view token of a page, null without one."""
    return F.nullif(F.regexp_extract(html, r'name="javax\.faces\.ViewState"[^>]*value="([^"]*)"', 1), F.lit(""))


def outer_form_id(base_id: Column) -> Column:
    return F.split_part(base_id, F.lit(":"), F.lit(1))


def _udf(reader: Callable, ddl: str) -> Callable[[Column], Column]:
    """A column function of a reader; the UDF is made when it is used, as a session must exist."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(reader, na_action=None)

    return lambda column: F.pandas_udf(run, ddl)(column)


def _struct_udf(reader: Callable, ddl: str) -> Callable[[Column], Column]:
    names = list(reader(None))

    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([reader(p) for p in pages], columns=names)

    # With annotations Spark would take the return type for the kind of function it is.
    return lambda column: F.pandas_udf(run, ddl)(column)


_ROW_DDL = "struct<number:string,ca:string,judicialClass:string,subject:string,parties:string,lastMovement:string>"
result_rows_udf = _udf(result_rows, f"array<{_ROW_DDL}>")
rejection_message_udf = _udf(rejection_message, "string")
class_catalog_udf = _udf(class_catalog, "array<struct<id:string,name:string,ord:int>>")
page_kind_udf = _struct_udf(page_kind, "kind string, reason string")
case_header_udf = _struct_udf(case_header, ", ".join(f"{f} string" for f in ["number", *schemas.HEADER_FIELDS]))
_PAGER_DDL = "struct<kind:string,baseId:string,pageFieldId:string,eventFieldId:string,pageCount:int>"
all_pagers_udf = _struct_udf(all_pagers, ", ".join(f"{t} {_PAGER_DDL}" for t in TABLES))
search_component_udf = _udf(search_component, "string")
form_fields_udf = lambda form_id: _udf(lambda html: form_fields(html, form_id), "array<struct<name:string,value:string>>")
_LINES_DDL, _LINKS_DDL = "array<struct<line:string,status:string>>", f"array<struct<text:string,download:{schemas.DOWNLOAD_DDL}>>"
_FACTS_DDL = "rows:int,declared:int,firstIndex:int,sliderValue:int,pager:string,pageCount:int"
_movement_lines_udf = _udf(movement_lines, "array<string>")
_document_links_udf = _udf(document_links, _LINKS_DDL)
read_page_udf = _struct_udf(
    read_page, f"kind struct<kind:string,reason:string>, h struct<{','.join(f'{f}:string' for f in ['number', *schemas.HEADER_FIELDS])}>, activeParties {_LINES_DDL}, passiveParties {_LINES_DDL}, "
    f"movements array<string>, documents {_LINKS_DDL}, facts struct<{','.join(f'{t}:struct<{_FACTS_DDL}>' for t in TABLES)}>",
)


def movement_records(lines: Column) -> Column:
    """The dated entries among the lines of the movements table; others are left out."""
    dated = F.filter(F.transform(lines, dated_entry), lambda d: d.isNotNull())
    return F.transform(dated, lambda d: F.struct(d["date"].alias("date"), d["text"].alias("description")))


def document_records(links: Column) -> Column:
    """The downloads of a page; one without a date has an empty one, its kind stands in the last brackets."""
    tail = r"\(([^()]+)\)\s*$"

    def one(link: Column) -> Column:
        dated = dated_entry(link["text"])
        rest = F.coalesce(dated["text"], link["text"])
        return F.struct(
            F.coalesce(dated["date"], F.lit("")).alias("date"), F.trim(F.regexp_replace(rest, tail, "")).alias("name"), F.trim(F.regexp_extract(rest, tail, 1)).alias("kind"),
            link["download"].alias("download"), F.lit(None).cast("string").alias("localPath"),
        )

    return F.transform(links, one)


def party_records(lines: Column) -> Column:
    """The participants among the lines of one side; lines without a name are left out."""
    return F.filter(F.transform(lines, lambda x: party_line(x["line"], x["status"])), lambda p: p.isNotNull())


def movements_udf(html: Column | str) -> Column:
    return movement_records(_movement_lines_udf(html))


def documents_udf(html: Column | str) -> Column:
    return document_records(_document_links_udf(html))


def parties_udf(table: str) -> Callable[[Column | str], Column]:
    lines = _udf(lambda html: party_lines(html, table), _LINES_DDL)
    return lambda html: party_records(lines(html))


def page_facts_udf(table: str) -> Callable[[Column], Column]:
    return _struct_udf(lambda html: page_facts(html, table), "rows int, declared int, firstIndex int, sliderValue int, pager string, pageCount int")


def session_expired(html: Column, view: Column) -> Column:
    """Whether a page shows that its session is gone: a detail page without its heading, another without a view token."""
    return F.when(view == "detail", ~F.coalesce(html.contains(HEADING), F.lit(False))).otherwise(~F.coalesce(html.contains("javax.faces.ViewState"), F.lit(False)))


def search_response(pages: DataFrame, html: str, warning: str, cap: int = schemas.CAP) -> DataFrame:
    """Each captured search page with ``rows``, ``message`` and the cap signal; ``warning`` is the page's wording."""
    rows = pages.withColumn("rows", result_rows_udf(html)).withColumn("message", rejection_message_udf(html))
    warned = F.col(html).contains(warning)
    from sievemill.sources.capped import cap_signal

    return rows.withColumn("cap", cap_signal(F.size("rows"), F.coalesce(warned, F.lit(False)), cap))


def assemble_cases(pages: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captured detail pages to nested cases: (cases, errors).

    ``pages`` has ``ca, table_id, page, html``: page 1 of table_id null is the
    detail page, others are further pages of one table. ``expected`` has
    ``ca, number``. A sealed page gives an empty record with the expected
    number. A page of an unexpected kind, a missing or different number, a
    table of more than ``MAX_PAGES`` pages, a page that repeats the one before
    it, or rows that differ from the declared total make an error row for
    their case and fail nothing else. Pages are put together per case and
    table with their own rows pre-parsed, in page order; further pages of a
    table without a pager don't count.
    """
    # Each page is read once; what it holds is written and joined from there.
    parsed = cut(pages.select("ca", "table_id", "page", read_page_udf("html").alias("p")))
    first = parsed.where("table_id is null").select("ca", "p.kind", "p.h")
    readers = {"activeParties": party_records, "passiveParties": party_records, "movements": movement_records, "documents": document_records}
    cases = first.join(expected.withColumnRenamed("number", "expected"), "ca", "left")
    wrong = F.lit(None).cast("string")
    for table, reader in readers.items():
        own = parsed.where(F.col("table_id").isNull() | (F.col("table_id") == table) & (F.col("page") > 1))
        each = own.select("ca", F.when(F.col("table_id").isNull(), 1).otherwise(F.col("page")).alias("page"), reader(F.col(f"p.{table}")).alias("items"), F.col(f"p.facts.{table}").alias("f"))
        head = each.where("page = 1").select("ca", F.col("f.pager").alias("pager"), F.col("f.rows").alias("size"), F.col("f.declared").alias("declared"), F.col("f.pageCount").alias("links"))
        each = each.join(head, "ca").where("page = 1 or pager is not null")
        each = each.withColumn("advanced", (F.col("page") == 1) | page_advanced(F.col("pager"), F.col("page"), F.col("size"), F.col("f.firstIndex"), F.col("f.sliderValue")))
        whole = each.groupBy("ca").agg(
            F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "items"))), lambda x: x["items"])).alias(table),
            F.sum("f.rows").alias("rows"), F.max("declared").alias("declared"), F.min(F.when(~F.col("advanced"), F.col("page"))).alias("stuck"),
            F.max(F.when(F.col("pager").isNotNull(), page_plan(F.col("declared"), F.nullif(F.col("size"), F.lit(0)), F.col("links")))).alias("plan"),
        )
        fault = (
            F.when(F.col("plan") > schemas.MAX_PAGES, F.concat(F.lit(f"{table}: "), F.col("plan").cast("string"), F.lit(" pages are too many")))
            .when(F.col("stuck").isNotNull(), F.concat(F.lit(f"{table}: page "), F.col("stuck").cast("string"), F.lit(" isn't the one asked for")))
            .when(F.col("declared") != F.col("rows"), F.lit(f"{table}: rows differ from the declared total"))
        )
        cases = cases.join(whole.select("ca", table, fault.alias(f"{table}__fault")), "ca", "left")
        wrong = F.coalesce(wrong, F.col(f"{table}__fault"))
    sealed = F.col("kind.kind") == "sealed"
    reason = (
        F.when(sealed, F.lit(None).cast("string"))
        .when(F.col("kind.kind") == "unexpected", F.col("kind.reason"))
        .when(F.col("h.number").isNull(), F.lit("no case number"))
        .when(F.col("expected").isNotNull() & (F.col("h.number") != F.col("expected")), F.lit("another case number"))
        .otherwise(wrong)
    )
    judged = cases.withColumn("error", reason)
    none = lambda ddl: F.array().cast(f"array<{ddl}>")
    empty = {"activeParties": schemas.PARTY_DDL, "passiveParties": schemas.PARTY_DDL, "movements": schemas.MOVEMENT_DDL, "documents": schemas.DOCUMENT_DDL}
    good = judged.where("error is null").select(
        F.when(sealed, F.col("expected")).otherwise(F.col("h.number")).alias("number"), "ca",
        *(F.when(~sealed, F.col(f"h.{f}")).alias(f) for f in schemas.HEADER_FIELDS),
        *(F.when(sealed, none(d)).otherwise(F.coalesce(F.col(t), none(d))).alias(t) for t, d in empty.items()),
        sealed.alias("sealed"),
    )
    return good, judged.where("error is not null").select("ca", F.col("expected").alias("number"), "error")
