import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill import cli, schemas
from sievemill.sources import files, ndjson, pages
from sievemill.sources.store import Store

N = "0000001-23.2025.4.05.0000"
RESULT = f"""<table id="f:processosTable"><tbody><tr>
<td><a onclick="openPopUp('x','/listView.seam?ca=abc123')">open</a></td>
<td>CLASS NAME <b>Cls {N} - Subject<br></b> A X B</td><td>Event. (01/02/2025 10:00:00)</td></tr>
<tr><td>no link</td><td><b>{N}</b></td><td></td></tr></tbody></table>"""


def view(label, value):
    return f'<div class="propertyView"><div class="name"><label>{label}</label></div><div class="value">{value}</div></div>'


def party(name, k=0):
    return f'<tr id="x:processoPartesPoloAtivoResumidoList:{k}:y"><td><span><div class="col-sm-12">&#160;<span>{name}</span><ul><li><span>other</span></li></ul></div></span></td><td>Ativo</td></tr>'


def detail(number=N, total=1):
    return (
        "<h1>Dados do Processo</h1>" + view("Número Processo", number) + view("Data da Distribuição", "05/03/2025") + view("Assunto", "One (1\n\n Two") + view("", "Órgão Julgador Colegiado 1ª Turma Endereço Rua A") + view("", "Órgão Julgador 2ª Vara")
        + f'<table id="j:processoPartesPoloAtivoResumidoList"><tbody>{party("PERSON ONE - OAB ZZ123A - CPF: 000.000.000-00 (ROLE)")}</tbody></table>{total} resultados encontrados'
        + '<table id="j:processoPartesPoloPassivoResumidoList"></table>'
        + '<table id="j:processoEvento"><tbody><tr><td>01/02/2025 10:00:00 - text</td></tr><tr><td>no date</td></tr></tbody></table>2 resultados encontrados'
        + '<table id="j:processoDocumentoGridTab"><tbody><tr><td><a href="/x?idBin=1&numeroDocumento=n&nomeArqProcDocBin=Inspe%E7%E3o&idProcessoDocumento=2&actionMethod=m">01/02/2025 10:00:00 - Name (Kind)</a></td></tr><tr><td><a href="/v">Visualizar</a></td></tr></tbody></table>'
    )


def test_result_page():
    assert pages.result_rows(RESULT) == [{"number": N, "ca": "abc123", "judicialClass": "CLASS NAME", "subject": "Subject", "parties": "A X B", "lastMovement": "Event. (01/02/2025 10:00:00)"}]
    assert pages.result_rows(None) == [] and pages.result_rows("<p>") == []
    assert pages.rejection_message('<dl class="rich-messages"><dd> no </dd></dl>') == "no" and pages.rejection_message("") is None
    assert pages.class_catalog("<tr><td></td><td>202</td><td></td><td>CLASS NAME</td></tr><tr><td>202</td><td>AGAIN</td></tr><tr><td>x</td><td>y</td></tr>") == [{"id": "202", "name": "CLASS NAME", "ord": 0}]


def test_detail_page():
    html = detail()
    assert pages.page_kind(html)["kind"] == "detail"
    assert pages.page_kind('<dl class="rich-messages"><dd>Segredo de Justiça</dd></dl>')["kind"] == "sealed"
    assert pages.page_kind("<pre>PSQLException</pre>") == {"kind": "unexpected", "reason": "database error page"}
    assert pages.page_kind(None)["reason"] == "no detail panel"
    h = pages.case_header(html)
    assert (h["number"], h["filingDate"], h["subject"], h["court"], h["address"], h["judgingBody"]) == (N, "2025-03-05", "One (1; Two", "1ª Turma", "Rua A", "2ª Vara")
    assert pages.party_lines(html, "activeParties") == [{"line": "PERSON ONE - OAB ZZ123A - CPF: 000.000.000-00 (ROLE)", "status": "Ativo"}]
    assert pages.party_lines(html, "passiveParties") == [] and pages.movement_lines(html) == ["01/02/2025 10:00:00 - text", "no date"]
    d = pages.document_links(html)
    assert len(d) == 1 and d[0]["download"]["nomeArqProcDocBin"] == "Inspeção"
    assert pages.page_facts(html, "documents")["rows"] == 2 and pages.page_facts(html, "movements")["declared"] == 2
    assert pages.page_facts(html, "passiveParties")["declared"] is None and pages.page_facts(html, "activeParties")["firstIndex"] == 0


def test_detail_columns(spark):
    df = spark.createDataFrame([(detail(),), (None,)], "html string")
    got = df.select(pages.parties_udf("activeParties")("html").alias("p"), pages.movements_udf("html").alias("m"), pages.documents_udf("html").alias("d"), pages.session_expired(F.col("html"), F.lit("detail")).alias("x")).collect()
    assert [p.asDict(True) for p in got[0].p] == [{"name": "PERSON ONE", "role": "ROLE", "document": {"kind": "CPF", "value": "000.000.000-00"}, "oab": "ZZ123A", "status": "Ativo"}]
    assert [tuple(m) for m in got[0].m] == [("2025-02-01", "text")]
    assert (got[0].d[0].date, got[0].d[0].name, got[0].d[0].kind) == ("2025-02-01", "Name", "Kind")
    assert got[1].p == [] and got[1].m == [] and got[1].d == [] and [r.x for r in got] == [False, True]


def test_scripts():
    from sievemill.sources import scripts

    call = next(scripts.calls("""a=1; f({'k' : 'it\\'s', n: [1, ")"], m: g("x")}); f()""", "f"))
    assert scripts.texts(call) == ["k", "it's", ")", "x"] and scripts.text_after(call, "n") == ")" and scripts.text_after(call, "none") is None
    assert list(scripts.calls("f('open", "f")) == [[scripts.Token("text", "open")]]
    page = """<script>executarPesquisa=function(){A4J.AJAX.Submit('fPP',null,{'similarityGroupingId':'z','parameters':{'fPP:j_id244':'fPP:j_id244'} })}</script>"""
    assert pages.search_component(page) == "fPP:j_id244" and pages.search_component(None) is None


def test_pagers_and_forms():
    slider = """<table id="j:processoEvento"></table><script>new Richfaces.Slider("j:s",{'minValue':'1','maxValue':'5',x:'A4J.AJAX.Submit(\\'j:form\\',{\\'parameters\\':{\\'j:ev\\':1}})'})</script>"""
    assert pages.pager(slider, "movements") == {"kind": "slider", "baseId": "j:form", "pageFieldId": "j:s", "eventFieldId": "j:ev", "pageCount": 5}
    scroll = """<table class="rich-dtascroller-table"><td class=" rich-datascr-act ">1</td><td class=" rich-datascr-inact ">2</td></table>
    new Richfaces.Datascroller('j:processoDocumentoGridTab:sc', function(event){A4J.AJAX.Submit('j:base',event)})"""
    got = pages.pager(scroll, "documents")
    assert got["kind"] == "datascroller" and got["pageCount"] == 2 and got["baseId"] == "j:base"
    assert pages.pager("", "documents") is None
    # Without a scroller table before it there are no links to read, whatever other scrollers the page has after or before.
    bare = """<td class="rich-datascr-inact">7</td><script>new Richfaces.Datascroller('j:processoDocumentoGridTab:sc', function(event){A4J.AJAX.Submit('j:base',event)})</script>
    <table class="rich-dtascroller-table"><td class="rich-datascr-inact">9</td></table>"""
    assert pages.pager(bare, "documents")["pageCount"] == 1
    every = pages.all_pagers(scroll + slider)
    assert every["documents"]["pageCount"] == 2 and every["movements"]["kind"] == "slider" and every["activeParties"] is None
    form = '<form id="j"><input name="a" value="1"><input name="b" type="submit"><input name="javax.faces.ViewState" value="v"><input name="javax.faces.ViewState" value="w">'
    fields = pages.form_fields(form, "j")
    assert fields == [{"name": "a", "value": "1"}, {"name": "javax.faces.ViewState", "value": "v"}]
    body = pages.paging_body(got, 2, fields)
    assert body[0]["value"] == "_viewRoot" and {"name": got["pageFieldId"], "value": "2"} in body and {"name": "ajaxSingle", "value": got["pageFieldId"]} in body


SCROLL = """<script>new Richfaces.Datascroller('x:processoPartesPoloAtivoResumidoList:sc', function(event){A4J.AJAX.Submit('j',event)})</script>"""


def test_assembly(spark):
    pg = [("c1", None, 1, detail()), ("c2", None, 1, detail(total=9)), ("c3", None, 1, detail("9999999-99.2025.4.05.0000")), ("c4", None, 1, '<dl class="rich-messages"><dd>autos sigilosos segredo de justica</dd></dl>'), ("c5", None, 1, None), ("c6", None, 1, SCROLL + detail(total=2)), ("c6", "activeParties", 2, f'<table id="x:processoPartesPoloAtivoResumidoList"><tbody>{party("PERSON TWO (ROLE)", 1)}</tbody></table>')]
    df = spark.createDataFrame(pg, "ca string, table_id string, page int, html string")
    expected = spark.createDataFrame([(f"c{k}", N) for k in range(1, 7)], "ca string, number string")
    cases, errors = pages.assemble_cases(df, expected)
    got = {r.ca: r for r in cases.collect()}
    assert set(got) == {"c1", "c4", "c6"}
    assert got["c4"].sealed and got["c4"].number == N and got["c4"].documents == []
    assert [p.name for p in got["c6"].activeParties] == ["PERSON ONE", "PERSON TWO"]
    assert {r.ca for r in errors.collect()} == {"c2", "c3", "c5"}
    s = pages.search_response(spark.createDataFrame([(RESULT + "muitos processos",)], "html string"), "html", "muitos processos").first()
    assert len(s.rows) == 1 and s.cap.by_text and s.cap.disagree


def test_page_advance_and_ceiling(spark):
    scroller = """<table class="rich-dtascroller-table"><td class="rich-datascr-act">1</td><td class="rich-datascr-inact">2</td></table>
    <script>new Richfaces.Datascroller('x:processoPartesPoloAtivoResumidoList:sc', function(event){A4J.AJAX.Submit('j',event)})</script>"""
    more = lambda k: f'<table id="x:processoPartesPoloAtivoResumidoList"><tbody>{party("PERSON TWO (ROLE)", k)}</tbody></table>'
    pg = []
    for ca, total, page2 in (("ok", 2, more(1)), ("stuck", 2, more(0)), ("many", 501, more(1))):
        pg += [(ca, None, 1, detail(total=total).replace("resultados", scroller + f"{total} resultados", 1)), (ca, "activeParties", 2, page2)]
    cases, errors = pages.assemble_cases(spark.createDataFrame(pg, "ca string, table_id string, page int, html string"), spark.createDataFrame([(c, N) for c in ("ok", "stuck", "many")], "ca string, number string"))
    assert [(r.ca, len(r.activeParties)) for r in cases.collect()] == [("ok", 2)]
    got = {r.ca: r.error for r in errors.collect()}
    assert "page 2 isn't" in got["stuck"] and "501 pages" in got["many"]


def test_ndjson(spark, tmp_path):
    path = str(tmp_path / "d" / "x.ndjson")
    assert ndjson.read_log(spark, path, "number string, seq bigint").count() == 0
    ndjson.append_line(path, {"number": "1", "x": None})
    with open(path, "a") as f:
        f.write('{"number": "2"')
    assert rows(ndjson.read_log(spark, path, "number string").select("number")) == [("1",)]
    ndjson.append_line(path, {"number": "3"})
    assert open(path).read().splitlines() == ['{"number": "1"}', '{"number": "3"}']
    with open(path, "w") as f:
        f.write('{"number": "1"}\n\nbroken\n{"number": "2"}\n')
    with pytest.raises(ndjson.ParseError):
        ndjson.read_log(spark, path, "number string")
    with open(path, "w") as f:
        f.write("x" * 10_000)
    assert ndjson.repair_tail(path) and open(path).read() == ""


def test_log_of_batches(spark, tmp_path):
    """The later batch wins whatever order its files are read in, also through a URI; a batch written again counts once."""
    path = f"file://{tmp_path}/log"
    assert ndjson.read_log(spark, path, "k string, v int").count() == 0
    big = spark.range(2000).select(F.concat(F.lit("k"), F.col("id") % 10).alias("k"), F.col("id").cast("int").alias("v")).repartition(3)
    ndjson.write_log(big, path, 1)
    small = spark.createDataFrame([(f"k{i}", -i) for i in range(10)], "k string, v int").coalesce(1)
    for _ in range(2):
        ndjson.write_log(small, path, 2)
    log = ndjson.read_log(spark, path, "k string, v int")
    assert log.count() == 2010 == log.select("seq").distinct().count()
    assert rows(log.groupBy("k").agg(F.max_by("v", "seq").alias("v"))) == sorted([(f"k{i}", -i) for i in range(10)], key=repr)
    for n in range(2):
        (tmp_path / "bare").mkdir(exist_ok=True)
        (tmp_path / "bare" / f"{n}.json").write_text('{"k": "a"}\n')
    with pytest.raises(ndjson.ParseError):
        ndjson.read_log(spark, str(tmp_path / "bare"), "k string")


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.pending().count() == 0
    sr = spark.createDataFrame([("n1", "c", None, None, None, None, 1), ("n2", "c", None, None, None, None, 2)], schemas.RELATIONS["search_rows"])
    ev = spark.createDataFrame([("window", ("a", "b", None, None, None), 0, ["n1", "n2"], None, None, "t", 1), ("abandoned", ("a", "c", None, None, None), 0, ["n3"], None, None, "t", 2)], schemas.RELATIONS["sweep_progress"])
    store.record_final(1, ev, sr)
    with pytest.raises(ValueError):
        store.record_final(2, ev.withColumn("type", F.lit("capped")), sr)
    assert rows(store.seen()) == [("n1",), ("n2",), ("n3",)]
    assert rows(store.uncovered(ev.select("query")).select("query.to")) == [("c",)]
    case = spark.createDataFrame([("n1", "c", *[None] * 8, [], [], [], [], False, "t", 3)], schemas.RELATIONS["cases"])
    store.complete(1, case)
    assert rows(store.pending().select("number")) == [("n2",)] and store.cases().count() == 1
    fail = spark.createDataFrame([("failure", "k", "r", 500, 1, True, ("n1", "c"), "t", 1), ("failure", "j", "r", 500, 1, True, ("n2", "c"), "t", 2), ("success", "k", None, None, None, None, None, "t", 3)], schemas.RELATIONS["failed_cases"])
    store.append("failed_cases", 1, fail)
    assert rows(store.retryable("failed_cases").select("key", "caseNumber")) == [("j", "n2")]


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "a" / "y.pdf").write_bytes(b"<html>")
    got = rows(files.valid_files(spark, str(tmp_path)))
    assert len(got) == 1 and got[0][0].endswith("/a/x.pdf")
    got = spark.createDataFrame([("d/n.pdf", b"%PDF-x"), ("a/x.pdf", b"%PDF-y"), ("a/y.pdf", b"%PDF-z"), ("z.pdf", b"no")], "path string, content binary")
    assert rows(files.store_files(got, str(tmp_path))) == [("a/x.pdf", False), ("a/y.pdf", True), ("d/n.pdf", True)]
    assert (tmp_path / "a" / "x.pdf").read_bytes() == b"%PDF-1.4" and files.valid_files(spark, str(tmp_path)).count() == 3
    df = spark.createDataFrame([(200, "application/pdf", b"%PDF"), (200, "text/html", b"%PDF"), (429, None, None), (200, "Application/PDF;x", b"no")], "s int, t string, c binary")
    out = [r.o for r in df.select(files.outcome(F.col("s"), F.col("t"), F.col("c")).alias("o")).collect()]
    assert [(o.ok, o.reason, o.retryable) for o in out] == [(True, None, False), (False, "not a PDF", False), (False, "HTTP 429", True), (False, "no PDF content", False)]
    docs = spark.createDataFrame([("./p/a.pdf",), ("p/b.pdf",)], "f string")
    assert rows(files.to_download(docs, F.col("f"), spark.createDataFrame([("p/a.pdf",)], "path string")).select("path")) == [("p/b.pdf",)]


def test_cli():
    a = cli.parse_args(["--from=2025-03-05", "--max-cases", "1"])
    assert (a.start, a.end, a.max_cases, a.max_requests) == ("2025-03-05", "2025-03-05", 1, 40)
    assert cli.parse_args(["--unbounded"]).max_cases is None
    for bad in (["--from=2025-13-45"], ["--max-cases=0"], ["--delay-ms=10"], ["--from=2025-03-06", "--to=2025-03-05"], ["--what"]):
        with pytest.raises(SystemExit) as e:
            cli.parse_args(bad)
        assert e.value.code == 2
    assert cli.summary_lines({"windows": 3})[1] == "windows: 3" and cli.summary_lines({"retries": 1})[1:] == ["429 retries: 1", "stopped by: (ran to completion)"]
    assert cli.hint({"windows": 1, "cases_listed": 0}) and not cli.hint({"windows": 2, "cases_listed": 0})
    assert json.dumps(schemas.FILTERS) and len(schemas.FILTERS) == 15
