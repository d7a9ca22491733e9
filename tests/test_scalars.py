from pyspark.sql import functions as F

from sievemill.functions import scalars as S


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_text(spark):
    assert one(spark, S.squash(F.lit("  a  \n b\uFEFF "))) == "a b"
    assert one(spark, S.joined_lines(F.lit(" a \n\n b c \n"))) == "a; b c"
    assert one(spark, S.decode_latin1_query(F.lit("Inspe%E7%E3o+x%zz%"))) == "Inspeção x%zz%"
    assert one(spark, S.extract_token(F.lit("f('/LISTVIEW.seam?CA=abc123')"))) == "abc123"
    assert one(spark, S.extract_case_number(F.lit("x 0000001-23.2025.4.05.0000 y"))) == "0000001-23.2025.4.05.0000"
    assert one(spark, S.extract_case_number(F.lit("none"))) is None
    assert one(spark, S.subject_after_number(F.lit(" - Tax"))) == "Tax"


def test_dates(spark):
    assert one(spark, S.to_iso_date(F.lit("30/02/2025"))) == "2025-02-30"
    assert one(spark, S.to_iso_date(F.lit("soon"))) == "soon"
    assert one(spark, S.to_form_date(F.lit("2025-03-11"))) == "11/03/2025"
    assert one(spark, S.to_form_date(F.lit("2025-03"))) is None
    assert one(spark, S.reference_month(F.lit("2025-03-11"))) == "03/2025"
    assert one(spark, S.epoch_day(F.lit("1970-01-11"))) == 10 and one(spark, S.epoch_day(F.lit("x"))) is None
    assert one(spark, S.from_epoch_day(F.lit(59))) == "1970-03-01"
    assert one(spark, S.midpoint(F.lit(10), F.lit(12))) == 11
    entry = one(spark, S.dated_entry(F.lit("01/02/2025 10:00:00 - a - b\nc")))
    assert (entry.date, entry.text) == ("2025-02-01", "a - b\nc")
    assert one(spark, S.dated_entry(F.lit("nothing"))) is None


def test_paths(spark):
    for raw, want in [("Acórdão / Decisão", "Acórdão_Decisão"), ("///", "_"), ("..", "_"), (".git", "git"), ("", "_"), ("a__b", "a_b")]:
        assert one(spark, S.sanitise_segment(F.lit(raw))) == want
    path = S.pdf_path(F.lit("pdfs"), F.lit("0000001-23.2025.4.05.0000"), F.lit(""), F.lit(""), F.lit("Nome"), F.lit("7"))
    assert one(spark, path) == "pdfs/0000001-23.2025.4.05.0000/undated_Nome_7.pdf"


def test_waits(spark):
    null = F.lit(None).cast("bigint")
    waits = [one(spark, S.retry_delay_ms(F.lit(n), null, F.lit(0.5))) for n in (0, 1, 2, 7)]
    assert waits == [1000, 1000, 2000, 60000]
    assert one(spark, S.retry_delay_ms(F.lit(1), F.lit(90_000), F.lit(0.5))) == 60000
    assert one(spark, S.retry_after_ms(F.lit(" 3 "), F.lit(0))) == 3000
    assert one(spark, S.retry_after_ms(F.lit("Thu, 01 Jan 1970 00:00:09 GMT"), F.lit(4000))) == 5000
    assert one(spark, S.retry_after_ms(F.lit("soon"), F.lit(0))) in (None, 0)
    assert one(spark, S.throttle_wait_ms(F.lit(1400), F.lit(1000), 1000)) == 600


def test_keys_filters_and_bytes(spark):
    assert one(spark, S.window_key(F.lit("a"), F.lit("b"), F.lit(None).cast("string"), F.lit("p"))) == '{"from":"a","to":"b","judicialClassId":null,"partyName":"p"}'
    assert one(spark, S.document_key(F.lit("c"), F.lit("d"))) == "c::d"
    assert one(spark, S.matches_filter(F.lit("MARIA DAS DORES"), F.lit("DA S"))) is True
    assert one(spark, S.matches_filter(F.lit("MARIA"), F.lit("MA"))) is False
    assert one(spark, S.decode_bytes(F.lit("é".encode()))) == "é" and one(spark, S.decode_bytes(F.lit(b"\xe9"))) == "é"
    assert one(spark, S.query_parameter(F.lit("/x?a=1%20b&a=2&c="), "a")) == "1 b"
    assert one(spark, S.query_parameter(F.lit("/x?a=1"), "b")) is None
    assert one(spark, S.range_label(F.lit("d"), F.lit("d"), F.lit("7"), F.lit(None).cast("string"))) == "d class=7"
    assert one(spark, S.is_retryable_status(F.lit(503))) and not one(spark, S.is_retryable_status(F.lit(None).cast("int")))
    assert one(spark, S.is_transient(F.lit("ETIMEDOUT")))


def test_party_line(spark):
    p = one(spark, S.party_line(F.lit("PERSON ONE - OAB ZZ123A - CPF: 000.000.000-00 (ROLE)"), F.lit("Ativo")))
    assert (p.name, p.role, p.document.kind, p.document.value, p.oab, p.status) == ("PERSON ONE", "ROLE", "CPF", "000.000.000-00", "ZZ123A", "Ativo")
    assert one(spark, S.party_line(F.lit("  "), F.lit(""))) is None


def test_form_fields_and_progress(spark):
    null = F.lit(None).cast("string")
    names = ["de", "ate", "id", "nome", "parte"]
    got = one(spark, S.search_fields(F.lit("2025-03-11"), F.lit("2025-03-12"), F.lit("7"), null, F.lit("DA S"), names))
    assert [(f.name, f.value) for f in got] == [("de", "11/03/2025"), ("ate", "12/03/2025"), ("id", ""), ("nome", ""), ("parte", "DA S")]
    rows = F.array(F.struct(F.lit("n1").alias("number"), F.lit(1).alias("x")))
    assert one(spark, S.listed_numbers(rows)) == ["n1"]


def test_errors():
    from sievemill import errors

    assert errors.RejectedQuery("no").describe() == "RejectedQuery: no" and not errors.RejectedQuery.retryable
    assert errors.RateLimited.retryable and errors.RunAborted("x", {"windows": 1}).summary == {"windows": 1}
    assert issubclass(errors.ParseError, ValueError)
