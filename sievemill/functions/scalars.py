"""The scalar functions of the collector as Column expressions.

Each follows the JVM; where an input has no result the value is null unless
the docstring says otherwise.
"""

from __future__ import annotations

from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as browsers' scripts see it: includes the byte order mark and no-break blanks, excludes U+0085.
SCRIPT_BLANKS = r"[\t\n\x0B\f\r \xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"
CASE_NUMBER = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"


def squash(v: Column) -> Column:
    """Runs of white space become one blank, the ends are trimmed."""
    return F.trim(F.regexp_replace(v, SCRIPT_BLANKS, " "))


def none_if_empty(v: Column) -> Column:
    return F.nullif(v, F.lit(""))


def to_iso_date(v: Column) -> Column:
    """DD/MM/YYYY to YYYY-MM-DD by rearrangement; anything else is returned as it is."""
    return F.regexp_replace(v, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$2-$1")


def to_form_date(v: Column) -> Column:
    """YYYY-MM-DD to DD/MM/YYYY; null if a part is missing."""
    parts = F.split(v, "-")
    return F.when((F.size(parts) == 3) & ~F.exists(parts, lambda p: p == ""), F.concat_ws("/", parts[2], parts[1], parts[0]))


def reference_month(v: Column) -> Column:
    """YYYY-MM-DD to MM/YYYY."""
    parts = F.split(v, "-")
    return F.when(F.size(parts) == 3, F.concat_ws("/", parts[1], parts[0]))


def epoch_day(v: Column) -> Column:
    """An ISO date as days since 1970; null if it is no date."""
    return F.unix_date(v.try_cast("date"))


def from_epoch_day(n: Column) -> Column:
    return F.date_format(F.date_from_unix_date(n.cast("int")), "yyyy-MM-dd")


def midpoint(lo: Column, hi: Column) -> Column:
    """The last day of the earlier half; an odd day goes to the earlier half."""
    return (lo + F.floor((hi - lo) / 2)).cast("int")


def decode_latin1_query(v: Column) -> Column:
    """A query value whose %XX are Latin-1 bytes: plus is a blank, malformed % stay.

    Characters beyond Latin-1 are cut to their low byte.
    """

    def decode(values: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None:
                return None
            raw = bytes(ord(c) & 0xFF for c in x.replace("+", " "))
            return unquote_to_bytes(raw).decode("latin-1")

        return values.map(one)

    return F.pandas_udf(decode, "string")(v)


def query_parameter(url: Column, name: str) -> Column:
    """The first value of a URL's parameter, decoded as UTF-8; null when absent."""
    raw = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(url.rlike(rf"[?&]{name}="), F.try_url_decode(raw))


def sanitise_segment(v: Column) -> Column:
    """One segment of a path: letters, digits, dot, hyphen and underscore only, never hidden, never empty."""
    safe = F.regexp_replace(F.regexp_replace(v, r"[^\p{L}\p{N}._-]+", "_"), "_+", "_")
    safe = F.regexp_replace(safe, "^_+|_+$", "")
    bare = F.regexp_replace(safe, r"^\.+", "")
    return F.when(v.isNull(), None).when(bare == "", "_").otherwise(bare)


def pdf_path(root: Column, case: Column, date: Column, kind: Column, name: Column, document_id: Column) -> Column:
    """<root>/<case>/<date>_<kind>_<id>.pdf; an empty string counts as missing."""
    day = sanitise_segment(F.coalesce(none_if_empty(date), F.lit("undated")))
    what = F.substring(sanitise_segment(F.coalesce(none_if_empty(kind), none_if_empty(name), F.lit("documento"))), 1, 80)
    return F.concat_ws("/", root, sanitise_segment(case), F.concat(F.concat_ws("_", day, what, sanitise_segment(document_id)), F.lit(".pdf")))


def retry_after_ms(header: Column, now_ms: Column) -> Column:
    """A Retry-After header in milliseconds: seconds, or the time to an HTTP date, at least 0."""
    text = F.trim(header)
    date = F.try_to_timestamp(F.regexp_replace(text, r"^\w{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.when(text.rlike(r"^\d+$"), text.try_cast("bigint") * 1000).otherwise(F.greatest(F.lit(0), F.unix_millis(date) - now_ms))


def retry_delay_ms(attempt: Column, retry_after: Column, random: Column, base: int = 1000, most: int = 60_000, jitter: float = 0.3) -> Column:
    """The wait before a retry: what the server asks, else doubled each time with jitter, never beyond ``most``."""
    grown = F.least(F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1)), F.lit(float(most)))
    shaken = F.greatest(F.lit(0.0), F.round(grown + grown * jitter * (random * 2 - 1)))
    return F.when(retry_after.isNotNull(), F.least(retry_after, F.lit(most))).otherwise(shaken.cast("bigint")).cast("bigint")


def throttle_wait_ms(now: Column, previous: Column, delay: int) -> Column:
    """What is left of the pause since the previous request."""
    return F.greatest(F.lit(0), F.lit(delay) - F.coalesce(now - previous, F.lit(delay)))


def window_key(start: Column, end: Column, class_id: Column, party: Column) -> Column:
    """A canonical JSON of a window; an absent part is null, the class name doesn't count."""
    return F.to_json(F.struct(start.alias("from"), end.alias("to"), class_id.alias("judicialClassId"), party.alias("partyName")), {"ignoreNullFields": "false"})


def document_key(case: Column, document: Column) -> Column:
    return F.concat(case, F.lit("::"), document)


def extract_case_number(v: Column) -> Column:
    """The first case number in a text."""
    return none_if_empty(F.regexp_extract(v, f"({CASE_NUMBER})", 1))


def extract_token(v: Column) -> Column:
    """The access token of a result row's link."""
    return none_if_empty(F.regexp_extract(v, r"(?i)listView\.seam\?ca=([0-9a-f]+)", 1))


def subject_after_number(v: Column) -> Column:
    return none_if_empty(F.trim(F.regexp_replace(F.trim(v), r"^-\s*", "")))


def dated_entry(v: Column) -> Column:
    """'DD/MM/YYYY[ time] - text' as struct(date, text); null for anything else."""
    pattern = r"(?s)^(\d{2})/(\d{2})/(\d{4})(?:\s+\d{2}:\d{2}:\d{2})?\s*-\s*(.+)$"
    g = [F.regexp_extract(v, pattern, k) for k in (1, 2, 3, 4)]
    return F.when(v.rlike(pattern), F.struct(F.concat_ws("-", g[2], g[1], g[0]).alias("date"), F.trim(g[3]).alias("text")))


def party_line(v: Column, status: Column) -> Column:
    """A party's line as a struct: name before OAB or tax number, role in the last brackets."""
    text = squash(v)
    role = r"\(([^()]+)\)\s*$"
    body = F.trim(F.regexp_replace(text, role, ""))
    oab, tax = r"OAB\s+([A-Z]{2}\d+[A-Z]?)", r"(CPF|CNPJ):\s*([\d./-]+)"
    name = F.trim(F.regexp_replace(F.regexp_replace(body, rf"(?s)(?:{oab}|{tax}).*$", ""), r"-\s*$", ""))
    document = F.when(body.rlike(tax), F.struct(F.regexp_extract(body, tax, 1).alias("kind"), F.regexp_extract(body, tax, 2).alias("value")))
    party = F.struct(
        name.alias("name"), F.trim(F.regexp_extract(text, role, 1)).alias("role"), document.alias("document"),
        none_if_empty(F.regexp_extract(body, oab, 1)).alias("oab"), none_if_empty(status).alias("status"),
    )
    return F.when(name != "", party)


def joined_lines(v: Column) -> Column:
    """The non-empty lines of a text, squashed and joined by a semicolon."""
    return F.array_join(F.filter(F.transform(F.split(v, "\n"), squash), lambda x: x != ""), "; ")


def range_label(start: Column, end: Column, class_id: Column, party: Column) -> Column:
    """A window for people: the day or range, the class, the filter."""
    days = F.when(start == end, start).otherwise(F.concat_ws("..", start, end))
    return F.concat_ws(" ", days, F.concat(F.lit("class="), class_id), F.concat(F.lit("party="), party))


def decode_bytes(content: Column) -> Column:
    """Bytes as text: UTF-8 if valid, else Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


def response_to_text(headers: Column, body: Column) -> Column:
    """A response as struct(headers, text): header names in lower case, the body decoded."""
    return F.struct(F.transform_keys(headers, lambda k, _: F.lower(k)).alias("headers"), decode_bytes(body).alias("text"))


def matches_filter(name: Column, filter_text: Column) -> Column:
    """Every part of the filter occurs somewhere in the name; fewer than two parts match nothing."""
    parts = F.filter(F.split(filter_text, r"\s+"), lambda p: p != "")
    return (F.size(parts) >= 2) & F.forall(parts, lambda p: F.contains(name, p))


def is_retryable_status(status: Column) -> Column:
    from sievemill.schemas import RETRYABLE_STATUS

    return F.coalesce(status.isin(*RETRYABLE_STATUS), F.lit(False))


def is_transient(code: Column) -> Column:
    from sievemill.schemas import TRANSIENT_CODES

    return F.coalesce(code.isin(*TRANSIENT_CODES), F.lit(False))


def download_url(base: Column, ref: Column) -> Column:
    """The five ids of a download as a query string on the detail view."""
    fields = ["idBin", "numeroDocumento", "nomeArqProcDocBin", "idProcessoDocumento", "actionMethod"]
    pairs = [F.concat(F.lit(f"{f}="), F.url_encode(ref.getField(f))) for f in fields]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def search_fields(start: Column, end: Column, class_id: Column, class_name: Column, party: Column, names: list[str]) -> Column:
    """A window as the ordered fields of a search form: start, end, class id, class name, filter.

    Dates take the form's spelling. Empty fields travel as empty strings. A
    class counts only with both id and name, since the source ignores a half
    one silently.
    """
    both = class_id.isNotNull() & class_name.isNotNull()
    values = [to_form_date(start), to_form_date(end), F.when(both, class_id), F.when(both, class_name), party]
    return F.array(*(F.struct(F.lit(n).alias("name"), F.coalesce(v, F.lit("")).alias("value")) for n, v in zip(names, values, strict=True)))


def listed_numbers(rows: Column) -> Column:
    """What a progress record keeps of an event's rows: their numbers."""
    return F.transform(rows, lambda r: r["number"])
