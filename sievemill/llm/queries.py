"""Queries of the operators for training text over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions.text import case_number, instant_micros
from sievemill.llm import encoding, leakage, lookalike, names, packing, survivor
from sievemill.plans.core_sql import instant, number
from sievemill.session import table


def _encoded_values(spark: SparkSession, sf: str) -> DataFrame:
    """All values that may be damaged: tbl, row_id, field, pos, value."""

    def flat(tbl: str, row_id: str, field: str, value: str) -> DataFrame:
        return table(spark, sf, tbl).select(F.lit(tbl).alias("tbl"), F.col(row_id).alias("row_id"), F.lit(field).alias("field"), F.lit(0).alias("pos"), F.col(value).alias("value"))

    cases = table(spark, sf, "cases")
    inner = {"activeparties": "name", "passiveparties": "name", "movements": "description", "documents": "download.nomearqprocdocbin"}

    def entries(field: str, path: str):
        steps = path.split(".")
        return F.transform(
            F.coalesce(F.col(field), F.array().cast(cases.schema[field].dataType)),
            lambda x, i: F.struct(F.lit(field).alias("field"), i.alias("pos"), reduce(lambda c, s: c.getField(s), steps, x).alias("value")),
        )

    one = F.array(F.struct(F.lit("judicialclass").alias("field"), F.lit(0).alias("pos"), F.col("judicialclass").alias("value")))
    every = F.concat(one, *(entries(f, p) for f, p in inner.items()))
    nested = cases.select(F.lit("cases").alias("tbl"), F.col("seq").alias("row_id"), F.explode(every).alias("e")).select("tbl", "row_id", "e.*")
    parts = [nested, flat("search_rows", "seq", "judicialclass", "judicialclass"), flat("party_rows", "party_id", "name", "name")]
    return reduce(DataFrame.unionByName, parts).where(F.col("value").rlike(encoding.SUSPECT))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each value that was decoded with a wrong encoding."""
    found = encoding.find_damaged(_encoded_values(spark, sf), "value", ["tbl", "row_id", "field", "pos"])
    return found.select("tbl", "row_id", "field", "pos")


def p3_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged values with the best text found and how it was reached."""
    found = encoding.find_damaged(_encoded_values(spark, sf), "value", ["tbl", "row_id", "field", "pos"])
    return found.select("tbl", "row_id", "field", "pos", "value", "fixed", "whole", "steps")


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    return names.entities(table(spark, sf, "party_rows"), "party_id", "name", "oab", "doc_value")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each pair of party rows of one person or organisation."""
    return names.same_entity_pairs(_entities(spark, sf)).select(F.col("a").alias("party_id_a"), F.col("b").alias("party_id_b"))


def p5_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The entity of each party row, under its lowest party_id."""
    found = _entities(spark, sf)
    lowest = found.groupBy("entity").agg(F.min("id").alias("entity_id"), F.count(F.lit(1)).alias("n_rows"))
    return found.join(lowest, "entity").select(F.col("id").alias("party_id"), "entity_id", "n_rows")


#: The vocabulary by which texts are measured; its path is a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
HEADER = ["judicialclass", "subject", "filingdate", "jurisdiction", "court", "judgingbody", "address", "referencecase"]


def _survivors(spark: SparkSession, sf: str) -> DataFrame:
    cases = table(spark, sf, "cases")
    return survivor.best_fields(
        cases, case_number(F.col("number")), HEADER, ~F.coalesce("sealed", F.lit(False)), instant_micros(F.col("extractedat")), F.col("seq")
    )


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """The row that supplies each header field of a case listed several times."""
    return _survivors(spark, sf).select(F.col("key").alias("number"), "field", F.col("arrival").alias("seq"))


def p7_records(spark: SparkSession, sf: str) -> DataFrame:
    """One surviving record per case listed several times."""
    best = _survivors(spark, sf)
    return best.groupBy(F.col("key").alias("number")).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in HEADER))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each pair of documents that look the same and aren't the same string."""
    return lookalike.same_look_pairs(table(spark, sf, "documents"), "doc_id", "text")


def p10_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """The documents whose text isn't in its consistent form, with that form."""
    return lookalike.canonical_texts(table(spark, sf, "documents"), "text", ["doc_id"]).where("text <> canonical").select("doc_id", "canonical")


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The container of 2,048 tokens of each text or piece."""
    return packing.pack(table(spark, sf, "documents"), "doc_id", "text", "source", VOCABULARY, 2048)


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The sources of each hundred containers in a row against their part of all tokens."""
    found = packing.mixture(p8_packed(spark, sf))
    return found.select("stretch", "source", F.round("share", 6).alias("share"), F.round("target", 6).alias("target"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each document and held-out item that share 13 consecutive words."""
    found = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"), "doc_id", "item_id", "text", "text", width=13)
    return found.select("doc_id", "item_id")


def p9_near(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and items with windows of 13 words at most two edits apart."""
    found = leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"), "doc_id", "item_id", "text", "text", width=13, max_edits=2)
    return found.select("doc_id", "item_id", "windows", "least_edits")


QUERIES = {
    "p3_found": p3_found,
    "p3_restored": p3_restored,
    "p5_found": p5_found,
    "p5_entities": p5_entities,
    "p7_found": p7_found,
    "p7_records": p7_records,
    "p8_packed": p8_packed,
    "p8_mixture": p8_mixture,
    "p9_found": p9_found,
    "p9_near": p9_near,
    "p10_found": p10_found,
    "p10_canonical": p10_canonical,
}
#: The others have no SQL form; they are tested against brute force.
_NO_VALUE = "('n/i', 'n/d', 'n/a', 'n.i.', 'n.d.', 'n.a.', 'não informado', 'não informada', 'nao informado', 'nao informada', 'sem informação', 'sem informacao', 'não consta', 'nao consta', 'null', 'none')"
_FIELDS = " union all ".join(f"select number, '{f}' as field, {f} as value, pref, instant, seq from k" for f in HEADER)
_BEST = f"""
with k as (
  select {number('number')} as number, coalesce(sealed, false) as pref, {instant('extractedat')} as instant, seq, {', '.join(HEADER)},
         count(*) over (partition by {number('number')}) as n from cases),
f as (select * from ({_FIELDS.replace('from k', 'from k where n > 1')})
      where regexp_matches(value, '[\\p{{L}}\\p{{N}}]') and lower(trim(replace(value, chr(160), ' '))) not in {_NO_VALUE}),
best as (select number, field, value, seq from f qualify row_number() over (partition by number, field order by pref, instant desc, seq) = 1)
"""
ORACLES: dict[str, str] = {
    "p7_found": _BEST + "select number, field, seq from best",
    "p7_records": _BEST + "select number, " + ", ".join(f"max(value) filter (where field = '{f}') as {f}" for f in HEADER) + " from best group by number",
}

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
#: Look-alikes with an accent, as SQL can't take it off: those with a Latin letter of one character.
_ACCENTED = {c: new for c in map(chr, [*range(0x370, 0x590), *range(0x1F00, 0x2000)]) if c not in lookalike.LOOKALIKES and len(new := lookalike.latin(c)) == 1 and new != c}
_FROM, _TO = ("".join(x) for x in zip(*(lookalike.LOOKALIKES | _ACCENTED).items(), strict=True))
_UNSEEN = "[\\p{Cf}\\x{034F}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{3164}\\x{FFA0}\\x{FE00}-\\x{FE0F}]"


def _words(column: str) -> str:
    """The words of a text in SQL, without what makes no difference."""
    plain = f"translate(strip_accents(translate(regexp_replace({column}, '{_UNSEEN}', '', 'g'), '{_WIDE}', '{_NARROW}')), '{_FROM}', '{_TO}')"
    return f"regexp_extract_all(lower(regexp_replace({plain}, '</?[A-Za-z][^<>]*>', ' ', 'g')), '[\\p{{L}}\\p{{N}}]+')"


def _look(column: str) -> str:
    """A text under which texts that look the same are equal, in SQL: every look-alike is folded."""
    blanks = f"regexp_replace(regexp_replace(replace({column}, chr(13) || chr(10), chr(10)), '[\\r\\x{{0085}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), '[\\t\\p{{Zs}}]', ' ', 'g')"
    seen = f"regexp_replace(regexp_replace({blanks}, '{_UNSEEN}', '', 'g'), '[\\x{{00}}-\\x{{09}}\\x{{0B}}-\\x{{1F}}\\x{{7F}}-\\x{{9F}}]', '', 'g')"
    return f"nfc_normalize(translate(translate(nfc_normalize(translate({seen}, '{_WIDE}{lookalike.HYPHENS}', '{_NARROW}{'-' * len(lookalike.HYPHENS)}')), '{_FROM}', '{_TO}'), chr(0), ''))"


def _windows(table: str, ident: str) -> str:
    return f"select distinct {ident}, array_to_string(w[i.i:i.i + 12], ' ') as g from (select {ident}, {_words('text')} as w from {table} where text is not null) t, lateral (select unnest(range(1, len(w) - 11)) as i) i"


ORACLES |= {
    "p9_found": f"with d as ({_windows('documents', 'doc_id')}), e as ({_windows('eval_items', 'item_id')}) select distinct doc_id, item_id from d join e using (g)",
    "p10_found": f"""
with d as (select doc_id, text, {_look('text')} as k from documents where regexp_matches(text, '\\p{{L}}'))
select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from d a join d b on a.k = b.k and a.doc_id < b.doc_id and a.text <> b.text""",
}
