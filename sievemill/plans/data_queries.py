"""Queries of the general data-processing operators over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions.text import case_number, file_path, instant_micros
from sievemill.operators import changes, nested, packed, references
from sievemill.session import scratch, table

#: The levels of a record that p6_found reports, and the names it reports them by.
LEVELS = {"activeParties": "activeparties", "passiveParties": "passiveparties", "movements": "movements", "documents": "documents", "documents.download": "downloads"}


def _origin() -> Column:
    """The source of a listing: the office of origin, the last part of its number."""
    return F.coalesce(F.right(case_number(F.col("number")), F.lit(4)), F.lit(""))


#: Offices with few listings lean on all others with this weight in rows.
PRIOR_ROWS = 500


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each single name of the packed field ``parties`` with its place; delimiters are inferred per office of origin."""
    rows = packed.explode_packed(table(spark, sf, "search_rows"), "parties", ["seq"], source=_origin(), group="number", out="party", prior_rows=PRIOR_ROWS)
    return rows.select("seq", "pos", "party")


def p1_delimiters(spark: SparkSession, sf: str) -> DataFrame:
    """The delimiter candidates of each office of origin with their scores."""
    found = packed.infer_delimiters(table(spark, sf, "search_rows"), "parties", source=_origin(), group="number", prior_rows=PRIOR_ROWS)
    rounded = [F.round(c, 6).alias(c) for c in ("regularity", "whole_rows", "agree_with", "agree_without")]
    return found.select("source_key", "candidate", "n_rows", *rounded, "accepted")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of both ledgers that are open after all changes."""

    def feed(name: str) -> DataFrame:
        return table(spark, sf, name).select(
            F.lit(name).alias("ledger"), "ledger_key", "record_type", instant_micros(F.col("recordedat")).alias("at"), "attempt", "seq"
        )

    both = feed("failed_documents").unionByName(feed("failed_cases"))
    order = [F.col("at"), F.col("attempt")]
    return changes.current_state(both, ["ledger", "ledger_key"], F.col("record_type") == "success", order, "seq")


def _document_key(number: Column, document: Column) -> Column:
    return F.when(document.isNotNull() & number.isNotNull(), F.concat_ws("\t", number, document))


def _reference_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Failures, cases, the documents of cases, and files, with canonical keys and instants."""
    cases = table(spark, sf, "cases").select(case_number(F.col("number")).alias("number"), instant_micros(F.col("extractedat")).alias("at"), "documents", "seq")
    failures = table(spark, sf, "failed_documents").where("record_type = 'failure'").select(
        "seq", case_number(F.col("detail.casenumber")).alias("number"), F.col("detail.documentid").alias("document_id"), instant_micros(F.col("recordedat")).alias("ref_at")
    )
    return {
        "cases": cases.select("seq", "number", "at"), "failures": failures.withColumn("document_key", _document_key(F.col("number"), F.col("document_id"))),
        "documents": cases.select("seq", "number", "at", F.posexplode("documents").alias("pos", "d")).select(
            "seq", "at", "pos", _document_key(F.col("number"), F.col("d.download.idprocessodocumento")).alias("document_key"), file_path(F.col("d.localpath")).alias("path")
        ),
        "files": table(spark, sf, "pdf_files").select("file_id", file_path(F.col("path")).alias("path"), F.unix_micros(F.col("storedat").cast("timestamp")).alias("at"), F.col("removedat").isNotNull().alias("removed")),
    }


def _deltas(t: dict[str, DataFrame]) -> list[DataFrame]:
    """The signed counts that the rows of the four tables stand for."""
    return [
        references.reference_deltas("casenumber", t["failures"], F.col("number"), F.col("ref_at")),
        references.existence_deltas("casenumber", t["cases"], F.col("number"), F.col("at")),
        references.reference_deltas("documentid", t["failures"], F.col("document_key"), F.col("ref_at")),
        references.existence_deltas("documentid", t["documents"], F.col("document_key"), F.col("at")),
        references.reference_deltas("localpath", t["documents"], F.col("path"), F.col("at")),
        references.existence_deltas("localpath", t["files"], F.col("path"), F.col("at"), F.col("removed")),
    ]


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each reference without a valid target."""
    t = _reference_tables(spark, sf)

    def refs(tbl: str, field: str, frame: DataFrame, key: str, at: str, pos: Column) -> DataFrame:
        return frame.select(
            F.lit(tbl).alias("tbl"), F.lit(field).alias("field"), "seq", pos.alias("pos"), F.col(at).alias("ref_at"), F.lit(field).alias("domain"), F.col(key).alias("ref_key")
        ).where("ref_key is not null")

    every = reduce(DataFrame.unionByName, [
        refs("failed_documents", "casenumber", t["failures"], "number", "ref_at", F.lit(0)),
        refs("failed_documents", "documentid", t["failures"], "document_key", "ref_at", F.lit(0)),
        refs("cases", "localpath", t["documents"], "path", "at", F.col("pos")),
    ])
    found = references.orphan_rows(every, references.key_states(_deltas(t)))
    # A failure whose case is an orphan is reported once, for its case.
    reported = found.where("field = 'casenumber'").select("seq", F.lit("documentid").alias("field")).distinct()
    found = found.join(reported, ["seq", "field"], "left_anti")
    return found.select("tbl", "field", "seq", "pos", "state", references.month_utc(F.col("ref_at")).alias("month_utc"))


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    """Orphan references counted per table, field, state and month, from counts kept between batches.

    The rows arrive in three batches, the latest first; files are stored in
    one batch and removed in another. The report reads the kept counts only.
    """
    t = _reference_tables(spark, sf)
    counts = references.ReferenceCounts(spark, scratch(spark))
    of_batch = lambda name, part: t[name].where(F.pmod(F.col("file_id" if name == "files" else "seq"), F.lit(2)) == part)
    for batch in (1, 0):
        part = {name: of_batch(name, batch) for name in t}
        stored = part | {"files": part["files"].withColumn("removed", F.lit(False))}
        counts.add(batch, _deltas(stored))
    counts.add(2, [references.removal_deltas("localpath", t["files"].where("removed"), F.col("path"), F.col("at"))])
    found = counts.orphans()
    # A failure whose case is an orphan is reported once, for its case; both references are of one instant.
    number = F.when(F.col("domain") == "documentid", F.substring_index("ref_key", "\t", 1))
    reported = found.where("domain = 'casenumber'").select(F.col("ref_key").alias("number"), "ref_at").distinct()
    kept = found.withColumn("number", number)
    same = kept["number"].eqNullSafe(reported["number"]) & kept["ref_at"].eqNullSafe(reported["ref_at"])
    kept = kept.join(reported, same, "left_anti")
    tbl = F.when(F.col("domain") == "localpath", "cases").otherwise("failed_documents").alias("tbl")
    return kept.groupBy(tbl, F.col("domain").alias("field"), "state", references.month_utc(F.col("ref_at")).alias("month_utc")).agg(F.sum("n").alias("n"))


def _children(spark: SparkSession, sf: str, only: list[str] | None = None) -> DataFrame:
    lines = table(spark, sf, "case_lines").select("line_id", nested.parse_record(F.col("line")).alias("record"))
    return nested.child_rows(lines, "line_id", "record", only)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each object of the lists of a readable line, and each download."""
    rows = _children(spark, sf, list(LEVELS))
    names = F.create_map(*(F.lit(x) for kv in LEVELS.items() for x in kv))
    download = F.col("path") == "documents.download"
    # A download isn't a list: it stands at its document's place and counts if any of its fields has a value.
    kept = rows.where(~download | (F.col("shape") == "object") & nested.has_values(F.col("element")))
    return kept.select("line_id", names[F.col("path")].alias("child"), F.when(download, F.col("parent_ordinal")).otherwise(F.col("ordinal")).alias("pos"))


def p6_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Every level that occurs in the lines, with the merged schema of its rows."""
    return nested.merged_schema(_children(spark, sf)).withColumnRenamed("path", "child")


QUERIES = {
    "p1_found": p1_found,
    "p1_delimiters": p1_delimiters,
    "p2_found": p2_found,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p6_found": p6_found,
    "p6_schema": p6_schema,
}
