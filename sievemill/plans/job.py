"""A run over captured tables that is recorded in a store and can be taken up again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.plans import collection, sweep
from sievemill.session import cut
from sievemill.sources.store import Store

#: What the captured tables hold, one Parquet folder each.
CAPTURED = {
    "listing": "number string, ca string, day string, class_id string, judicialClass string, subject string, parties string, lastMovement string",
    "classes": "class_id string, class_name string, ord int",
    "details": "number string, requests int, error string, retries int",
    "documents": "number string, doc int, document_id string, requests int, skipped boolean, error string, http_status int, retryable boolean, retries int, path string",
}


@dataclass
class Job:
    """Runs over the tables below ``captured``, recorded in ``store``.

    A captured table that is missing is empty. Each run is one batch of the
    store; a batch run again replaces itself. What is written follows the
    order that survives a crash: rows and their windows, cases, then what
    leaves the queue, then the ledgers.
    """

    spark: SparkSession
    store: Store
    captured: str

    def table(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(CAPTURED[name]).parquet(f"{self.captured}/{name}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], CAPTURED[name])
            raise

    def next_batch(self) -> int:
        """The number after that of the last batch any relation holds."""
        last = [self.store.read(name).agg(F.max("seq").alias("m")).first()["m"] or 0 for name in ("sweep_progress", "cases", "failed_cases", "failed_documents")]
        return (max(last) >> 44) + 1

    def _numbered(self, rows: DataFrame, batch: int) -> DataFrame:
        return rows.withColumn("seq", F.lit(batch) * F.lit(1 << 44) + F.monotonically_increasing_id())

    def run(self, batch: int, start: str, end: str, max_requests: int | None = None, max_cases: int | None = None) -> tuple[DataFrame, dict]:
        """Sweep the days of [start, end], detail what is listed, download its documents: (log, summary)."""
        listing = self.table("listing").where(F.col("day").between(start, end))
        progress = self.store.read("sweep_progress").where(F.col("type").isin(*schemas.FINAL_EVENTS) & (F.col("type") != "abandoned"))
        covered = progress.select(F.col("query.from").alias("from_day"), F.col("query.to").alias("to_day"), F.col("query.judicialClassId").alias("class_id")).distinct()
        classes = self.table("classes")
        events, listed = sweep.sweep(
            listing, F.col("day"), F.col("class_id"), F.col("number"), F.col("parties"), None if classes.isEmpty() else classes, covered=covered, seen=self.store.seen(),
        )
        events = cut(events)
        done = collection.run(events, listed, self.table("details"), self.table("documents"), self.store.pending().select("number"), self.store.read("cases").select("number"), max_requests, max_cases)
        searched = done["log"].where("stage = 0").select("path")
        final = events.where(F.col("type").isin(*schemas.FINAL_EVENTS)).join(searched, "path", "left_semi")
        rows = listed.join(final.select("path"), "path", "left_semi")
        fields = listing.dropDuplicates(["number"]).select("number", "ca", "judicialClass", "subject", "parties", "lastMovement")
        queued = cut(self._numbered(rows.select("number", "path").join(fields, "number"), batch))
        numbers = queued.groupBy("path").agg(F.collect_list("number").alias("cnjNumbers"))
        none = F.lit(None).cast("string")
        query = F.struct(F.col("from_day").alias("from"), F.col("to_day").alias("to"), F.col("class_id").alias("judicialClassId"), none.alias("judicialClassName"), none.alias("partyName"))
        records = final.join(numbers, "path", "left").select(
            "type", query.alias("query"), "depth", F.coalesce("cnjNumbers", F.array().cast("array<string>")).alias("cnjNumbers"), F.col("filters_tried").alias("filtersTried"),
            F.col("union_size").cast("int").alias("unionSize"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("recordedAt"),
        )
        self.store.record_final(batch, self._numbered(records, batch), queued.drop("path"))
        details = done["stored"].join(fields.select("number", "ca", "judicialClass", "subject"), "number", "left")
        empty = self.spark.createDataFrame([], schemas.RELATIONS["cases"])
        self.store.append("cases", batch, empty.unionByName(self._numbered(details, batch), allowMissingColumns=True))
        self.store.dequeue(batch, self._numbered(done["dequeued"], batch).select("number", "seq"))
        self._ledgers(batch, done, fields)
        return done["log"], self._summary(done["summary"])

    def _ledgers(self, batch: int, done: dict[str, DataFrame], fields: DataFrame) -> None:
        none = lambda c: F.lit(None).cast(c)
        cases = done["case_failures"].join(fields.select(F.col("number").alias("key"), "ca"), "key", "left")
        self.store.append("failed_cases", batch, self._numbered(cases.select(
            "type", "key", "reason", none("int").alias("httpStatus"), "attempt", "retryable", F.struct(F.col("key").alias("caseNumber"), "ca").alias("detail"), none("string").alias("recordedAt")), batch))
        facts = self.table("documents").select(
            F.concat("number", F.lit("::"), "document_id").alias("key"), F.col("http_status").alias("httpStatus"), F.coalesce("retryable", F.lit(False)).alias("retryable"),
            F.struct(F.col("number").alias("caseNumber"), F.col("document_id").alias("documentId"), none(schemas.DOWNLOAD_DDL).alias("downloadRef")).alias("detail"),
        ).dropDuplicates(["key"])
        failed = done["document_failures"].join(facts, "key").select("type", "key", "reason", "httpStatus", F.lit(1).alias("attempt"), "retryable", "detail", none("string").alias("recordedAt"))
        fetched = done["document_successes"].select(
            "type", "key", none("string").alias("reason"), none("int").alias("httpStatus"), none("int").alias("attempt"), none("boolean").alias("retryable"), none(facts.schema["detail"].dataType).alias("detail"), none("string").alias("recordedAt")
        )
        self.store.append("failed_documents", batch, self._numbered(failed.unionByName(fetched), batch))

    def _summary(self, one: DataFrame) -> dict:
        out = one.first().asDict()
        out["retryable_cases"], out["retryable_documents"] = (self.store.retryable(name).count() for name in ("failed_cases", "failed_documents"))
        return {k: out.get(k) for k in collection.SUMMARY}

    def retry(self, batch: int) -> dict:
        """A second pass over the open failures of both ledgers; the counts it comes to."""
        details, documents = self.table("details"), self.table("documents")
        cases = self.store.retryable("failed_cases")
        answers = cases.select("key").join(details.select(F.col("number").alias("key"), "error", F.lit(True).alias("here")), "key", "left")
        again = cut(collection.retry(cases, answers.select("key", F.when(F.col("here").isNull(), "no response").otherwise(F.col("error")).alias("error"))).join(cases.select("key", F.struct("caseNumber", "ca").alias("detail")), "key"))
        stored = self.store.read("cases").select("number").distinct()
        open_documents = self.store.retryable("failed_documents")
        known = documents.join(stored, "number", "left_semi").select(F.concat("number", F.lit("::"), "document_id").alias("key"), F.when(~F.coalesce("skipped", F.lit(False)), F.col("error")).alias("error")).dropDuplicates(["key"])
        files = cut(collection.retry(open_documents, known).join(open_documents.select("key", F.struct("caseNumber", "documentId", "downloadRef").alias("detail")), "key"))
        empty = self.spark.createDataFrame([], schemas.RELATIONS["cases"])
        fetched = again.where("type = 'success'").select(F.col("key").alias("number"), F.col("detail.ca").alias("ca"))
        self.store.append("cases", batch, empty.unionByName(self._numbered(fetched, batch), allowMissingColumns=True))
        for name, records in (("failed_cases", again), ("failed_documents", files)):
            whole = self.spark.createDataFrame([], schemas.RELATIONS[name])
            self.store.append(name, batch, whole.unionByName(self._numbered(records, batch), allowMissingColumns=True))
        count = lambda frame, kind: frame.where(F.col("type") == kind).count()
        out = dict.fromkeys(collection.SUMMARY, 0) | {
            "cases_detailed": count(again, "success"), "cases_failed": count(again, "failure"), "documents_downloaded": count(files, "success"), "documents_failed": count(files, "failure"),
            "cases_on_disk": self.store.cases().count(), "pending_rows": self.store.pending().count(), "stopped_by": None,
        }
        out["retryable_cases"], out["retryable_documents"] = (self.store.retryable(name).count() for name in ("failed_cases", "failed_documents"))
        return out

