"""All persisted relations of a collection under one folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill import schemas
from sievemill.functions.scalars import window_key
from sievemill.operators import logs


@dataclass
class Store:
    """Append tables in Parquet, one folder per relation and batch.

    A batch written again replaces itself, so a restarted step counts once.
    ``seq`` must rise over batches. Composite writes keep the crash order:
    rows before the event that makes them done, a case before its row leaves
    the queue.
    """

    spark: SparkSession
    path: str

    def append(self, relation: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{relation}/batch={batch}")

    def read(self, relation: str) -> DataFrame:
        """All rows of a relation; a relation never written is empty."""
        schema = schemas.RELATIONS[relation]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{relation}/*")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    def cases(self) -> DataFrame:
        """The latest record of each case."""
        return logs.latest_per_key(self.read("cases"), "number", "seq")

    def has_case(self, numbers: DataFrame) -> DataFrame:
        return numbers.join(self.read("cases").select("number").distinct(), "number", "left_semi")

    def pending(self) -> DataFrame:
        return logs.pending(self.read("search_rows"), self.read("dequeued"), "number", "seq")

    def enqueue(self, batch: int, rows: DataFrame) -> None:
        self.append("search_rows", batch, rows)

    def dequeue(self, batch: int, numbers: DataFrame) -> None:
        self.append("dequeued", batch, numbers)

    def record_final(self, batch: int, events: DataFrame, rows: DataFrame) -> None:
        """Rows are queued before their windows count as done. Events that aren't final are refused."""
        if not events.where(~F.col("type").isin(*schemas.FINAL_EVENTS)).isEmpty():
            raise ValueError("only final events are recorded")
        self.enqueue(batch, rows)
        self.append("sweep_progress", batch, events)

    def complete(self, batch: int, cases: DataFrame) -> None:
        """Cases are stored before their rows leave the queue."""
        self.append("cases", batch, cases)
        self.dequeue(batch, cases.select("number", "seq"))

    def seen(self) -> DataFrame:
        return logs.seen_set(self.read("sweep_progress"), "cnjNumbers", F.col("type").isin(*schemas.FINAL_EVENTS))

    def uncovered(self, windows: DataFrame) -> DataFrame:
        """The windows (a column ``query``) that no final event but an abandoned one has covered."""
        key = lambda: window_key(F.col("query.from"), F.col("query.to"), F.col("query.judicialClassId"), F.col("query.partyName"))
        done = self.read("sweep_progress").where(F.col("type").isin(*schemas.FINAL_EVENTS) & (F.col("type") != "abandoned"))
        return windows.withColumn("__k", key()).join(done.select(key().alias("__k")).distinct(), "__k", "left_anti").drop("__k")

    def retryable(self, relation: str) -> DataFrame:
        """The open failures of a ledger, flattened."""
        open_rows = logs.retryable(self.read(relation), "key", "seq", F.col("type") == "failure", F.col("retryable"))
        return open_rows.select("key", "reason", "httpStatus", "attempt", "detail.*", "recordedAt", "first_seq")
