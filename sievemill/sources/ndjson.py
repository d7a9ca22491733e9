"""NDJSON logs: read, append, repair."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.errors import ParseError
from sievemill.session import cut


def read_log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The lines of a log with ``seq``, their order of appending, from any file system Spark can read.

    A missing log is empty. Blank lines are skipped. Only the last line may be
    unreadable (a write broken off) and is dropped; any other one raises
    ParseError. Lines of :func:`write_log` carry their ``seq``. A single file
    is numbered by place, as its parts are read in order; several files
    without numbers have no order and raise ParseError. The log is parsed once.
    """
    schema = T._parse_datatype_string(ddl) if isinstance(ddl, str) else ddl
    schema = T.StructType([f for f in schema.fields if f.name != "seq"])
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("seq", T.LongType())]))
    lines = lines.select("value", F.monotonically_increasing_id().alias("place"), F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    corrupt = T.StructType([*schema.fields, T.StructField("seq", T.LongType()), T.StructField("__bad", T.StringType())])
    parsed = lines.select("place", "file", F.from_json("value", corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("r"))
    parsed = cut(parsed.withColumn("seq", F.coalesce("r.seq", "place")))
    facts = parsed.agg(
        F.count_if(F.col("r.__bad").isNotNull()).alias("bad"), F.min(F.when(F.col("r.__bad").isNotNull(), F.col("place"))).alias("first"), F.max("place").alias("last"),
        F.count_if(F.col("r.seq").isNull() & F.col("r.__bad").isNull()).alias("bare"), F.min("file").alias("lo"), F.max("file").alias("hi"),
    ).first()
    if facts["bad"] and (facts["bad"] > 1 or facts["first"] != facts["last"]):
        raise ParseError(f"{path}: an unreadable line that isn't the last one")
    if facts["bare"] and facts["lo"] != facts["hi"]:
        raise ParseError(f"{path}: several files whose lines carry no seq have no order")
    return parsed.where("r.__bad is null").select(*(F.col(f"r.{f.name}").alias(f.name) for f in schema.fields), "seq")


def append_line(path: str, record: dict) -> None:
    """Append one record; a line broken off before is cut away first. Null fields are left out."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    repair_tail(path)
    with open(path, "ab") as f:
        f.write((json.dumps({k: v for k, v in record.items() if v is not None}, ensure_ascii=False) + "\n").encode())


def repair_tail(path: str, block: int = 4096) -> bool:
    """Cut a file back to its last line end; True if anything was cut. The file is read from its end."""
    if not os.path.exists(path):
        return False
    with open(path, "rb+") as f:
        size = at = f.seek(0, os.SEEK_END)
        while at:
            start = max(0, at - block)
            f.seek(start)
            cut = f.read(at - start).rfind(b"\n")
            if cut >= 0:
                end = start + cut + 1
                break
            at, block = start, block * 2
        else:
            end = 0
        if end < size:
            f.truncate(end)
        return end < size


def write_log(df: DataFrame, path: str, batch: int) -> None:
    """Append rows as one batch of NDJSON files, null fields left out; Spark's commit makes a batch whole or absent.

    ``seq`` rises with the batch, the row's partition and its place in it
    (up to 2^19 batches of 2^16 partitions of 2^28 rows); a batch written
    again replaces itself.
    """
    numbered = df.drop("seq").withColumn("seq", F.lit(batch) * F.lit(1 << 44) + F.spark_partition_id().cast("bigint") * F.lit(1 << 28) + F.monotonically_increasing_id() % F.lit(1 << 33))
    numbered.write.mode("overwrite").option("ignoreNullFields", "true").json(f"{path}/batch={batch:09d}")
