"""Captured PDF files: validity, the skip rule and the outcome of a download."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions.text import file_path


def is_pdf(content: Column) -> Column:
    """True if the content begins as a PDF does."""
    return F.coalesce(F.substring(content, 1, 4) == F.lit(b"%PDF"), F.lit(False))


def valid_files(spark: SparkSession, folder: str) -> DataFrame:
    """The valid PDF files below a folder: ``path, bytes``. Four bytes of each file are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(folder).select("path", "length")

    @F.pandas_udf("binary")
    def head(paths: pd.Series) -> pd.Series:
        return paths.map(_head)

    return files.where(is_pdf(head("path"))).select(file_path(F.col("path")).alias("path"), F.col("length").alias("bytes"))


def _head(path: str) -> bytes | None:
    from pyarrow import fs
    from urllib.parse import unquote

    try:
        system, inner = fs.FileSystem.from_uri("file://" + path.removeprefix("file:").replace("///", "/") if path.startswith("file:") else path)
        with system.open_input_stream(unquote(inner)) as f:
            return f.read(4)
    except (OSError, ValueError):
        return None


def store_files(responses: DataFrame, root: str) -> DataFrame:
    """Write downloaded files: ``path, written`` (false where a valid file was there already).

    ``responses`` has ``path`` (below ``root``, a folder all executors share)
    and ``content``; rows whose content is no PDF aren't written. A file
    appears whole or not at all: it is written beside its place and renamed.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        for batch in batches:
            written = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                target = os.path.join(root, path)
                there = False
                if os.path.exists(target):
                    with open(target, "rb") as f:
                        there = f.read(4) == b"%PDF"
                if not there:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    beside = f"{target}.{uuid.uuid4().hex}.part"
                    with open(beside, "wb") as f:
                        f.write(content)
                    os.replace(beside, target)
                written.append(not there)
            yield pd.DataFrame({"path": batch["path"], "written": pd.Series(written, dtype="bool")})

    good = responses.where(is_pdf(F.col("content")) & F.col("path").isNotNull()).select("path", "content")
    return good.mapInPandas(write, "path string, written boolean")


def to_download(documents: DataFrame, path: Column, existing: DataFrame) -> DataFrame:
    """The documents whose file doesn't exist yet."""
    return documents.withColumn("path", file_path(path)).join(existing.select("path").distinct(), "path", "left_anti")


def outcome(status: Column, content_type: Column, content: Column) -> Column:
    """What a response to a download is: struct(ok, reason, retryable)."""
    said = F.coalesce(F.lower(content_type).contains("application/pdf"), F.lit(False))
    from sievemill.functions.scalars import is_retryable_status

    reason = (
        F.when(status != 200, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(~said, F.lit("not a PDF"))
        .when(~is_pdf(content), F.lit("no PDF content"))
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"), is_retryable_status(status).alias("retryable"))


def thrown_outcome(kind: Column, message: Column) -> Column:
    """What an error thrown by a download is: struct(ok, reason, retryable). Only a rate limit and an open breaker pass."""
    reason = F.concat(kind, F.lit(": "), F.coalesce(message, F.lit("")))
    return F.struct(F.lit(False).alias("ok"), reason.alias("reason"), kind.isin("RateLimited", "BreakerOpen").alias("retryable"))
