import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill import cli
from sievemill.plans import job as J
from sievemill.plans import sweep
from sievemill.sources.store import Store


@pytest.fixture()
def job(spark, tmp_path):
    listing = [(f"n{k:02d}", f"c{k}", f"2025-03-{10 + k % 3}", "a" if k % 2 else "b", None, None, f"DA SILVA {k}", None) for k in range(12)]
    spark.createDataFrame(listing, J.CAPTURED["listing"]).write.parquet(f"{tmp_path}/captured/listing")
    details = [(f"n{k:02d}", 1, "bad page" if k == 4 else None, 0) for k in range(11)]
    spark.createDataFrame(details, J.CAPTURED["details"]).write.parquet(f"{tmp_path}/captured/details")
    documents = [(f"n{k:02d}", d, f"d{k}x{d}", 1, False, "HTTP 503" if (k, d) == (1, 1) else None, 503 if (k, d) == (1, 1) else 200, True, 0, None) for k in range(11) for d in range(2)]
    spark.createDataFrame(documents, J.CAPTURED["documents"]).write.parquet(f"{tmp_path}/captured/documents")
    return J.Job(spark, Store(spark, f"{tmp_path}/store"), f"{tmp_path}/captured")


def test_run_is_taken_up_again(job):
    _, first = job.run(1, "2025-03-01", "2025-03-31", max_requests=10)
    assert first["stopped_by"] == "maxRequests" and first["windows"] == 1 and first["cases_listed"] == 12 and first["requests"] == 10
    assert first["pending_rows"] == 9 and first["cases_on_disk"] == 3
    _, second = job.run(2, "2025-03-01", "2025-03-31")
    assert second["windows"] == 0 and second["windows_skipped"] == 1 and second["stopped_by"] is None
    assert second["pending_rows"] == 0 and second["cases_on_disk"] == 10 and second["cases_failed"] == 2
    assert second["retryable_cases"] == 2 and second["retryable_documents"] == 1
    _, third = job.run(3, "2025-03-01", "2025-03-31")
    assert third["requests"] == 0 and third["cases_on_disk"] == 10


def test_failures_are_tried_again_up_to_three_times(job):
    job.run(1, "2025-03-01", "2025-03-31")
    two = job.retry(2)
    assert (two["cases_failed"], two["documents_failed"], two["retryable_cases"], two["retryable_documents"]) == (2, 1, 2, 1)
    three = job.retry(3)
    assert three["cases_failed"] == 2 and three["retryable_cases"] == 0 and three["retryable_documents"] == 0
    assert job.retry(4)["cases_failed"] == 0


def test_cases_before_the_limit(job):
    _, s = job.run(1, "2025-03-01", "2025-03-31", max_cases=2)
    assert s["cases_detailed"] == 2 and s["documents_downloaded"] + s["documents_failed"] == 4 and s["stopped_by"] == "maxCases"


def test_command_line(job, tmp_path, capsys):
    assert cli.main(["--from=2025-03-10", "--to=2025-03-12", "--unbounded", f"--data-dir={tmp_path}"]) == 0
    said = capsys.readouterr().out.splitlines()
    assert "range: 2025-03-10..2025-03-12" in said and "search 2025-03-10..2025-03-12 -> 12 rows" in said and "detail n04 failed: bad page" in said
    assert "cases detailed: 10" in said and "stopped by: (ran to completion)" in said
    assert cli.main(["--retry-failed", f"--data-dir={tmp_path}"]) == 0
    assert "retryable cases: 2" in capsys.readouterr().out


def test_sweep_of_scripted_windows(spark):
    """A refused leaf and a skipped one leave their siblings; rows of capped windows are listed by their children only."""
    data = [(f"2025-03-1{1 + k % 2}", "x" if k < 4 else "y", k, "n") for k in range(8)]
    df = spark.createDataFrame(data, "d string, c string, n int, name string")
    catalog = spark.createDataFrame([("x", 0), ("y", 1), ("x", 2)], "class_id string, ord int")
    covered = spark.createDataFrame([("2025-03-12", "2025-03-12", "x")], "from_day string, to_day string, class_id string")
    rejected = spark.createDataFrame([("2025-03-11", "2025-03-11", None, "refused")], "from_day string, to_day string, class_id string, message string")
    events, listed = sweep.sweep(df, F.col("d"), F.col("c"), F.col("n"), F.col("name"), catalog, cap=4, covered=covered, rejected=rejected)
    assert rows(events.select("type", "path", "n", "rows", "split_by")) == sorted([("capped", "", 8, None, "date"), ("capped", "0", 4, None, "class"), ("rejected", "1", None, None, None), ("skipped", "0/000000", None, None, None), ("window", "0/000001", 2, 2, None)], key=repr)
    assert rows(listed) == [(5, "0/000001", 0), (7, "0/000001", 0)]
    assert rows(sweep.class_check(events, 4).select("children_rows", "ok")) == [(2, None)]
    plain, found = sweep.sweep(df, F.col("d"), F.col("c"), F.col("n"), F.col("name"), None, cap=4, with_cover=False)
    assert rows(plain.select("type", "path", "rows")) == sorted([("capped", "", None), ("unsplittable", "0", 4), ("unsplittable", "1", 4)], key=repr) and found.count() == 8
    none, nothing = sweep.sweep(df.where("false"), F.col("d"), F.col("c"), F.col("n"), F.col("name"), catalog)
    assert none.count() == 0 and nothing.count() == 0
