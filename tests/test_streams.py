from conftest import rows

from sievemill.streaming import streams


def test_open_failures(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "failure", 1), ("b", "failure", 1), ("b", "success", 2)], "k string, kind string, at bigint").write.mode("append").json(src)
    df = spark.readStream.schema("k string, kind string, at bigint").json(src)
    out = streams.open_failures(df, "k", "kind", "at", "failure", "success")

    def run():
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("k", "open")) == [("a", True)]
    spark.createDataFrame([("a", "success", 5), ("a", "failure", 3), ("b", "failure", 1)], "k string, kind string, at bigint").write.mode("append").json(src)
    run()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("k", "open", "at")) == [("a", False, 5), ("a", True, 1)]
