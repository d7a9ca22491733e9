import random

from conftest import rows
from pyspark.sql import functions as F

from sievemill.operators import changes

SCHEMA = "k string, kind string, at bigint, attempt int, seq bigint"


def _brute(feed):
    by = {}
    for k, kind, at, attempt, seq in feed:
        by.setdefault(k, []).append(((at is not None, at or 0, attempt is not None, attempt or 0), kind, seq))
    out = []
    for k, v in by.items():
        ups, dels = [x for x in v if x[1] != "success"], [x for x in v if x[1] == "success"]
        if ups:
            top = max(x[0] for x in ups)
            if not any(d[0] > top for d in dels):
                out.append((k, min(x[2] for x in ups if x[0] == top)))
    return sorted(out, key=repr)


def test_state_equals_brute_force_in_any_order(spark):
    rnd = random.Random(3)
    feed = [(rnd.choice("abcdefgh"), rnd.choice(["failure", "failure", "success"]), rnd.randint(1, 9), rnd.choice([None, 1, 2, 3]), n) for n in range(300)]
    feed += [(None, "failure", 1, 1, 900), ("z", "failure", None, None, 901), ("hot", "failure", 5, 1, 902)] + [("hot", "failure", 5, 1, 903 + n) for n in range(50)]
    want = _brute(feed)
    for seed in (1, 2):
        random.Random(seed).shuffle(feed)
        df = spark.createDataFrame(feed, SCHEMA).repartition(3).withColumn("o0", F.lit("clash"))
        got = rows(changes.current_state(df, ["k"], F.col("kind") == "success", [F.col("at"), F.col("attempt")], "seq"))
        assert got == want


def test_empty_feed(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert changes.current_state(df, ["k"], F.col("kind") == "success", [F.col("at")], "seq").count() == 0


def test_equality_delete_table(spark, tmp_path):
    t = changes.EqualityDeleteTable(spark, str(tmp_path / "t"), ["k"], ["at"], "seq")
    one = [("a", "failure", 1, 1, 1), ("b", "failure", 2, 1, 2)]
    two = [("a", "success", 3, None, 3), ("b", "success", 1, None, 4), ("c", "failure", 5, 1, 5)]
    t.append(2, spark.createDataFrame(two, SCHEMA), F.col("kind") == "success")
    t.append(1, spark.createDataFrame(one, SCHEMA), F.col("kind") == "success")
    t.append(1, spark.createDataFrame(one, SCHEMA), F.col("kind") == "success")  # written again: counted once
    assert rows(t.read().select("k", "seq")) == [("b", 2), ("c", 5)]
    assert rows(t.compact(0, str(tmp_path / "u")).read().select("k")) == [("b",), ("c",)]


def test_compacted_deletes_hold_against_late_changes(spark, tmp_path):
    t = changes.EqualityDeleteTable(spark, str(tmp_path / "t"), ["k"], ["at"], "seq")
    first = [("a", "failure", 1, 1, 1), ("a", "success", 5, None, 2), ("a", "success", 3, None, 3), ("b", "failure", 2, 1, 4), (None, "success", 5, None, 5)]
    t.append(1, spark.createDataFrame(first, SCHEMA), F.col("kind") == "success")
    u = t.compact(1, str(tmp_path / "u"))
    late = [("a", "failure", 4, 1, 6), (None, "failure", 4, 1, 7), ("c", "failure", 1, 1, 8)]
    u.append(2, spark.createDataFrame(late, SCHEMA), F.col("kind") == "success")
    assert rows(u.read().select("k")) == [("b",), ("c",)]
    u.append(3, spark.createDataFrame([("a", "failure", 6, 1, 9)], SCHEMA), F.col("kind") == "success")
    assert rows(u.read().select("k")) == [("a",), ("b",), ("c",)]
