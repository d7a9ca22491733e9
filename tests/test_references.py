from conftest import rows
from pyspark.sql import functions as F

from sievemill.functions.text import case_number, file_path, instant, instant_micros
from sievemill.operators import references as R


def test_states(spark):
    refs = spark.createDataFrame([("d", "k1", 10, 1), ("d", "k2", 10, 2), ("d", "k3", 10, 3), ("d", "k4", 10, 4), ("d", "k1", 10, 5), ("d", None, 10, 6), ("d", "k5", None, 7)], "domain string, ref_key string, ref_at bigint, id int")
    made = spark.createDataFrame([("k2", 5, False), ("k3", 20, False), ("k4", 5, True), ("k5", 50, False), (None, 1, False)], "k string, at bigint, gone boolean")
    states = R.key_states([R.reference_deltas("d", refs, F.col("ref_key"), F.col("ref_at")), R.existence_deltas("d", made, F.col("k"), F.col("at"), F.col("gone"))])
    got = rows(R.orphan_rows(refs, states).select("id", "state"))
    assert got == [(1, "missing"), (3, "late"), (4, "deleted"), (5, "missing")]
    assert {r.ref_key: (r.refs, r.alive) for r in states.collect()}["k1"] == (2, 0)


def test_maintained_counts_in_any_order(spark, tmp_path):
    """Batches of references, records and removals in every order give the same report."""
    import itertools

    frame = lambda data: spark.createDataFrame(data, "k string, at bigint").withColumn("domain", F.lit("clash")).withColumn("refs", F.lit(9))
    k, at = F.col("k"), F.col("at")
    batches = [
        [R.reference_deltas("d", frame([("a", 10), ("a", 10), ("b", 10), ("c", 10), ("e", 10), (None, 1)]), k, at)],
        [R.existence_deltas("d", frame([("b", 5), ("b", 30), ("c", 30), ("e", 1)]), k, at)],
        [R.removal_deltas("d", frame([("b", 5), ("e", 1)]), k, at), R.reference_deltas("d", frame([("f", 7)]), k, at)],
        [R.reference_deltas("d", frame([("f", 7)]), k, at, sign=-1)],
    ]
    want = [("d", "a", 10, "missing", 2), ("d", "b", 10, "late", 1), ("d", "c", 10, "late", 1), ("d", "e", 10, "deleted", 1)]
    for n, order in enumerate(itertools.islice(itertools.permutations(range(4)), 0, 24, 7)):
        counts = R.ReferenceCounts(spark, f"{tmp_path}/{n}")
        for i in order:
            counts.add(i, batches[i])
        counts.add(order[0], batches[order[0]])  # again, as after a restart
        assert rows(counts.orphans()) == want
        compacted = counts.compact(f"{tmp_path}/{n}c")
        assert rows(compacted.orphans()) == want and compacted.read().where("ref_key = 'f'").isEmpty()


def test_empty(spark):
    refs = spark.createDataFrame([], "domain string, ref_key string, ref_at bigint")
    states = R.key_states([R.reference_deltas("d", refs, F.col("ref_key"), F.col("ref_at"))])
    assert R.orphan_rows(refs, states).count() == 0


def test_spellings(spark):
    df = spark.createDataFrame(
        [("0001234-55.2020.4.05.8100", "0001234-55.2020.4.05.8100"), ("Processo nº 00012345520204058100", "0001234-55.2020.4.05.8100"), ("  x1 ", "x1"), (None, None)],
        "a string, want string",
    )
    assert all(r.got == r.want for r in df.select("want", case_number(F.col("a")).alias("got")).collect())
    paths = [("./pdfs//a/./b.pdf", "pdfs/a/b.pdf"), ("pdfs\\a\\b.pdf", "pdfs/a/b.pdf"), ("pdfs/Intimac\u0327a\u0303o.pdf", "pdfs/Intimação.pdf"), (None, None), ("pdfs/./././b.pdf", "pdfs/b.pdf")]
    df = spark.createDataFrame(paths, "a string, want string")
    assert all(r.got == r.want for r in df.select("want", file_path(F.col("a")).alias("got")).collect())
    times = ["2025-01-03T15:46:10.443Z", "2025-01-03 15:46:10.443Z", "2025-01-03T12:46:10.443-03:00", "2025-01-03T15:46:10.443000Z", "2025-01-03T17:46:10.443+0200", "2025-01-03T15:46:10.443"]
    got = {r.v for r in spark.createDataFrame([(t,) for t in times], "a string").select(instant_micros(F.col("a")).alias("v")).collect()}
    assert got == {1735919170443000}
    assert spark.createDataFrame([("never",), (None,)], "a string").where(instant(F.col("a")).isNull()).count() == 2
    assert spark.range(1).select(R.month_utc(F.lit(1735919170443000)).alias("m")).first().m == "2025-01"
