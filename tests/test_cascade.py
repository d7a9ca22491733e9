import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill.operators import checks, logs
from sievemill.plans import cascade, collection
from sievemill.sources.capped import cap_signal


def _walk(counts, lo, hi, cap, path="", depth=0):
    n = sum(counts.get(d, 0) for d in range(lo, hi + 1))
    kind = "window" if n < cap else "capped" if lo < hi else "saturated"
    out = [(lo, hi, depth, path, n, kind)]
    if kind == "capped":
        mid = lo + (hi - lo) // 2
        out += _walk(counts, mid + 1, hi, cap, path + "0", depth + 1) + _walk(counts, lo, mid, cap, path + "1", depth + 1)
    return out


def test_date_cascade_equals_recursion(spark):
    rnd = random.Random(1)
    day0 = dt.date(2025, 3, 1)
    days = [int(rnd.random() ** 2 * 40) for _ in range(500)]
    counts = {}
    for d in days:
        counts[(day0 - cascade.EPOCH).days + d] = counts.get((day0 - cascade.EPOCH).days + d, 0) + 1
    df = spark.createDataFrame([(day0 + dt.timedelta(days=d),) for d in days], "d date")
    want = _walk(counts, min(counts), max(counts), 30)
    got = cascade.date_cascade(df, F.col("d"), 30).select("depth", "path", "n", "kind")
    assert rows(got) == sorted([(x[2], x[3], x[4], x[5]) for x in want], key=repr)


def test_cascade_of_nothing_and_skips(spark):
    empty = spark.createDataFrame([], "d date")
    assert cascade.date_cascade(empty, F.col("d"), 30).count() == 0
    df = spark.createDataFrame([(dt.date(2025, 3, 11 + k % 2),) for k in range(40)], "d date")
    got = rows(cascade.date_cascade(df, F.col("d"), 30, skip=spark.createDataFrame([("2025-03-12", "2025-03-12")], "from_day string, to_day string")).select("from_day", "to_day", "kind"))
    assert got == [("2025-03-11", "2025-03-11", "window"), ("2025-03-11", "2025-03-12", "capped")]


def test_class_split_keeps_empty_classes(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 11), "a" if k < 20 else "b") for k in range(35)], "d date, c string")
    catalog = spark.createDataFrame([("a", 0), ("b", 1), ("z", 2)], "class_id string, ord int")
    assert rows(cascade.class_split(df, F.col("d"), F.col("c"), catalog, 30).select("class_id", "n", "kind")) == [("a", 20, "window"), ("b", 15, "window"), ("z", 0, "window")]
    with pytest.raises(ValueError):
        cascade.class_split(df, F.col("d"), F.col("c"), catalog.where("false"), 30)


def _cover(spark, rows_, filters, cap, plateau, most=None):
    df = spark.createDataFrame([("l", n, t) for n, t in rows_], "leaf string, num int, txt string")
    events, found = cascade.cover(df, ["leaf"], "num", "txt", filters, cap, plateau, most)
    e = events.first()
    return (e.kind, e.filters_tried, e.union_size), found


def test_plateau(spark):
    # Seed shows 1; the first two filters add one each; three silent ones end the cover before the sixth.
    data = [(1, "s"), (2, "a x"), (3, "b x"), (4, "f x")]
    got, found = _cover(spark, data, ["a x", "b x", "c x", "d x", "e x", "f x"], 1, 3)
    assert got == ("covered", 5, 3)
    assert rows(found.select("number", "ord")) == [(1, 0), (2, 1), (3, 2)]


def test_capped_silence_is_neutral_and_budget_ends(spark):
    data = [(1, "a x"), (2, "a x"), (3, "b y")]
    # 'a x' is capped and silent: no streak; then two silent ones.
    assert _cover(spark, data, ["a x", "q q", "r r"], 1, 2)[0] == ("covered", 3, 1)
    assert _cover(spark, data, ["a x", "b y", "q q"], 1, 2)[0] == ("abandoned", 3, 2)
    with pytest.raises(ValueError):
        _cover(spark, data, ["a x"], 1, 2)


def test_first_listing_and_history(spark):
    df = spark.createDataFrame([(7, "01"), (7, "00"), (8, "1")], "n int, path string")
    seen = spark.createDataFrame([(8,)], "n int")
    assert rows(cascade.first_listing(df, "n", ["path"], seen)) == [(7, "00")]
    years = spark.createDataFrame([(2010,), (2015,)], "y int")
    assert cascade.history_start(years, "y", 2026, 36).first().first_year == 2010
    assert cascade.history_start(years, "y", 2026, 10).first().first_year == 2016
    assert cascade.history_start(years.where("false"), "y", 2026).first().first_year == 2026


def test_logs(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), (None, 4, "n")], "k string, seq int, v string")
    assert rows(logs.latest_per_key(log, "k", "seq").select("k", "v", "first_seq")) == [("a", "z", 1), ("b", "y", 2), (None, "n", 4)]
    assert rows(logs.first_per_key(log, "k", "seq").select("k", "v")) == [("a", "x"), ("b", "y"), (None, "n")]
    done = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(logs.pending(log.where("k is not null"), done, "k", "seq").select("k")) == [("b",)]
    w = spark.createDataFrame([("d", None), ("d", "c")], "day string, cls string")
    p = spark.createDataFrame([("d", None, "window"), ("d", "c", "capped")], "day string, cls string, type string")
    assert rows(logs.uncovered(w, p, ["day", "cls"], F.col("type") == "window")) == [("d", "c")]


def test_budget_runs_and_pages(spark):
    rnd = random.Random(2)
    cost = [rnd.randint(0, 5) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(cost)), "n int, c int")
    want, spent = [], 0
    for n, c in enumerate(cost):
        if spent >= 300:
            break
        want.append((n, spent))
        spent += c
    assert rows(checks.within_budget(df, "n", F.col("c"), 300).select("n", "spent_before")) == sorted(want, key=repr)
    assert checks.within_budget(df.where("false"), "n", F.col("c"), 3).count() == 0
    runs = spark.createDataFrame([("u", k, h) for k, h in enumerate([1, 1, 1, 0, 1, 1, None, 1])], "g string, t int, h int")
    assert rows(checks.longest_runs(runs, "g", ["t"], F.col("h") == 1, 3)) == [("u", 3, 1)]
    pages = spark.createDataFrame([("a", 3, 5), ("a", 2, 5), ("b", 1, 2), ("c", 4, None)], "k string, r int, d int")
    assert rows(checks.reconcile_pages(pages, ["k"], "r", "d").select("k", "matches")) == [("a", True), ("b", False), ("c", True)]
    facts = spark.createDataFrame([("datascroller", 2, 10, None), ("datascroller", 2, 0, None), ("slider", 2, None, 2), ("slider", 2, None, None)], "k string, p int, f int, s int")
    got = [r.ok for r in facts.select(checks.page_advanced(F.col("k"), F.col("p"), F.lit(10), F.col("f"), F.col("s")).alias("ok")).collect()]
    assert got == [True, False, True, True]
    signal = spark.range(1).select(cap_signal(F.lit(30), F.lit(False), 30).alias("s")).first().s
    assert (signal.capped, signal.by_count, signal.disagree) == (True, True, True)


def test_collection(spark):
    rows_ = spark.createDataFrame([("n1", "c1"), ("n2", "c2"), ("n3", "c3")], "number string, ca string")
    done, lost = collection.process_rows(rows_, rows_.where("number = 'n1'"), spark.createDataFrame([("n2", "bad page")], "number string, error string"))
    assert rows(done.select("number")) == [("n1",)]
    assert rows(lost.select("key", "reason")) == [("n2", "bad page"), ("n3", "no response")]
    assert rows(collection.route_pending(rows_, rows_.where("number = 'n1'")).select("number", "step")) == [("n1", "download"), ("n2", "detail"), ("n3", "detail")]
    f = spark.createDataFrame([(1,), (2,)], "a int").select(collection.next_failure(F.col("a")).alias("f")).select("f.*")
    assert rows(f) == [(2, True), (3, False)]
    log = spark.createDataFrame([("s", k, 429 if k < 12 else 200) for k in range(14)], "s string, t int, st int")
    acts = {r.t: r for r in collection.request_log(log, "s", "t", "st").collect()}
    assert acts[4].retry and acts[6].failed and not acts[8].aborted and acts[9].aborted and acts[13].aborted
    work = spark.createDataFrame([(k, 2) for k in range(10)], "n int, c int")
    assert rows(collection.budgeted(work, "n", F.col("c"), 10, 3).select("n")) == [(0,), (1,), (2,)]
