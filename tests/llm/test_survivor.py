import random

from conftest import rows
from pyspark.sql import functions as F

from sievemill.llm import survivor as S

SCHEMA = "number string, a string, b string, sealed boolean, at bigint, seq bigint"


def _best(spark, data):
    df = spark.createDataFrame(data, SCHEMA).withColumn("field", F.lit("clash")).withColumn("value", F.lit(1))
    out = S.best_fields(df, F.col("number"), ["a", "b"], ~F.coalesce("sealed", F.lit(False)), F.col("at"), F.col("seq"))
    return rows(out.select("key", "field", "arrival"))


def test_dated_groups_equal_brute_force(spark):
    rnd = random.Random(4)
    vals = [None, "", " ", "-", "N/I", "Não informado", "x", "y", "z", "w"]
    data = [(f"n{rnd.randint(0, 40)}", rnd.choice(vals), rnd.choice(vals), rnd.choice([True, False, None]), rnd.randint(0, 5), k) for k in range(300)]
    want = []
    for n in {r[0] for r in data}:
        g = [r for r in data if r[0] == n]
        for f, i in (("a", 1), ("b", 2)):
            ok = [r for r in g if r[i] in ("x", "y", "z", "w")]
            if len(g) > 1 and ok:
                want.append((n, f, min(ok, key=lambda r: (bool(r[3]), -r[4], r[5]))[5]))
    assert _best(spark, data) == sorted(want, key=repr)


def test_missing_timestamps_follow_learnt_currency(spark):
    learn = [(f"g{k}", v, None, False, 10 + t, 100 * k + t) for k in range(5) for t, v in enumerate(["old", "mid", "new"])]
    data = learn + [
        ("u1", "old", None, False, 50, 1001), ("u1", "new", None, False, None, 1002),  # learnt to be newer than the dated one
        ("u2", "new", None, False, 50, 1003), ("u2", "old", None, False, None, 1004),  # learnt to be older
        ("u3", "mid", None, False, None, 1005), ("u3", "new", None, False, None, 1006), ("u3", "old", None, False, None, 1007),
        ("u4", "p", None, False, None, 1009), ("u4", "q", None, False, None, 1008),  # nothing learnt: the lowest arrival
        ("u5", "old", None, False, None, 1010), ("u5", "new", None, True, None, 1011),  # the better class comes first
    ]
    got = {r[0]: r[2] for r in _best(spark, data) if r[0].startswith("u")}
    assert got == {"u1": 1002, "u2": 1003, "u3": 1006, "u4": 1008, "u5": 1010}


def test_edges(spark):
    assert _best(spark, []) == []
    assert _best(spark, [("n", "x", None, False, 1, 1)]) == []
    assert _best(spark, [("n", "x", None, False, 1, 1), ("n", "x", None, False, 1, 1)]) == [("n", "a", 1)]
    assert _best(spark, [(None, "x", None, False, 1, 1), (None, "x", None, False, 1, 2)]) == []
    assert _best(spark, [("n", "v" * 200_000, None, False, 1, 1), ("n", None, None, None, None, 2)]) == [("n", "a", 1)]


def _strongest(dated):
    """Strength of the strongest chain between any two values, by brute force over all chains."""
    steps = {}
    for group in dated.values():
        values = [v for _, v in sorted(group)]
        for a, b in zip(values, values[1:]):
            if a != b:
                steps[a, b] = steps.get((a, b), 0) + 1
    s = {(a, b): n - steps.get((b, a), 0) for (a, b), n in steps.items() if n > steps.get((b, a), 0)}
    nodes = {x for p in steps for x in p}
    for k in nodes:
        for a in nodes:
            for b in nodes:
                if a != b and (w := min(s.get((a, k), 0), s.get((k, b), 0))) > s.get((a, b), 0):
                    s[a, b] = w
    return s


def test_undated_chains_equal_brute_force(spark):
    """Groups with undated rows, long chains and cycles; without the learnt order the lowest arrival would win."""
    rnd = random.Random(5)
    names = "abcdefgh"
    data, dated, seq = [], {}, 0
    for g in range(60):
        walk = sorted(rnd.sample(names, rnd.randint(2, 3)))
        if g % 6 == 0:
            walk.reverse()
        for t, v in enumerate(walk):
            seq += 1
            data.append((f"g{g}", v, None, False, 10 + t, seq))
            dated.setdefault(f"g{g}", []).append((10 + t, v))
    want = {}
    groups = {}
    for g in range(80):
        for v in rnd.sample(names, rnd.randint(2, 4)):
            seq += 1
            with_time = rnd.random() < 0.2 and not any(t is not None for _, t, _ in groups.get(f"u{g}", []))
            groups.setdefault(f"u{g}", []).append((v, 50 if with_time else None, seq))
            data.append((f"u{g}", v, None, False, 50 if with_time else None, seq))
    s = _strongest(dated)
    newer = lambda a, b: s.get((a, b), 0) > s.get((b, a), 0)
    for g, members in groups.items():
        d = next((m for m in members if m[1] is not None), None)
        rivals = [m for m in members if m[1] is None and (d is None or newer(d[0], m[0]))]
        top = [m for m in rivals if not any(newer(m[0], o[0]) for o in rivals)]
        want[g] = min((m[2] for m in top), default=d and d[2])
    got = {r[0]: r[2] for r in _best(spark, data) if r[0].startswith("u")}
    assert got == want
    assert any(want[g] != min(m[2] for m in ms) for g, ms in groups.items())


def test_a_chain_of_four_values(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d")]
    data = [(f"{x}{y}{k}", v, None, False, t, 10 * i + t) for i, (x, y) in enumerate(pairs) for k in range(2) for t, v in enumerate((x, y))]
    data += [("u", "a", None, False, 9, 100), ("u", "d", None, False, None, 101), ("v", "a", None, False, None, 102), ("v", "c", None, False, None, 103), ("b-and-c", "b", None, False, 1, 104), ("b-and-c", "c", None, False, None, 105)]
    got = {r[0]: r[2] for r in _best(spark, data)}
    assert got["u"] == 101 and got["v"] == 103
