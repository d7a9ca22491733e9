import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill.llm import leakage as L


def _brute(docs, items, width=13):
    index = {}
    for i, t in items:
        w = L.words_of(t)
        for k in range(len(w) - width + 1):
            index.setdefault(tuple(w[k : k + width]), set()).add(i)
    out = set()
    for d, t in docs:
        w = L.words_of(t)
        for k in range(len(w) - width + 1):
            out |= {(d, i) for i in index.get(tuple(w[k : k + width]), ())}
    return sorted(out, key=repr)


def _corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéãõ") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(40))) for k in range(12)]
    docs = []
    for k in range(60):
        text = [word() for _ in range(rnd.randint(1, 60))]
        if k % 3 == 0:
            w = items[k % 12][1].split()
            n = rnd.randint(8, 20)
            at = rnd.randint(0, 20)
            text[5:5] = w[at : at + n]
        docs.append((k, " ".join(text)))
    return docs, items


def test_words():
    assert L.words_of("Ａção, cível:\n> <b>CO\u200BNTRA</b> pаrte") == ["acao", "civel", "contra", "parte"]
    assert L.words_of(None) == [] and L.words_of("a < b") == ["a", "b"]


def test_exact_leaks_equal_brute_force(spark):
    docs, items = _corpus(1)
    docs += [(100, None), (101, ""), (102, "x " * 5), (103, items[0][1].upper().replace(" ", "  \n> ")), (103, items[0][1]), (104, items[3][1] * 300)]
    items += [(50, None), (51, "short one"), (0, items[0][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("bucket", F.lit("clash")).withColumn("item", F.lit(1))
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = rows(L.leaks(d, i, "doc_id", "item_id", "text", "text").select("doc_id", "item_id"))
    assert got == _brute(docs, items)
    in_blocks = rows(L.leaks(d, i, "doc_id", "item_id", "text", "text", block_words=100).select("doc_id", "item_id"))
    assert in_blocks == got
    assert L.leaks(d.where("false"), i, "doc_id", "item_id", "text", "text").count() == 0
    assert L.leaks(d, i.where("false"), "doc_id", "item_id", "text", "text").count() == 0


def _edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def _near_brute(docs, items, limit, width=13):
    windows = lambda t: {tuple(w[k : k + width]) for w in [L.words_of(t)] for k in range(len(w) - width + 1)}
    held = [(i, w) for i, t in items for w in windows(t)]
    out = {}
    for d, t in docs:
        for a in windows(t):
            for i, b in held:
                if len(set(a) & set(b)) >= width - 2 * limit and (e := _edit_distance(a, b)) <= limit:
                    out.setdefault((d, i), {}).setdefault(a, []).append(e)
    return {k: (len(v), min(min(x) for x in v.values())) for k, v in out.items()}


@pytest.mark.parametrize("max_edits", [1, 2])
def test_recall_of_edited_windows(spark, max_edits):
    """Substituted, inserted and left out words anywhere, against brute force."""
    rnd = random.Random(7 + max_edits)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rnd.choice(words) for _ in range(13 + k % 3))) for k in range(240)]
    docs = []
    for k, t in items:
        w = t.split()
        for _ in range(max_edits if k % 3 == 0 else 1):
            at = rnd.randint(0, len(w) - 1)
            w[at : at + (k % 3 != 1)] = [] if k % 3 == 2 else [f"new{rnd.randrange(10**9)}"]
        docs.append((k, " ".join([f"p{rnd.randrange(10**9)}" for _ in range(5)] + w + [f"p{rnd.randrange(10**9)}" for _ in range(5)])))
    docs.append((1000, docs[0][1] + " " + docs[3][1]))
    want = _near_brute(docs, items, max_edits)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.windows, r.least_edits) for r in L.leaks(d, i, "doc_id", "item_id", "text", "text", max_edits=max_edits).collect()}
    assert got.keys() <= want.keys() and all(got[k][0] <= want[k][0] and got[k][1] >= want[k][1] for k in got)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(v[0] for v in want.values())
    kinds = [{k for k in want if k[0] % 3 == kind and k[0] < 1000} for kind in range(3)]
    assert all(len(k & got.keys()) >= 0.9 * len(k) for k in kinds) and min(map(len, kinds)) > (0 if max_edits == 1 else 60)


@pytest.mark.parametrize("max_edits", [0, 1])
def test_batches_without_a_hit(spark, max_edits):
    docs = [(f"d{k}", None if k % 7 == 0 else " ".join(f"x{k}y{n}" for n in range(30))) for k in range(40)]
    items = [(f"i{k}", " ".join(f"q{k}r{n}" for n in range(20))) for k in range(3)]
    docs.append(("hit", items[1][1]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        d, i = spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")
        assert rows(L.leaks(d, i, "doc_id", "item_id", "text", "text", max_edits=max_edits)) == [("hit", "i1", 8, 0)]
        assert L.leaks(d.where("doc_id <> 'hit'"), i, "doc_id", "item_id", "text", "text", max_edits=max_edits).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_items_are_laid_out_in_stretches(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(900))
    d = spark.createDataFrame([(1, text), (2, " ".join(text.split()[490:520]))], "doc_id bigint, text string")
    i = spark.createDataFrame([(5, text)], "item_id bigint, text string")
    monkeypatch.setattr(L, "STRETCH", 100)
    assert rows(L.leaks(d, i, "doc_id", "item_id", "text", "text", block_words=200).select("doc_id", "item_id")) == [(1, 5), (2, 5)]


def test_edit_distances():
    rnd = random.Random(3)
    for limit in range(4):
        a, b = (np.array([[rnd.randint(1, 3) for _ in range(6)] for _ in range(500)], dtype=np.uint64) for _ in range(2))
        want = [min(limit + 1, _edit_distance(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        assert L.edit_distances(a, b, limit).tolist() == want


def test_walks():
    codes = np.arange(1, 30, dtype=np.uint64)
    a, b = L.cgk_buckets(codes, 13, 0, 16), L.cgk_buckets(codes, 13, 0, 16)
    assert len(a) == 17 and (a == b).all()
    again = np.concatenate([codes[:13], codes[20:25], codes[:13]])
    c = L.cgk_buckets(again, 13, 0, 16)
    assert c[0] == c[-1] == a[0]  # equal windows have equal walks wherever they stand
    assert (L.cgk_buckets(codes, 13, 1, 16) != a).all()
    assert len(L.cgk_buckets(codes[:5], 13, 0, 16)) == 0
    assert L.repetitions_for(0, 0.95, 13, 16) == 1 and L.repetitions_for(1, 0.95, 13, 10) > 1
