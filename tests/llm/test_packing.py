import collections
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill.llm import packing as P

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
needs = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files")


def test_fill_keeps_capacity_and_proportions():
    rnd = random.Random(1)
    sources = [rnd.choice("aaabbc") for _ in range(4000)]
    sizes = [rnd.choice([30, 120, 400, 900]) + rnd.randint(0, 60) for _ in sources]
    total = sum(sizes)
    shares = {s: sum(n for n, t in zip(sizes, sources) if t == s) / total for s in "abc"}
    where = P.fill(sizes, sources, 2048, shares, {})
    load, mix = collections.Counter(), collections.defaultdict(collections.Counter)
    for n, s, c in zip(sizes, sources, where):
        load[c] += n
        mix[c // 40][s] += n
    assert max(load.values()) <= 2048 and total / (len(load) * 2048) > 0.98
    for part in list(mix.values())[:-3]:
        for s in "abc":
            assert abs(part[s] / sum(part.values()) - shares[s]) < 0.08
    assert P.fill([], [], 2048, {}, {}) == [] and P.fill([2048, 1], ["a", "a"], 2048, {}, {}) in ([0, 1], [1, 0])


@needs
def test_pack_texts(spark):
    texts = [(k, "palavra " * (k % 90 + 1), "s" + str(k % 3)) for k in range(400)]
    texts += [(1000, None, "s0"), (1001, " \n", "s0"), (1002, "", None), (1003, "long text here " * 3000, None), (1004, "same", "s1"), (1004, "same", "s1"), (1005, "<|endoftext|>", "s1")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, source string").withColumn("part", F.lit("clash")).withColumn("n", F.lit(0))
    out = P.pack(df, "doc_id", "text", "source", VOCABULARY, 512, partition_tokens=4000)
    got = out.toPandas()
    assert set(got.doc_id) == set(range(400)) | {1003, 1004, 1005}
    assert (got[got.doc_id == 1004].shape[0]) == 2
    load = got.groupby("container").n_tokens.sum()
    assert load.max() <= 512 and sorted(load.index) == list(range(len(load)))
    long = got[got.doc_id == 1003].sort_values("piece")
    assert (long.n_tokens[:-1] == 512).all() and (long.first_token == long.piece * 512).all()
    pieces = got.groupby("doc_id").size()
    assert (pieces.drop([1003, 1004]) == 1).all()
    sized = P.count_tokens(df.where("text is not null"), "text", VOCABULARY).toPandas()
    assert sized[sized.doc_id == 1003].n_tokens.iloc[0] == long.n_tokens.sum()


@needs
def test_target_shares_and_empty(spark):
    df = spark.createDataFrame([(k, "palavra " * 20, "ab"[k % 2]) for k in range(300)], "doc_id bigint, text string, source string")
    got = P.pack(df, "doc_id", "text", "source", VOCABULARY, 256, shares={"a": 0.75, "b": 0.25}, partition_tokens=10**6).toPandas()
    early = got[got.container < 10]
    assert abs(early[early.source == "a"].n_tokens.sum() / early.n_tokens.sum() - 0.75) < 0.1
    assert P.pack(df.where("false"), "doc_id", "text", "source", VOCABULARY).count() == 0


@needs
def test_public_vocabularies_agree(spark):
    folder = os.path.dirname(VOCABULARY)
    df = spark.createDataFrame([(1, "Ação cível, 10:00 – fim"), (2, None)], "id int, text string")
    a = rows(P.count_tokens(df, "text", f"{folder}/byte_bpe_50k.json").select("id", "n_tokens"))
    assert a == rows(P.count_tokens(df, "text", VOCABULARY).select("id", "n_tokens"))
    assert P.count_tokens(df, "text", f"{folder}/piece_bpe_32k.model").where("n_tokens > 0").count() == 1


@needs
def test_mixture_over_partitions(spark):
    """Stretches of containers keep the proportions across the bounds of partitions, where deficits are handed on."""
    rnd = random.Random(3)
    texts = [(k, "palavra " * rnd.randint(5, 60), rnd.choice("aaabbc")) for k in range(3000)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, source string")
    out = P.pack(df, "doc_id", "text", "source", VOCABULARY, 256, partition_tokens=12_000)
    mix = P.mixture(out, 20).toPandas()
    assert mix.stretch.nunique() > 10 and abs(mix.share - mix.target).max() < 0.1
    assert abs(mix.groupby("stretch").share.sum() - 1).max() < 1e-9
    load = out.groupBy("container").agg(F.sum("n_tokens").alias("n")).toPandas()
    assert load.n.max() <= 256 and sorted(load.container) == list(range(len(load)))
    assert P.mixture(out.where("false")).count() == 0
