import collections
import itertools

from conftest import rows
from pyspark.sql import functions as F

from sievemill.llm import lookalike as K

BASE = "A parte requereu a anexação, art. 5º do código - fim"
SAME = [BASE, BASE.replace("parte", "pаrte"), BASE.replace("requereu", "ｒｅｑｕｅｒｅｕ"), BASE.replace("çã", "çã"), BASE.replace(" ", " "), BASE.replace("-", "‑"), BASE.replace("fim", "f\u200Bim"), BASE.replace(" a ", " а ")]
OTHER = [BASE.replace("º", "o"), BASE.replace("ã", "a"), BASE.lower(), BASE.replace("5", "6"), "Иван в Мурме", "λέξη δίκη", "裁判所 通知", "", "-", " ", "m² de", "m2 de", None]


def test_pairs_equal_brute_force(spark):
    docs = list(enumerate(SAME + OTHER + [BASE] * 5 + ["-", "‑", "x" * 100_000, "x" * 99_999 + "х"]))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("k", F.lit("clash")).withColumn("folded", F.lit(1))
    groups = collections.defaultdict(list)
    for k, t in docs:
        if t in SAME:
            groups["same"].append((k, t))
        elif t and t.startswith("xxx"):
            groups["x"].append((k, t))
    want = sorted(((a[0], b[0]) for g in groups.values() for a, b in itertools.combinations(g, 2) if a[1] != b[1]), key=repr)
    assert rows(K.same_look_pairs(df, "doc_id", "text")) == want


def test_canonical_form(spark):
    df = spark.createDataFrame(list(enumerate(SAME + ["Иван в Мурме", "раѕѕаdо zzunknоwn", None, ""])), "doc_id bigint, text string")
    got = {r.doc_id: r.canonical for r in K.canonical_texts(df, "text", ["doc_id"]).collect()}
    assert {got[k] for k in range(len(SAME))} == {BASE}
    assert got[len(SAME)] == "Иван в Мурме"
    assert got[len(SAME) + 1] == "раѕѕаdо zzunknоwn"  # not in the vocabulary: left alone
    assert len(SAME) + 2 not in got and got[len(SAME) + 3] == ""


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert K.same_look_pairs(df, "doc_id", "text").count() == 0 and K.canonical_texts(df, "text", ["doc_id"]).count() == 0


def test_tokens():
    assert K.repaired("pаrte") == "parte" and K.repaired("ОАВ") == "OAB" and K.repaired("Иван") is None and K.repaired("parte") is None
    assert K.repaired("Mир") == "Мир"  # Cyrillic dominates: the Latin letter is the stranger
    assert K.repaired("Mирλ") is None  # letters of two scripts that nothing else can show
    assert K.repaired("nоº") == "noº"
    assert K.latin("сáѕа") == "cása"


def test_vocabulary_decides_what_looks_the_same(spark):
    """Each class below exists only by the repair of its tokens."""
    docs = [
        (1, "o tribunal"), (2, "o tribunаl"),  # Latin, repaired to a word of the corpus
        (3, "в Мире живем"), (4, "в Mире живем"),  # repaired to the Cyrillic word
        (5, "vеstigio"), (6, "vestigiо"), (7, "vеstigiо"),  # no Latin spelling, but several that lead to one
        (8, "ϲάτη"), (9, "cάτη"),
        (10, "só uma grаfia"),  # one spelling only: stays as it is
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(K.same_look_pairs(df, "doc_id", "text")) == sorted([(1, 2), (3, 4), (5, 6), (5, 7), (6, 7), (8, 9)], key=repr)
    got = {r.doc_id: r.canonical for r in K.canonical_texts(df, "text", ["doc_id"]).collect()}
    assert got[2] == "o tribunal" and got[4] == docs[2][1] and got[5] == got[6] == got[7] == "vestigio" and got[10] == docs[-1][1]


def test_hot_copies_and_many_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = [(k, "a mesma pаrte") for k in range(60)] + [(100 + k, f"texto {k} da parte") for k in range(40)] + [(200, "a mesma parte")]
        df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("doc", F.lit("clash")).withColumn("t", F.lit(1))
        assert rows(K.same_look_pairs(df, "doc_id", "text")) == sorted([(k, 200) for k in range(60)], key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
