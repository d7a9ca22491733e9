from conftest import rows
from pyspark.sql import functions as F

from sievemill.operators import packed

CELLS = [
    (1, "k1", "ANA MARIA SILVA; JOSE DE SOUZA X BANCO DO SUL S/A"),
    (2, "k1", '"ANA MARIA SILVA"|JOSE DE SOUZA VS BANCO DO SUL S/A,'),
    (3, "k1", "ANA MARIA SILVA / JOSE DE SOUZA\tX\u00A0BANCO DO SUL S/A"),
    (4, "k2", "LIMA E CIA X. TRANSPORTES S/A x 'SILVA; PRADO ADVOGADOS'"),
    (5, "k2", '"LIMA E CIA X. TRANSPORTES S/A" VS "SILVA; PRADO ADVOGADOS"'),
    (6, "k3", '"CASA ""BOA VISTA"" LTDA, FILIAL"\nRUI D\'AVILA X PEDRO LIMA'),
    (7, "k4", None), (8, "k4", ""), (9, "k4", " \u00A0\t"), (10, "k5", "SO UM NOME"), (10, "k5", "SO UM NOME"),
    (11, "k6", ";; ,| MARIA LIMA ; ,"),
]
WANT = {
    1: ["ANA MARIA SILVA", "JOSE DE SOUZA", "BANCO DO SUL S/A"], 2: ["ANA MARIA SILVA", "JOSE DE SOUZA", "BANCO DO SUL S/A"],
    3: ["ANA MARIA SILVA", "JOSE DE SOUZA", "BANCO DO SUL S/A"], 4: ["LIMA E CIA X. TRANSPORTES S/A", "SILVA; PRADO ADVOGADOS"],
    5: ["LIMA E CIA X. TRANSPORTES S/A", "SILVA; PRADO ADVOGADOS"], 6: ['CASA "BOA VISTA" LTDA, FILIAL', "RUI D'AVILA", "PEDRO LIMA"], 11: ["MARIA LIMA"],
}
NAMES = ["semicolon", "bar", "newline", "tab", "comma", "spaced_solidus", "side_vs", "side_x"]


def test_split_with_known_delimiters(spark):
    df = spark.createDataFrame(CELLS, "seq int, number string, parties string")
    got = {r.seq: r.v for r in df.where("seq not in (7, 8, 9, 10)").select("seq", packed.split_packed(F.col("parties"), NAMES).alias("v")).collect()}
    assert got == WANT


def test_inference_and_explode_on_the_table(spark, data):
    d = spark.read.parquet(f"{data}/search_rows.parquet")
    scores = {r.candidate: r.accepted for r in packed.infer_delimiters(d, "parties", group="number").collect()}
    assert scores["semicolon"] and scores["side_x"] and scores["comma"]
    assert not scores.get("bare_solidus", False) and not scores.get("word_e", False) and not scores.get("side_x_dot", False)


def test_sources_have_their_own_delimiters(spark):
    a = [(k, "a", f"g{k % 7}", f"NOME {k} UM; NOME {k} DOIS") for k in range(60)]
    b = [(100 + k, "b", f"h{k % 7}", f"NOME {k} UM| NOME {k} DOIS, LTDA") for k in range(60)]
    df = spark.createDataFrame(a + b, "seq int, src string, number string, parties string")
    got = rows(packed.explode_packed(df, "parties", ["seq"], source=F.col("src"), out="party", least_score=0.95))
    assert [(0, 0, "NOME 0 UM"), (0, 1, "NOME 0 DOIS")] == [r for r in got if r[0] == 0]
    assert (100, 1, "NOME 0 DOIS, LTDA") in got


def test_small_sources_lean_on_the_others(spark):
    big = [(k, "a", f"g{k % 7}", f"NOME {k} UM; NOME {k} DOIS") for k in range(200)]
    small = [(1000, "b", "h", "NOME DE UM;ZZ; NOME DE DOIS"), (1001, "b", "i", "NOME DE UM; NOME DE DOIS")]  # half of its pieces are odd
    df = spark.createDataFrame(big + small, "seq int, src string, number string, parties string")
    accepted = lambda prior: {r.source_key for r in packed.infer_delimiters(df, "parties", F.col("src"), "number", prior_rows=prior).where("accepted and candidate = 'semicolon'").collect()}
    assert accepted(0) == {"a"} and accepted(100) == {"a", "b"}
    assert packed.infer_delimiters(df.where("false"), "parties", F.col("src"), "number", prior_rows=100).count() == 0


def test_nulls_blanks_repeats_and_positions(spark):
    df = spark.createDataFrame(CELLS, "seq int, number string, parties string").withColumn("pos", F.lit("clash")).withColumn("value", F.lit(1))
    got = rows(packed.explode_packed(df, "parties", ["seq"], group="number", out="party"))
    assert not [r for r in got if r[0] in (7, 8, 9)]
    assert [r for r in got if r[0] == 10] == [(10, 0, "SO UM NOME")] * 2


def test_empty_table_and_very_long_field(spark):
    empty = spark.createDataFrame([], "seq int, number string, parties string")
    assert packed.explode_packed(empty, "parties", ["seq"], group="number").count() == 0
    long = ";".join(f'"NOME {k}; COM ""X"" Y"' for k in range(60_000))
    df = spark.createDataFrame([(1, "n", long)], "seq int, number string, parties string")
    assert df.select(F.size(packed.split_packed(F.col("parties"), NAMES)).alias("n")).first().n == 60_000
