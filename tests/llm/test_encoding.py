from pyspark.sql import functions as F

from sievemill.llm import encoding as E

WORDS = ["AÇÃO CÍVEL", "Petição Inicial", "Certidão de Intimação nº 7", "JOSÉ ANTÔNIO", "Remetidos os Autos (órgão julgador)", "EXECUÇÃO DE TÍTULO", "SENTENÇA", "Inclusão às 10:00", "RELATÓRIO", "Razões de Apelação", "Laudo Médico", "Decisão Monocrática", "MÁRCIA CONCEIÇÃO"]
GENUINE = ["QUEM SABE? EVENTOS ME", "MUÑOZ & ÅSGARD LTDA", "PADÃO® PANIFICADORA", "JOÃO", "PLAIN", "", "Sim, enviada? Não", None]


def _table(spark):
    rows = [(k, w) for k, w in enumerate(WORDS * 60)] + [(10_000 + k, g) for k, g in enumerate(GENUINE * 3)]
    bad = {}
    for k, w in enumerate(WORDS):
        bad[20_000 + k] = (w.encode().decode("latin-1"), w)
        bad[21_000 + k] = (w.encode("cp1252").decode("cp850"), w)
        bad[22_000 + k] = (w.encode("cp1252").decode("mac_roman"), w)
    bad[23_000] = ("AÃ‡ÃƒO CÃ\x8dVEL", "AÇÃO CÍVEL")
    bad[23_001] = ("PetiÃƒÂ§ÃƒÂ£o Inicial", "Petição Inicial")
    bad[23_002] = ("laudo mã©dico", "laudo médico")
    bad[23_003] = ("Peti&ccedil;&atilde;o Inicial", "Petição Inicial")
    lost = {30_000: "A��O", 30_001: "SENTEN?A", 30_002: "Certid?o", 30_003: "JOS? ANTÔNIO"}
    all_rows = rows + [(k, v[0]) for k, v in bad.items()] + list(lost.items())
    return spark.createDataFrame(all_rows, "id int, value string").withColumn("fixed", F.lit("clash")), bad, lost


def test_damaged_values_are_found_and_restored(spark):
    df, bad, lost = _table(spark)
    found = {r.id: r for r in E.find_damaged(df, "value", ["id"]).collect()}
    assert set(lost) <= set(found) and not any(found[k].whole for k in lost)
    assert not [k for k in found if k < 20_000], [found[k].value for k in found if k < 20_000]
    damaged = {k for k, v in bad.items() if v[0] != v[1]}
    assert len(damaged & set(found)) / len(damaged) > 0.95
    right = [k for k in damaged & set(found) if found[k].fixed == bad[k][1]]
    assert len(right) / len(damaged) > 0.9


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "id int, value string")
    assert E.find_damaged(empty, "value", ["id"]).count() == 0
    long = ("Petição Inicial " * 3000).encode().decode("latin-1")
    df, _, _ = _table(spark)
    more = df.select("id", "value").union(spark.createDataFrame([(40_000, long), (40_000, long)], "id int, value string"))
    found = [r for r in E.find_damaged(more, "value", ["id"]).where("id = 40000").collect()]
    assert len(found) == 2 and found[0].fixed == "Petição Inicial " * 3000
