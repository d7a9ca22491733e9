from itertools import combinations

from conftest import rows
from pyspark.sql import functions as F

from sievemill.llm import names as N

SCHEMA = "party_id bigint, name string, oab string, doc_value string"


def _entities(spark, data):
    df = spark.createDataFrame(data, SCHEMA).withColumn("id", F.lit("clash")).withColumn("root", F.lit(1))
    out = {}
    for r in N.entities(df, "party_id", "name", "oab", "doc_value").collect():
        out.setdefault(r.entity, set()).add(r.id)
    return sorted(map(sorted, out.values()))


def test_variants_meet_and_namesakes_part(spark):
    data = [
        (1, "MARIA HELENA DE LAMFIBURANTE ALDPAGARANTE", None, None), (2, "Maria H. Lamfiburante Aldpagarante", None, None),
        (3, "ALDPAGARANTE, MARIA HELENA LAMFIBURANTE", None, None), (4, "DRA. MARIA HELENA LAMFIBURATE ALDPAGARANTE", None, None),
        (5, "maria helena lamfiburante-aldpagarante", None, None), (6, "MARIA HELENA DE LAMFIBURANTE ALDPAGARANTE NETO", None, None),
        (10, "GEGÊ VALROVASANTE PINCELAMEIRA", "RN575925A", None), (11, "GETÚLIO VALROVASANTE PINCELAMEIRA", "575925A/RN", None),
        (20, "RUI BORSANTE TELMURAO", "PE1111", None), (21, "RUI BORSANTE TELMURAO", "OAB/PE 1.111", None), (22, "RUI BORSANTE TELMURAO", "PE84822", None),
        (23, "RUI BORSANTE TELMURAO", "PE 84822", None), (24, "RUI BORSANTE TELMURAO", "PE1112", None), (25, "RUI BORSANTE TELMURAO", "CE777", None),
        (30, "CASTOR E BELMUR COMÉRCIO DE TECIDOS LTDA", None, None), (31, "Castor & Belmur Com. de Tecidos Limitada", None, None), (32, "CASTOR BELMUR TRANSPORTES LTDA", None, None),
        (40, "MUNICÍPIO DE ZANDROLIM DO MONTUSSI", None, None), (41, "PREFEITURA DE ZANDROLIM DO MONTUSSI", None, None), (42, "Mun. de Zandrolim do Montusi", None, None),
        (50, None, "RN1", "1"), (51, "  ", "RN1", "1"), (60, "FERNANDO QUARPETAO LINDROSAL", None, None), (61, "FERNANDO QUARPETAO LINDROSAL", None, None), (62, "FERNANDO QUARPETAO LINDROSAL", None, None),
        (63, "FERNANDA QUARPETAO LINDROSAL", None, None), (64, "FERNANDA QUARPETAO LINDROSAL", None, None), (65, "FERNANDA QUARPETAO LINDROSAL", None, None),
        (70, "X ALFOMBRAO", None, "123.456.789-00"), (71, "ALFOMBRAO XAVIER MUNDORIM", None, "12345678900"),
    ]
    got = _entities(spark, data)
    for want in ([1, 2, 3, 4, 5], [6], [10, 11], [22, 23], [20, 21, 24, 25], [30, 31], [32], [40, 41, 42], [60, 61, 62], [63, 64, 65], [70, 71]):
        assert want in got, (want, got)
    assert not any(50 in g or 51 in g for g in got)


def test_pairs_and_hot_name(spark):
    found = spark.createDataFrame([(1, "a"), (3, "a"), (2, "a"), (9, "b")], "id bigint, entity string")
    assert rows(N.same_entity_pairs(found)) == [(1, 2), (1, 3), (2, 3)]
    data = [(k, "ANA PAULA MONTRESUR BELGARIM" if k % 3 == 0 else f"JOSE {chr(65 + k % 26)}ALT{k}URAO BERG{k}ALIM", None, None) for k in range(300)]
    assert sorted(range(0, 300, 3)) in _entities(spark, data)


def test_chunked_blocks_give_the_same(spark, monkeypatch):
    data = [(k, f"ANA MONTRESUR BELGARIM {a}" if a else "ANA MONTRESUR BELGARIM", None, None) for k, a in enumerate(["", "A", "B", "PAULA", "LUCIA", "RITA", "CELIA"])]
    want = _entities(spark, data)
    monkeypatch.setattr(N, "CHUNK", 2)
    assert _entities(spark, data) == want


def test_empty_and_long(spark):
    assert _entities(spark, []) == []
    assert _entities(spark, [(1, "NOME " * 2000, None, None), (2, "NOME " * 2000, None, None)]) == [[1, 2]]


def test_registration(spark):
    df = spark.createDataFrame([("OAB/AL 1.014-A",), ("rn nº 070442",), ("575925A/RN",), ("",), (None,), ("nothing",)], "o string")
    got = [r.r and (r.r.state, r.r.num) for r in df.select(N.registration(F.col("o")).alias("r")).collect()]
    assert got == [("AL", "1014"), ("RN", "70442"), ("RN", "575925"), None, None, None]


def test_abbreviation_of_a_hot_name(spark):
    hot = [(k, "LUCIA INACIO VENNELAMEDO MONLADOREDO", None, None) for k in range(200)]
    other = [(1000 + k, f"LUCIA INACIO {chr(65 + k % 26)}ALT{chr(65 + k // 26)}URAO", None, None) for k in range(100)]
    got = _entities(spark, [*hot, *other, (900, "LUCIA INACIO V. MONLADOREDO", None, None)])
    assert [*range(200), 900] in got


def test_words_of_frequent_names_make_pairs():
    name = N.parse("LUCIA INACIO VENNELAMEDO MONLADOREDO")
    keys = N.block_keys(name, dict.fromkeys(name.words, 50_000))
    assert {"LUCIA MONLADOREDO", "INACIO LUCIA", "INACIO MONLADOREDO"} <= set(keys)


def test_short_forms_are_learnt_from_shared_marks(spark):
    """A short form no list has, seen under shared registrations, links names that share none."""
    data = []
    for k in range(4):
        data += [(10 * k, f"WANDERGILSON ALFOM{k}BRAO MUN{k}DORIM", f"PE10{k}7{k}", None), (10 * k + 1, f"GILSINHO ALFOM{k}BRAO MUN{k}DORIM".replace("GILSINHO", "DERGO"), f"PE10{k}7{k}", None)]
    data += [(100, "WANDERGILSON QUARPETAO LINDROSAL", None, None), (101, "DERGO QUARPETAO LINDROSAL", None, None), (102, "TADEU QUARPETAO LINDROSAL", None, None)]
    got = _entities(spark, data)
    assert [100, 101] in got and [102] in got
    assert N._diminutive("PEDRINHO", "PEDRO") and N._diminutive("CARLINHOS", "CARLOS") and N._diminutive("ANINHA", "ANA") and not N._diminutive("MARINHO", "PEDRO")


def test_hot_block_is_split_and_keeps_its_pairs(spark, monkeypatch):
    """Forms that share two frequent words: all meet whom they fit, typo, initial, nickname or dropped word, however large the block."""
    third = [f"{a}{b}LDORIMAU" for a in "BCDFGHJKLM" for b in "AEIOU"]
    data = [(k, f"MARIA SILVA {w}", None, None) for k, w in enumerate(third) for _ in range(3)]
    data = [(3 * k + i, *r[1:]) for k, r in enumerate(data[::3]) for i in range(3)]
    data += [(900, "MARIA SILVA BALDORIMU", None, None), (901, "MARIA SILVA CEDLORIMAU", None, None), (902, "MARIA F. SILVA XUNDERBAL", None, None), (903, "MARIA FRANCISCA SILVA XUNDERBAL", None, None), (904, "MARIA CHICA SILVA XUNDERBAL", None, None)]
    want = _entities(spark, data)
    assert [902, 903, 904] in want and any(900 in g and len(g) > 1 for g in want)
    monkeypatch.setattr(N, "CHUNK", 5)
    assert _entities(spark, data) == want


def test_namesakes_part_in_every_state(spark):
    data = [(k, "RUI BORSANTE TELMURAO", oab, None) for k, oab in enumerate(["PE1111", "PE1111", "PE84822", "CE500", "CE500", "CE77123"])]
    assert _entities(spark, data) == [[0, 1, 3, 4], [2], [5]]


def _met(spark, keys):
    """Per line of a form the pairs that :func:`candidates` brings together, and those of all pairs that fit."""
    forms = spark.createDataFrame([(k, key, n) for k, (key, n) in enumerate(sorted(keys.items()))], "id bigint, key string, n bigint")
    lines = N.described(forms, spark.createDataFrame([], "word string, full array<string>")).persist()
    line = {r.id: r.line for r in lines.collect()}
    met = {(r.a, r.b) for r in N.candidates(lines).collect()}
    return line, met, {(a, b) for a, b in combinations(sorted(line), 2) if N.compare(line[a], line[b])}


def test_candidates_are_all_that_fit(spark, data):
    """Against brute force: swaps, two edits, initials on either side, a name less, short forms, D., unreadable letters, many tokens, typos in both words."""
    made = [
        "MARIA HELENA LAMFIBURANTE ALDPAGARANTE", "MARIA H. LAMFIBURANTE ALDPAGARANTE", "M. HELENA LAMFIBURANTE ALDPAGARANTE", "MARIA LAMFIBURANTE ALDPAGARANTE", "MARAI HELENA LAMFIBRUANTE ALDPAGARANTE", "MARIA HELENA LAMIBURATE ALDPAGARANTE",
        "MARIA HELENA D. LAMFIBURANTE ALDPAGARANTE", "MARIA H. DALVA LAMFIBURANTE", "MARIA HELENA D. LAMFIBURANTE", "RITA PEDRINHO QUARPETAO", "RITA PEDRO QUARPETAO", "ZE QUARPETAO", "JOSE QUARPETAO", "M?RIA HELENA LAMF?BURAT ALDPAGARANTE", "M??IA HELENA LAMFIBURANTE ALDPAGARANTE",
        "BRUFIDELATE NERNULUSED", "BRUFIDELANTE NERNULUSEDO", "ANA BIA CARLA DORA EVA FABIA GILDA MUNDORIM", "ANA B. CARLA DORA EVA FABIA GILDA MUNDORIM", "ANA BIA CARLA DORA EVA FABIA G. MUNDORI", "ANA BIA CARLA DORA EVA FABIA MUNDORIM", "ANA B. C. D. E. FABIA", "ANA BIA C. D. EVA FABIA", "CASTOR LTDA", "D. CASTOR LTDA",
    ]
    names = [*made, *(r.name for r in spark.read.parquet(f"{data}/party_rows.parquet").select("name").where("name is not null").collect())]
    keys = {}
    for k, name in enumerate(names):
        keys[N.parse(name).key()] = 1 + k % 7
    line, met, want = _met(spark, keys)
    assert want <= met, [(line[a], line[b]) for a, b in want - met]
    assert len(want) > 30


def test_frequent_names_in_common_bring_nobody_together(spark):
    """As many candidates as fit, not as pairs in a block, when hundreds share two frequent names and an initial."""
    tails = [f"{a}{b}{c}DORIMAU" for a in ("BRU", "BEL", "BOR") for b in ("ZATO", "LIFE", "NUGA", "PIRO", "SEMI", "VUCA", "DOLI", "TRAPE", "FIGO", "MUNE") for c in ("LOSTA", "VERNI", "GUBRO", "PAMSE", "CIDUL", "ZORFE", "TALNI", "FESPO")]
    keys = {N.parse(f"MARIA HELENA {w}").key(): 5 for w in tails} | {N.parse("MARIA HELENA B.").key(): 1}
    line, met, want = _met(spark, keys)
    assert len(line) == 241 and want <= met
    assert len(met) <= 2 * len(tails) + len(want)
