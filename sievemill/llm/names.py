"""Variant spellings of names typed by people.

Noisy-channel attribution: short forms of names are learnt from what stands
under one registration; spellings are brought to bags of tokens; frequent
and complete spellings are candidate canonical forms; the likelihood of a
variant under a form is built from typos, abbreviations, nicknames and
dropped words, and is joined with the form's frequency as prior. Each variant
is attached to the form of the highest posterior. Registrations then part
namesakes and join spellings too far apart for the channel.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.llm import encoding
from sievemill.session import cut

#: Common Portuguese short forms of given names and spellings of one sound. Fixed values; further ones are learnt.
NICKNAMES = {
    "ALEX": ("ALEXANDRE",), "BEL": ("ISABEL", "IZABEL"), "BIEL": ("GABRIEL",), "BIU": ("SEVERINO",), "CACA": ("CARLOS",), "CEICA": ("CONCEICAO",), "BETO": ("ROBERTO", "ALBERTO"), "BIA": ("BEATRIZ",), "CHICA": ("FRANCISCA",), "CHICO": ("FRANCISCO",), "DANI": ("DANIEL", "DANIELA"),
    "DUDA": ("EDUARDA", "EDUARDO"), "DUDU": ("EDUARDO",), "EDU": ("EDUARDO",), "GABI": ("GABRIELA",), "GEGE": ("GETULIO",), "GUIDA": ("MARGARIDA",), "GUGA": ("GUSTAVO",), "GUTO": ("AUGUSTO", "GUSTAVO"), "IZABEL": ("ISABEL",),
    "JOCA": ("JOAO", "JORGE", "JOSE"), "JU": ("JULIA", "JULIANA"), "LENA": ("HELENA", "MADALENA"), "LEO": ("LEONARDO",), "LU": ("LUCIA", "LUCIANA"), "LUIS": ("LUIZ",), "LULA": ("LUIZ", "LUIS"),
    "MANE": ("MANOEL", "MANUEL"), "MANU": ("MANUELA", "MANOEL"), "MANUEL": ("MANOEL",), "MARI": ("MARIANA",), "MUNDINHO": ("RAIMUNDO",), "NANDA": ("FERNANDA",), "NANDO": ("FERNANDO",), "PATI": ("PATRICIA",), "RAFA": ("RAFAEL", "RAFAELA"),
    "TECA": ("TEREZINHA", "TERESA"), "TIAGO": ("THIAGO",), "TIAO": ("SEBASTIAO",), "TONHO": ("ANTONIO",), "TONICA": ("ANTONIA",), "TONINHO": ("ANTONIO",), "SEBA": ("SEBASTIAO",), "VINI": ("VINICIUS",), "XANDE": ("ALEXANDRE",), "ZE": ("JOSE",), "ZECA": ("JOSE",), "ZEZE": ("JOSE", "MARIA"),
}
TITLES = frozenset("DR DRA ADV SR SRA DOUTOR DOUTORA PROF PROFA EXMO EXMA".split())
CONNECTORS = frozenset("DE DA DO DAS DOS E DI DU".split())
#: Kinship endings tell relatives apart. Fixed values.
ENDINGS = {"FILHO": "FILHO", "FILHA": "FILHA", "FO": "FILHO", "NETO": "NETO", "NETTO": "NETO", "NETA": "NETA", "SOBRINHO": "SOBRINHO", "SOB": "SOBRINHO", "JUNIOR": "JUNIOR", "JR": "JUNIOR", "SEGUNDO": "SEGUNDO", "TERCEIRO": "TERCEIRO"}
LEGAL = {"LTDA": "LTDA", "LIMITADA": "LTDA", "EPP": "EPP", "ME": "ME", "MICROEMPRESA": "ME", "MEI": "MEI", "SA": "SA", "EIRELI": "EIRELI", "CIA": "CIA"}
#: Words of what an organisation does or is. Fixed values.
TRADE = frozenset(
    "IMPORTACAO EXPORTACAO COMERCIO INDUSTRIA SERVICOS DISTRIBUIDORA EMPREENDIMENTOS IMOBILIARIOS CONSTRUCOES CONSTRUTORA TRANSPORTES CONFECCOES "
    "TECNOLOGIA INFORMACAO ALIMENTOS BEBIDAS TECIDOS CERAMICAS MEDICOS USINA ACUCAR ADVOGADOS FILIAL PANIFICADORA EVENTOS CONSORCIO".split()
)
OFFICE = frozenset("MUNICIPIO UNIVERSIDADE FUNDACAO INSTITUTO CONSELHO SUPERINTENDENCIA ASSOCIACAO FRENTE UNIAO ESTADO PREVIDENCIA REGIONAL PORTO TERRAS".split())
TOWN = frozenset("MUNICIPIO PREFEITURA MUNICIPAL FAZENDA MUN MUNIC PREF".split())
SHORT_TRADE = frozenset("IMP EXP COM IND SERV DISTRIB EMPREEND CONSTR TRANSP".split())
#: No block is parted in chunks any more; tests still set this.
CHUNK = 300
#: Forms of this many tokens or more meet by pairs of words, those of this many or fewer by signatures.
LONG_NAME = 6
#: The part of a word's rows that one misspelling of it takes.
TYPO_SHARE = 0.04


class Name(NamedTuple):
    """A parsed name: distinctive words, initials, ending, legal form, trade words, office."""

    words: tuple[str, ...]
    initials: tuple[str, ...]
    ending: str
    legal: str
    trade: tuple[str, ...]
    office: tuple[str, ...]

    def key(self) -> str:
        return "|".join([" ".join(self.words), " ".join(self.initials), self.ending, self.legal, " ".join(self.trade), " ".join(self.office)])


def parse(name: str) -> Name:
    """The bag of a name: no accents, case, order, titles, connectors, hyphens."""
    text = unicodedata.normalize("NFKD", name)
    text = "".join(c for c in text if not unicodedata.combining(c)).upper()
    text = re.sub(r"\bS\s*/\s*A\b|\bS\.\s?A\b\.?|\bSOCIEDADE ANONIMA\b", " SA ", text)
    text = re.sub(r"\bE\.\s?P\.\s?P\b\.?", " EPP ", text)
    text = re.sub(r"\bM\.\s?E\b\.?", " ME ", text)
    text = re.sub(r"\bT\.\s?I\b\.?|\bTI\b", " TECNOLOGIA INFORMACAO ", text)
    text = re.sub(r"[’'`´]", "", text)
    words, initials, trade, office, ending, legal = [], [], [], [], "", ""
    tokens = re.findall(r"([A-Z?�]+)(\.?)", text)
    corporate = any(t in LEGAL or t in TRADE or t in OFFICE or t in TOWN or t in SHORT_TRADE for t, _ in tokens)
    for token, dot in tokens:
        if token in TITLES or token == "BEL" and dot or token in CONNECTORS or token == "PUBLICA" and corporate:
            continue
        if token in TOWN:
            office.append("MUNICIPIO")
        elif token in OFFICE:
            office.append(token)
        elif token in LEGAL:
            legal = LEGAL[token]
        elif token in TRADE:
            trade.append(token)
        elif corporate and dot and len(token) >= 2 and (full := [w for w in TRADE if w.startswith(token)]):
            trade.append(min(full))
        elif token in SHORT_TRADE:
            trade.append(min(w for w in TRADE if w.startswith(token)))
        elif token in ENDINGS and words:
            ending = ENDINGS[token]
        elif len(token) == 1:
            initials.append(token)
        else:
            words.append(token)
    return Name(tuple(sorted(words)), tuple(sorted(initials)), ending, legal, tuple(sorted(set(trade))), tuple(sorted(set(office))))


_UNREADABLE = frozenset("?\ufffd")


def edits(a: str, b: str, limit: int = 2) -> int:
    """Edit distance with swaps of neighbours, up to ``limit`` + 1; unreadable characters match any."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    # One edit brings one letter more to either word at most.
    own, other = set(a), set(b)
    if (len(own - other) > limit or len(other - own) > limit) and not (own | other) & _UNREADABLE:
        return limit + 1
    before2: list[int] = []
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            same = x == y or x in "?�" or y in "?�"
            d = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (not same))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            now.append(d)
        if min(now) > limit:
            return limit + 1
        before2, before = before, now
    return before[-1]


def _diminutive(a: str, b: str) -> bool:
    """Whether ``a`` is the diminutive of ``b``: PEDRINHO of PEDRO, CARLINHOS of CARLOS."""
    return a.endswith(("INHO", "INHA", "INHOS")) and len(stem := re.sub(r"[AEIOU]+S?$", "", b)) >= 2 and a.removesuffix("S")[:-4] in (stem, f"{stem}U", f"{stem}I")


def _short_for(a: str, b: str, learnt: dict[str, tuple[str, ...]]) -> bool:
    return any(x in NICKNAMES.get(y, ()) or x in learnt.get(y, ()) or _diminutive(y, x) for x, y in ((a, b), (b, a)))


def _full_forms(word: str, learnt: dict[str, tuple[str, ...]]) -> tuple[str, ...]:
    return (*NICKNAMES.get(word, ()), *learnt.get(word, ()))


def likelihood(v: Name, c: Name, counts: dict[str, int], learnt: dict[str, tuple[str, ...]] | None = None) -> float | None:
    """Log-likelihood of the variant ``v`` under the form ``c``, None if it can't be one.

    ``counts`` has the rows per word, ``learnt`` the short forms found in the
    data with what they stand for. Two words are a typo of one another only
    if one of them is rare beside the other: frequent words that differ in a
    letter (a man's and a woman's name) are different names.
    """
    if v.ending != c.ending:
        return None
    if v.legal and c.legal and v.legal != c.legal:
        return None
    if v.office and c.office and not set(v.office) & set(c.office):
        return None
    if v.trade and c.trade and not set(v.trade) & set(c.trade):
        return None
    learnt = learnt or {}
    corporate = bool(c.legal or c.trade or c.office or v.legal or v.trade or v.office)
    cost = 1.5 * (v.legal != c.legal) + 1.5 * (v.trade != c.trade) + 1.5 * (v.office != c.office)
    left_v, left_c = list(v.words), list(c.words)
    full = 0
    for w in v.words:
        if w in left_c:
            left_c.remove(w)
            left_v.remove(w)
            full += 1
    typos = 0
    for w in list(left_v):
        best = None
        for x in left_c:
            if _short_for(w, x, learnt):
                best = (3.0, x, 0)
                break
            d = edits(w, x, 2 if min(len(w), len(x)) >= 8 else 1)
            if d <= (2 if min(len(w), len(x)) >= 8 else 1 if min(len(w), len(x)) >= 3 else 0):
                low, high = sorted((counts.get(w, 1), counts.get(x, 1)))
                # A misspelling makes up TYPO_SHARE of a word's rows, give or take two deviations.
                if low <= 1 + TYPO_SHARE * high + 2 * math.sqrt(TYPO_SHARE * high) or "?" in w + x or "�" in w + x:
                    price = 4.0 if d <= 1 else 9.0
                    if best is None or price < best[0]:
                        best = (price, x, d)
        if best:
            cost += best[0]
            typos += best[2]
            full += 1
            left_v.remove(w)
            left_c.remove(best[1])
    if typos > 3:
        return None
    ini_v, ini_c = list(v.initials), list(c.initials)
    for i in list(ini_v):
        if i in ini_c:
            ini_v.remove(i)
            ini_c.remove(i)
    matched = full + len(v.initials) - len(ini_v)
    for i in list(ini_v):
        x = next((x for x in left_c if x[0] == i), None)
        if x:
            left_c.remove(x)
            ini_v.remove(i)
            cost += 2.0
            matched += 1
    for i in list(ini_c):
        x = next((x for x in left_v if x[0] == i), None)
        if x:
            left_v.remove(x)
            ini_c.remove(i)
            cost += 2.0
            matched += 1
    ini_v = [i for i in ini_v if i != "D"]
    ini_c = [i for i in ini_c if i != "D"]
    extra_v, extra_c = len(left_v) + len(ini_v), len(left_c) + len(ini_c)
    if extra_v and extra_c:
        return None
    extra = extra_v + extra_c
    if extra > 1:
        return None
    if extra:
        lost = (left_v or left_c or [""])[0]
        whole = v.words if extra_v else c.words
        # Only a word that isn't one of the two rarest of its name is dropped: a second given name, not a surname.
        rarest = sorted(whole, key=lambda w: (counts.get(w, 1), -len(w), w))[:2]
        if matched < 3 or lost in rarest:
            return None
        cost += 2.5
    if full < 2 and not (full == 1 and len(v.words) == len(c.words) == 1 and cost == 0):
        return None
    if typos and full - bool(typos) < 1:
        return None
    if not corporate and matched < 2:
        return None
    return -cost


def rank(n: Name, rows: int, counts: dict[str, int], learnt: dict[str, tuple[str, ...]] | None = None) -> tuple:
    """The order of canonical forms: complete before abbreviated, frequent before rare."""
    nick = sum(w in NICKNAMES or w in (learnt or {}) or w.endswith(("INHO", "INHA", "INHOS")) for w in n.words)
    parts = len(n.words) - nick + 0.5 * bool(n.legal) + 0.5 * bool(n.trade) + 0.5 * bool(n.office)
    return (parts, rows, sum(math.log(counts.get(w, 1)) for w in n.words), n.key())


def from_key(key: str) -> Name:
    a, b, ending, legal, trade, office = key.split("|")
    return Name(tuple(a.split()), tuple(b.split()), ending, legal, tuple(trade.split()), tuple(office.split()))


def _skeleton(word: str) -> str:
    """The consonants that survive typing: no vowels, doubled or unreadable letters."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[AEIOUYHC?\uFFFD]", "", word))


def block_keys(n: Name, counts: dict[str, int], learnt: dict[str, tuple[str, ...]] | None = None) -> list[str]:
    """The blocks of a spelling: all pairs of words, however frequent. Only a measure for :func:`candidates`, which finds what these find and more.

    Short forms of given names also stand for the names. For the two rarest
    words there are also pairs with one letter left out of either, so that a
    typo in one of only two words still meets, and the pair of consonant
    skeletons, for typos in both.
    """
    learnt = learnt or {}
    words = sorted({w for w in n.words if len(w) >= 3}, key=lambda w: (counts.get(w, 1), w))
    out = set()
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            out |= {f"{min(x, y)} {max(x, y)}" for x in (a, *_full_forms(a, learnt)) for y in (b, *_full_forms(b, learnt))}
    if len(n.words) == 2 and len(n.words[0]) == 2:
        out |= {f"{min(x, n.words[1])} {max(x, n.words[1])}" for x in _full_forms(n.words[0], learnt)}
    if len(words) >= 2:
        for keep, gone in ((words[0], words[1]), (words[1], words[0]), *(((words[-1], words[0]), (words[-1], words[1])) if len(words) == 3 else ())):
            if len(gone) >= 5:
                out |= {f"{keep} -{gone[:k]}{gone[k + 1:]}" for k in range(len(gone))} | {f"{keep} -{gone}"}
        long = sorted(words, key=lambda w: (-len(w), w))[:2]
        bones = sorted(map(_skeleton, long))
        if min(map(len, bones)) >= 3:
            out.add(f"~{bones[0]} {bones[1]}")
    if len(words) == 1:
        out.add(f"= {words[0]} {n.office}")
    return sorted(out)


def compare(a: str, b: str) -> tuple[bool, float] | None:
    """Two lines of forms: whether the first is the variant, and its score under the other; null if neither fits.

    The higher form by :func:`rank` is the canonical one. The score is the
    log-likelihood of the variant plus the log of the form's rows.
    """
    (x, na, ca, la, ra), (y, nb, cb, lb, rb) = _counted(a), _counted(b)
    if x.ending != y.ending:
        return None
    counts, learnt = ca | cb, la | lb
    first = ra < rb
    fit = likelihood(x, y, counts, learnt) if first else likelihood(y, x, counts, learnt)
    return None if fit is None else (first, fit + math.log(nb if first else na))


def registration(oab: Column) -> Column:
    """State and number of a bar registration as struct(state, num); null if unreadable."""
    text = F.upper(F.regexp_replace(oab, "(?i)oab", " "))
    digits = F.regexp_replace(F.regexp_extract(text, r"(\d[\d.]*)", 1), r"\.|^0+", "")
    state = F.regexp_extract(text, r"([A-Z]{2})", 1)
    num = F.regexp_replace(digits, "^0+", "")
    return F.when((num != "") & (state != ""), F.struct(state.alias("state"), num.alias("num")))


@lru_cache(maxsize=50_000)
def _counted(line: str) -> tuple[Name, int, dict[str, int], dict[str, tuple[str, ...]], tuple]:
    """A form's line, parted by tabs: its name, rows, rows of each word, what its words are learnt to be short for, and its rank."""
    key, rows, counts, short = line.split("\t")
    name = from_key(key)
    full = (x.split("=") for x in short.split(";") if x)
    of_words, learnt = dict(zip(name.words, map(int, counts.split(",") if counts else []), strict=False)), {w: tuple(f.split(",")) for w, f in full}
    return name, int(rows), of_words, learnt, rank(name, int(rows), of_words, learnt)


def learn_short_forms(keyed: DataFrame, marks: DataFrame, least: int = 2, share: float = 0.3) -> DataFrame:
    """Words that stand for other words under one registration or tax number: ``word, full`` (an array).

    ``keyed`` has ``id, key``, ``marks`` ``id, reg, tax``. Under each mark
    every form is held against the most frequent one. Where two forms differ
    in one word each, no typo of one another, and agree in another, the
    rarer word stands for the other. Pairs of at least ``least`` marks that
    make up ``share`` of what the word stands for are kept.
    """
    of = marks.select("id", F.explode(F.array(F.concat(F.lit("r"), F.col("reg.state"), F.col("reg.num")), F.concat(F.lit("t"), "tax"))).alias("mark")).where("mark is not null")
    held = of.join(keyed, "id").groupBy("mark", "key").agg(F.count(F.lit(1)).alias("n"))
    heads = held.groupBy("mark").agg(F.max(F.struct("n", "key")).alias("h"), F.count(F.lit(1)).alias("k")).where("k > 1").select("mark", F.col("h.key").alias("head"))
    both = held.join(heads, "mark").where("key <> head")

    @F.pandas_udf("word string, full string")
    def differing(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        def one(x: str, y: str) -> tuple[str | None, str | None]:
            v, c = from_key(x), from_key(y)
            only_v, only_c = [w for w in v.words if w not in c.words], [w for w in c.words if w not in v.words]
            if len(only_v) != 1 or len(only_c) != 1 or len(v.words) < 2 or v.ending != c.ending or v.legal or c.legal or edits(only_v[0], only_c[0], 2) <= 2:
                return None, None
            return only_v[0], only_c[0]

        return pd.DataFrame([one(x, y) for x, y in zip(a, b, strict=True)], columns=["word", "full"]).astype("object")

    pairs = both.select("mark", differing("key", "head").alias("d")).where("d.word is not null").groupBy("d.word", "d.full").agg(F.count_distinct("mark").alias("n"))
    # Seen both ways round; the word of fewer rows is the short form.
    pairs = cut(pairs.where("word is not null").groupBy(F.least("word", "full").alias("a"), F.greatest("word", "full").alias("b")).agg(F.sum("n").alias("n")))
    named = pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct()
    rows = keyed.select(F.explode(F.split(F.split("key", r"\|")[0], " ")).alias("w")).join(named, "w").groupBy("w").agg(F.count(F.lit(1)).alias("rows"))
    sized = pairs.join(rows.withColumnsRenamed({"w": "a", "rows": "rows_a"}), "a").join(rows.withColumnsRenamed({"w": "b", "rows": "rows_b"}), "b")
    rarer = (F.col("rows_a") < F.col("rows_b")) | (F.col("rows_a") == F.col("rows_b")) & (F.length("a") <= F.length("b"))
    pairs = sized.select(F.when(rarer, F.col("a")).otherwise(F.col("b")).alias("word"), F.when(rarer, F.col("b")).otherwise(F.col("a")).alias("full"), "n")
    whole = pairs.groupBy("word").agg(F.sum("n").alias("all"))
    kept = pairs.join(whole, "word").where((F.col("n") >= least) & (F.col("n") >= share * F.col("all")))
    return kept.groupBy("word").agg(F.sort_array(F.collect_set("full")).alias("full"))


def spellings(df: DataFrame, row_id: str, name: str) -> DataFrame:
    """Each row with the key of its parsed name: ``id, key``.

    Garbled names are restored first. Rows without a letter in their name
    belong to nobody and are left out.
    """
    spark = df.sparkSession
    named = df.where(F.col(name).rlike(r"\p{L}")).select(F.col(row_id).alias("id"), F.col(name).alias("name"))
    model = encoding.learn(named, "name")
    shared = spark.sparkContext.broadcast((model.counts, model.total, model.finals))

    @F.pandas_udf("string")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding.Plausibility(*shared.value)
        for batch in batches:
            yield pd.Series([parse(encoding.judge(n, own)[1]).key() for n in batch])

    return named.select("id", keys("name").alias("key"))


def _pointers(parents: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """Follow parents to the roots by doubling; the pointers have no cycles."""
    now = cut(parents.select(F.col(child).alias("c"), F.col(parent).alias("p")))
    while True:
        up = now.select(F.col("c").alias("p"), F.col("p").alias("g"))
        after = cut(now.join(up, "p", "left").select("c", F.coalesce("g", "p").alias("p"), F.col("g").isNotNull().alias("moved")))
        if after.where("moved").isEmpty():
            return after.select(F.col("c").alias(child), F.col("p").alias(parent))
        now = after.select("c", "p")


def _deletions(word: str, depth: int) -> set[str]:
    """The word, and what is left of it without up to ``depth`` letters."""
    out = now = {word}
    for _ in range(depth):
        now = {w[:k] + w[k + 1 :] for w in now for k in range(len(w))}
        out = out | now
    return out


def _limit(a: str, b: str) -> int:
    """The edits by which two words may be apart."""
    return 2 if min(len(a), len(b)) >= 8 else 1 if min(len(a), len(b)) >= 3 else 0


def kindred(words: DataFrame) -> DataFrame:
    """What a word may be a misspelling or a diminutive of: ``word, up, d``. ``words`` has each ``word`` once with its rows ``c``.

    All pairs of words that :func:`likelihood` takes for a typo of one
    another are found, each as a step from the rarer word up. They are looked
    for among the distinct words, of which there are far fewer than names.
    Edits leave a common rest after as many letters are left out of both.
    Words with unreadable characters are held against all others by the
    letters they have.
    """
    spark = words.sparkSession
    unreadable = F.col("word").rlike("[?\ufffd]")
    # Few bytes, but much to do for each word; what comes of them is many times larger than Spark takes it for, so it is merged, not broadcast.
    spread = words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    @F.pandas_udf("array<bigint>")
    def rests(given: pd.Series) -> pd.Series:
        return given.map(lambda w: [_block_hash(r) for r in _deletions(w, _limit(w, w))])

    clear = cut(spread.where(~unreadable & (F.length("word") >= 3)).select("word", "c", F.explode(rests("word")).alias("rest")).repartition("rest").sortWithinPartitions("rest"))
    low, high = (clear.select("rest", F.col("word").alias(w), F.col("c").alias(c)) for w, c in (("word", "low"), ("up", "high")))
    # As in likelihood: a misspelling makes up TYPO_SHARE of a word's rows, give or take two deviations.
    rare = (F.col("low") < F.col("high")) | (F.col("low") == F.col("high")) & (F.col("word") < F.col("up"))
    rare &= F.col("low") <= 1 + TYPO_SHARE * F.col("high") + 2 * F.sqrt(TYPO_SHARE * F.col("high")) + 1e-6
    bags = [F.array_join(F.array_sort(F.split(w, "")), "") for w in ("word", "up")]
    plain = F.levenshtein("word", "up")
    # A swap is two plain edits and leaves the letters as they are. At least as many edits as these are needed.
    d = F.when((plain <= 1) | (plain == 2) & (bags[0] == bags[1]), 1).when((plain == 2) | (plain <= 4) & (F.levenshtein(*bags) <= 2), 2)
    # Cut, or the edits would be counted before equal pairs are brought together.
    near = cut(low.hint("merge").join(high, "rest").where(rare).select("word", "up").distinct()).select("word", "up", d.alias("d"))
    near = near.where((F.col("d") == 1) | (F.col("d") == 2) & (F.least(F.length("word"), F.length("up")) >= 8))
    broken = sorted(r["word"] for r in words.where(unreadable).select("word").collect())
    if broken:
        shared = spark.sparkContext.broadcast(broken)

        @F.pandas_udf("array<string>")
        def like_broken(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held = shared.value
            letters, sizes, gaps = np.stack([_letters(w) for w in held]), np.array([len(w) for w in held]), np.array([sum(c in _UNREADABLE for c in w) for w in held])

            def one(w: str) -> list[str]:
                own, shorter, free = _letters(w), np.minimum(sizes, len(w)), sum(c in _UNREADABLE for c in w)
                most = np.where(shorter >= 8, 2, np.where(shorter >= 3, 1, 0))
                near = (np.abs(sizes - len(w)) <= most) & (np.maximum(letters - own, 0).sum(axis=1) <= most + free) & (np.maximum(own - letters, 0).sum(axis=1) <= most + gaps)
                return [f"{held[k]} {d}" for k in np.flatnonzero(near) if held[k] != w and (d := edits(w, held[k], _limit(w, held[k]))) <= _limit(w, held[k])]

            for batch in batches:
                yield batch.map(one)

        found = spread.select("word", F.explode(like_broken("word")).alias("b")).select("word", F.split_part("b", F.lit(" "), F.lit(1)).alias("up"), F.split_part("b", F.lit(" "), F.lit(2)).cast("int").alias("d"))
        # Shares of the rows say nothing here: the unreadable word steps to the other.
        near = near.unionByName(found.select(F.col("up").alias("word"), F.col("word").alias("up"), "d"))
    short = words.where(F.col("word").rlike("(INHO|INHA|INHOS)$")).select("word", F.regexp_replace("word", "INH(O|A|OS)$", "").alias("stem"))
    stem = F.regexp_replace("word", "[AEIOU]+S?$", "")
    full = words.where(F.length(stem) >= 2).select(F.col("word").alias("up"), F.explode(F.array(stem, F.concat(stem, F.lit("U")), F.concat(stem, F.lit("I")))).alias("stem"))
    return near.unionByName(short.join(full, "stem").where("word <> up").select("word", "up", F.lit(0).alias("d")))


def _letters(word: str) -> np.ndarray:
    return np.bincount([ord(c) - 65 for c in word if "A" <= c <= "Z"], minlength=26)


def _block_hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key) - (1 << 63)


def signatures(n: Name, counts: dict[str, int], learnt: dict[str, tuple[str, ...]], ups: dict[str, tuple[tuple[str, int], ...]]) -> Iterator[tuple[str, int, int, int, int]]:
    """The signatures by which a form meets all forms that fit it: key, tokens left out, words abbreviated, edits, initials in the key.

    Two forms that fit have, beside one token that either may lack, the same
    words and initials, if each word is read as itself, as what it may be a
    misspelling or short form of, or as its initial. So both hold a signature of one
    key, in which one of them leaves out a token at most, no token is abbreviated by
    both and three edits are made at most. Two words at least are kept, unless the names are equal but for
    connectors. Forms of many tokens, for which there would be too many signatures, meet by pairs of words.
    """
    read = {w: {w: 0} | {x: 0 for x in _full_forms(w, learnt)} for w in n.words}
    for w, own in read.items():
        for x, d in ups.get(w, ()):
            own[x] = min(d, own.get(x, d))
    initials = [i for i in n.initials if i != "D"]
    free = len(n.initials) - len(initials)
    least = len(n.words) + len(initials)
    if least + free >= LONG_NAME:
        several = [w for w, k in Counter(n.words).items() for _ in range(min(k, 2))]
        for a, b in combinations(several, 2):
            for x, y in product(read[a], read[b]):
                yield f"&{n.ending} {min(x, y)} {max(x, y)}", 0, 0, 0, 0
    if least > LONG_NAME:
        return
    rarest = sorted(n.words, key=lambda w: (counts.get(w, 1), -len(w), w))[:2]
    ways: list[list[tuple[str, int, int, int]]] = [[(x, 0, 0, d) for x, d in read[w].items()] + [(f"{w[0]}.", 0, 1, 0)] + ([("", 1, 0, 0)] if w not in rarest else []) for w in n.words]
    ways += [[(f"{i}.", 0, 0, 0), ("", 1, 0, 0)] for i in initials] + [[("D.", 0, 0, 0), ("", 0, 0, 0)]] * free
    found: list[tuple[tuple[str, ...], int, int, int]] = [((), 0, 0, 0)]
    words_left = len(n.words)
    for k, way in enumerate(ways):
        words_left = max(0, len(n.words) - k - 1)
        found = [
            ((*kept, token) if token else kept, lost + gone, cut_ + short, off + d)
            for kept, lost, cut_, off in found for token, gone, short, d in way
            if lost + gone <= 1 and off + d <= 3 and (len(n.words) < 2 or k >= len(n.words) or sum(t[-1] != "." for t in kept) + (token[-1:] not in ("", ".")) + words_left >= 2)
        ]
    for kept, lost, short, off in found:
        room = sum(t[-1] == "." for t in kept)
        if short <= room and (not lost or len(kept) >= 3) and (len(n.words) >= 2 or not (lost or short or off)):
            yield f"{n.ending} {' '.join(sorted(kept))}", lost, short, off, room


def candidates(lines: DataFrame) -> DataFrame:
    """The pairs of forms that may fit, each once: ``a, b`` (ids). ``lines`` has ``id, line, ups``.

    Only ids and hashes of :func:`signatures` are moved. Forms that hold frequent
    words in common, but nothing else, don't meet: a form that abbreviates meets only
    those that have the initial, one that leaves a token out only those that lack it.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, blocks, uses = [], [], []
            for i, line, ups in zip(*(batch.column(c).to_pylist() for c in ("id", "line", "ups")), strict=True):
                name, _, counts, learnt, _ = _counted(line)
                steps = {w: tuple((x, int(d)) for x, d in (t.split(":") for t in of.split(","))) for w, of in (x.split("=") for x in (ups or "").split(";") if x)}
                for block, use in {(_block_hash(key), lost | off << 1 | short << 3 | room << 8) for key, lost, short, off, room in signatures(name, counts, learnt, steps)}:
                    ids.append(i)
                    blocks.append(block)
                    uses.append(use)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blocks, pa.int64()), pa.array(uses, pa.int32())], ["id", "block", "use"])

    # Parted and sorted once, for all joins.
    held = cut(lines.mapInArrow(entries, "id bigint, block bigint, use int").repartition("block").sortWithinPartitions("block"))
    lost, short, room = (F.expr(f"shiftright(use, {k}) & {m}") for k, m in ((0, 1), (3, 31), (8, 255)))
    whole, less = held.where((lost == 0) & (short == 0)), held.where((lost == 1) | (short > 0))
    cut_off, abbreviated = held.where((lost == 1) & (short == 0)), held.where((lost == 0) & (short > 0))
    partly = held.where((short > 0) & (short < room))

    def met(x: DataFrame, y: DataFrame, ordered: bool = False) -> DataFrame:
        both = x.select("block", F.col("id").alias("a"), F.col("use").alias("u")).hint("merge").join(y.select("block", F.col("id").alias("b"), F.col("use").alias("v")), "block")
        both = both.where(("a < b" if ordered else "a <> b") + " and (u & 1) + (v & 1) <= 1 and (shiftright(u, 1) & 3) + (shiftright(v, 1) & 3) <= 3 and (shiftright(u, 3) & 31) + (shiftright(v, 3) & 31) <= shiftright(u, 8)")
        return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    pairs = met(whole, whole, True).unionByName(met(whole, less)).unionByName(met(cut_off, abbreviated)).unionByName(met(partly, partly, True))
    return pairs.distinct()


def described(forms: DataFrame, short_forms: DataFrame) -> DataFrame:
    """What is needed to meet and to score each form: ``id, line, ups``. ``forms`` has ``id, key, n``."""
    words = forms.select("id", "n", F.posexplode(F.filter(F.split(F.split("key", r"\|")[0], " "), lambda w: w != "")).alias("at", "word"))
    sized = cut(words.groupBy("word").agg(F.sum("n").alias("c")))
    steps = kindred(sized).groupBy("word").agg(F.concat("word", F.lit("="), F.array_join(F.collect_set(F.concat("up", F.lit(":"), F.col("d").cast("string"))), ",")).alias("ups"))
    known = sized.join(short_forms, "word", "left").join(steps, "word", "left")
    known = known.select("word", "c", "ups", F.when(F.col("full").isNotNull(), F.concat("word", F.lit("="), F.array_join("full", ","))).alias("short"))
    listed = words.join(known, "word").groupBy("id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "c"))), lambda x: x["c"].cast("string")), ",").alias("counts"), F.array_join(F.sort_array(F.collect_set("short")), ";").alias("short"), F.array_join(F.collect_set("ups"), ";").alias("ups"),
    )
    line = F.concat_ws("\t", "key", F.col("n").cast("string"), F.coalesce("counts", F.lit("")), F.coalesce("short", F.lit("")))
    return cut(forms.join(listed, "id", "left").select("id", line.alias("line"), "ups"))


def attribute(keyed: DataFrame, short_forms: DataFrame) -> DataFrame:
    """Attach each spelling to its canonical form: ``key, root``.

    ``keyed`` has one row per record with ``key``, ``short_forms`` is what
    :func:`learn_short_forms` gives. Spellings are counted
    first, so a name may hold any share of the rows. The pairs that may fit are
    scored once each; the best parent over all of them holds.
    """
    forms = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()))
    lines = described(forms, short_forms)

    @F.pandas_udf("first boolean, score double")
    def scored(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        found = [compare(x, y) or (None, None) for x, y in zip(a, b, strict=True)]
        return pd.DataFrame({"first": pd.Series([f for f, _ in found], dtype="boolean"), "score": pd.Series([s for _, s in found], dtype="float64")})

    met = candidates(lines).join(lines.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").join(lines.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    offers = met.select("a", "b", scored("line_a", "line_b").alias("s"), F.split_part("line_a", F.lit("\t"), F.lit(1)).alias("key_a"), F.split_part("line_b", F.lit("\t"), F.lit(1)).alias("key_b")).where("s.first is not null")
    offers = offers.select(
        F.when(F.col("s.first"), F.col("a")).otherwise(F.col("b")).alias("child"), F.col("s.score").alias("score"),
        F.when(F.col("s.first"), F.col("key_b")).otherwise(F.col("key_a")).alias("of"), F.when(F.col("s.first"), F.col("b")).otherwise(F.col("a")).alias("parent"),
    )
    parents = offers.groupBy("child").agg(F.max(F.struct("score", "of", "parent")).alias("b")).select("child", "b.parent")
    roots = _pointers(parents).join(forms.select(F.col("id").alias("parent"), F.col("key").alias("root")), "parent").select(F.col("child").alias("id"), "root")
    return forms.join(roots, "id", "left").select("key", F.coalesce("root", "key").alias("root"))


def akin(a: str, b: str) -> bool:
    """Weak kinship of two forms that hold one registration: a distinctive word in common, the same ending."""
    x, y = from_key(a), from_key(b)
    if x.ending != y.ending:
        return False
    return any(len(w) >= 5 and (w in y.words or any(edits(w, v, 1) <= 1 for v in y.words if len(v) >= 5)) for w in x.words)


def _join_by(rows: DataFrame, mark: str) -> DataFrame:
    """Pointers between forms that share a mark and are akin: ``child, parent``."""
    sizes = rows.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    per = rows.where(F.col(mark).isNotNull()).groupBy(mark, "root").agg(F.count(F.lit(1)).alias("here")).join(sizes, "root")
    heads = per.groupBy(mark).agg(F.max(F.struct("here", "size", "root")).alias("h"), F.count(F.lit(1)).alias("k")).where("k > 1")
    both = per.join(heads.select(mark, "h"), mark).where(F.col("root") != F.col("h.root"))

    @F.pandas_udf("boolean")
    def related(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([akin(x, y) for x, y in zip(a, b, strict=True)], dtype="bool")

    edges = both.where(related("root", F.col("h.root"))).select(F.struct("size", "root").alias("a"), F.struct(F.col("h.size").alias("size"), F.col("h.root").alias("root")).alias("b"))
    up = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    return up.groupBy(F.col("low.root").alias("child")).agg(F.max("high").alias("m")).select("child", F.col("m.root").alias("parent"))


def entities(df: DataFrame, row_id: str, name: str, oab: str, document: str) -> DataFrame:
    """The entity of each named row: ``id, entity``.

    Rows are joined by the channel, then by tax number, then by registration
    where the names are akin. A registration with one digit typed wrong is
    the other one of its state; two different registrations in one state are
    two persons, in every state that has them, and rows of the name without
    one of them go with the more frequent. Nulls in any column, equal rows and extra columns are allowed;
    an empty table gives an empty result.
    """
    keyed = cut(spellings(df, row_id, name))
    marks = df.select(
        F.col(row_id).alias("id"), registration(F.col(oab)).alias("reg"),
        F.nullif(F.regexp_replace(F.col(document), "[^0-9]", ""), F.lit("")).alias("tax"),
    )
    forms = attribute(keyed, learn_short_forms(keyed, marks.dropDuplicates(["id"])))
    rows = cut(keyed.join(forms, "key").join(marks.dropDuplicates(["id"]), "id").select("id", "root", "reg", "tax"))
    for mark in ("tax", "reg"):
        up = _pointers(_join_by(rows, mark))
        rows = cut(rows.join(up, rows["root"] == up["child"], "left").select("id", F.coalesce("parent", "root").alias("root"), "reg", "tax"))
    held = rows.where("reg is not null").groupBy("root", F.col("reg.state").alias("state"), F.col("reg.num").alias("num")).agg(F.count(F.lit(1)).alias("n"))
    nums = held.groupBy("root", "state").agg(F.collect_list(F.struct("n", "num")).alias("nums"), F.count(F.lit(1)).alias("k")).where("k > 1")

    @F.pandas_udf("map<string,string>")
    def persons(lists: pd.Series) -> pd.Series:
        """Number -> the number it is one typo from, among those of a state; "" -> the most frequent one."""

        def one(nums) -> dict[str, str]:
            out: dict[str, str] = {}
            heads: list[str] = []
            for x in sorted(nums, key=lambda x: (-x["n"], x["num"])):
                head = next((h for h in heads if edits(x["num"], h, 1) <= 1), None)
                if head is None:
                    heads.append(x["num"])
                    head = x["num"]
                out[x["num"]] = head
            out[""] = heads[0]
            return out

        return lists.map(one)

    # A root is parted by each of its states in which there are several numbers. A row holds one registration at most, so in a
    # state it says nothing about it goes with the more frequent person; rows apart in any state are persons apart.
    split = nums.select("root", "state", persons("nums").alias("of")).where(F.size(F.array_distinct(F.map_values("of"))) > 1)
    split = split.groupBy("root").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("state", F.to_json("of").alias("of"))))).alias("states"))
    number = lambda state, of: F.coalesce(
        F.try_element_at(F.from_json(of, "map<string,string>"), F.when(F.col("reg.state") == state, F.col("reg.num")).otherwise(F.lit(""))), F.lit("")
    )
    person = F.array_join(F.map_values(F.transform_values("states", number)), "/")
    return rows.join(split, "root", "left").select("id", F.concat_ws("#", "root", F.coalesce(person, F.lit(""))).alias("entity"))


def same_entity_pairs(found: DataFrame) -> DataFrame:
    """Each pair a < b of rows of one entity; entities of one row drop out before the join."""
    several = found.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("entity")
    rows = found.join(several, "entity", "left_semi")
    return rows.select("entity", F.col("id").alias("a")).join(rows.select("entity", F.col("id").alias("b")), "entity").where("a < b").select("a", "b")
