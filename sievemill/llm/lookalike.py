"""Visually identical text with different characters.

Width, accents, blanks, hyphens and invisible characters are folded by rules
over the Unicode tables. Look-alike letters are repaired token by token: the
dominant script of a token is that of the letters no other script can show,
else Latin; letters of other scripts are replaced by their look-alikes of that
script if the result occurs in the vocabulary of the corpus. Texts look the
same if and only if their repaired forms are equal.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.session import cut

#: Letters of other scripts and the Latin letters they look like. Fixed values.
LOOKALIKES = dict(
    zip(
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυϲϳ" "АВЕЅІЈКМНОРСТУХҮԚԜаеорсухѕіјһԁԛԝӏү" "ՕօսհոցԼ",
        "ABEZHIKMNOPTYXaikvopucj" "ABESIJKMHOPCTYXYQWaeopcyxsijhdqwly" "OouhnqL",
        strict=True,
    )
)
#: Hyphens that look like hyphen-minus. Fixed values.
HYPHENS = "‐‑᠆﹣－"
#: Invisible characters that aren't of the format category. Fixed values.
INVISIBLE = "\u034Fᅟᅠ\u17B4\u17B5ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
#: Texts without any of these characters are in their canonical form already:
#: anything but ASCII, composed Latin-1 letters and a few signs.
UNUSUAL = r"[^\n\x20-\x7E\xA1-\xAC\xAE-\xFF–—‘’“”]"
_UNUSUAL = re.compile(UNUSUAL)
_TOKEN = re.compile(r"[^\W\d_]+(?:[\u0300-\u036F]+[^\W\d_]*)*")
#: Tokens of texts without combining marks.
_PLAIN_TOKEN = re.compile(r"[^\W\d_]+")
#: Words a task gathers before it hands them on.
_MOST_WORDS = 500_000


@lru_cache(maxsize=200_000)
def _fold_char(c: str) -> str:
    """One character without what can't be seen; look-alikes stay."""
    if c in "\n\t\r" or c in ("\x85", "\u2028", "\u2029"):
        return " " if c == "\t" else "\n"
    if c in HYPHENS:
        return "-"
    kind = unicodedata.category(c)
    if kind in ("Cf", "Cc") or c in INVISIBLE:
        return ""
    if kind == "Zs":
        return " "
    parts = unicodedata.decomposition(c)
    if parts.startswith(("<wide>", "<narrow>", "<font>")):
        return "".join(_fold_char(chr(int(x, 16))) for x in parts.split()[1:])
    return c


def plain_fold(text: str) -> str:
    """Fold width, blanks, hyphens, line ends and invisible characters; compose accents."""
    return unicodedata.normalize("NFC", "".join(map(_fold_char, text.replace("\r\n", "\n"))))


def latin(token: str) -> str:
    """The token with every look-alike replaced, accents composed."""
    parts = unicodedata.normalize("NFD", token)
    return unicodedata.normalize("NFC", "".join(LOOKALIKES.get(c, c) for c in parts))


@lru_cache(maxsize=100_000)
def script(c: str) -> str:
    """The first word of a letter's Unicode name: LATIN, GREEK, CYRILLIC and so on."""
    return unicodedata.name(c, "").split(" ")[0]


#: The scripts that have look-alikes, each with its letters by the Latin letter they look like.
_SCRIPTS: dict[str, dict[str, str]] = {}
for _c, _like in LOOKALIKES.items():
    _SCRIPTS.setdefault(unicodedata.name(_c).split(" ")[0], {}).setdefault(_like, _c)


@lru_cache(maxsize=100_000)
def repaired(token: str) -> str | None:
    """The token in its dominant script, null where nothing can be replaced.

    Letters that no other script can show decide; they must be of one script.
    Without any, the token can be read as Latin, the script of the corpus.
    """
    letters = [c for c in unicodedata.normalize("NFD", token) if c.isalpha()]
    foreign = [c for c in letters if script(c) in _SCRIPTS]
    if not foreign:
        return None
    own = {script(c) for c in foreign if c not in LOOKALIKES}
    if not own:
        return latin(token)
    if len(own) > 1:
        return None
    dominant = next(iter(own))
    like = _SCRIPTS[dominant]
    movable = lambda c: c in LOOKALIKES or c.isalpha() and script(c) == "LATIN"
    if any(movable(c) and script(c) != dominant and LOOKALIKES.get(c, c) not in like for c in letters):
        return None
    parts = unicodedata.normalize("NFD", token)
    new = unicodedata.normalize("NFC", "".join(like.get(LOOKALIKES.get(c, c), c) if movable(c) else c for c in parts))
    return new if new != token else None


def repair(folded: str, known: set[str]) -> str:
    """Replace the tokens whose form in their dominant script is known."""

    def one(m: re.Match[str]) -> str:
        token = m.group()
        new = None if token.isascii() else repaired(token)
        return token if new is None or new not in known else new

    return _TOKEN.sub(one, folded)


def _digest(text: str) -> str:
    """The same as Spark's md5 of the text."""
    return hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()


def _reader(keep: int, schema: pa.Schema):
    """A mapInArrow function over (keep columns, text): a row per text, and rows of the words of a task.

    Rows of texts: ``t`` (digest), ``lettered``, and for texts with an unusual
    character ``folded`` and ``forms``, the tokens that can be repaired with
    their repaired forms. Rows of words have ``word`` only, each word once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[str] = set()

        def of_words() -> Iterator[pa.RecordBatch]:
            listed = list(words)
            words.clear()
            for lo in range(0, len(listed), 50_000):
                part = listed[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(part), f.type) for f in list(schema)[:-1]] + [pa.array(part, type=pa.string()).cast(schema[-1].type)], schema=schema)

        for batch in batches:
            at, digests, lettered, folds, forms = [], [], [], [], []
            for i, text in enumerate(batch.column(keep).to_pylist()):
                if text is None:
                    continue
                odd = _UNUSUAL.search(text) is not None
                folded = plain_fold(text) if odd else text
                tokens = set((_TOKEN if odd else _PLAIN_TOKEN).findall(folded))
                lettered.append(any(any(map(str.isalpha, t)) for t in tokens))
                changed = [(t, new) for t in tokens if not t.isascii() and (new := repaired(t)) is not None] if odd else []
                tokens.difference_update(t for t, _ in changed)
                words |= tokens
                at.append(i)
                digests.append(_digest(text))
                folds.append(folded if odd else None)
                forms.append([{"token": t, "form": new} for t, new in sorted(changed)] if odd else None)
            taken = pa.array(at, type=pa.int64())
            values = [batch.column(k).take(taken) for k in range(keep)]
            values += [pa.array(v, type=f.type) for v, f in zip((digests, lettered, folds, forms), list(schema)[keep:-1], strict=True)]
            yield pa.RecordBatch.from_arrays([*(v.cast(f.type) for v, f in zip(values, schema, strict=False)), pa.nulls(len(at), schema[-1].type)], schema=schema)
            if len(words) > _MOST_WORDS:
                yield from of_words()
        yield from of_words()

    return run


def _read(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One pass over all texts; see :func:`_reader`. Texts without an unusual character leave it as a digest only."""
    from pyspark.sql.pandas.types import to_arrow_schema

    given = docs.select(*keep, text)
    made = T._parse_datatype_string("t string, lettered boolean, folded string, forms array<struct<token:string,form:string>>, word string")
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in given.schema.fields[: len(keep)]), *made.fields])
    return cut(given.mapInArrow(_reader(len(keep), to_arrow_schema(schema)), schema))


def _canonical(read: DataFrame) -> DataFrame:
    """The canonical form of each distinct text with an unusual character: ``t, canonical``.

    A repaired form is in the vocabulary if it occurs as a word of any text,
    or if tokens of several spellings lead to it.
    """
    odd = read.where("folded is not null").groupBy("t").agg(F.any_value("folded").alias("folded"), F.any_value("forms").alias("forms"))
    tokens = odd.select("t", F.explode("forms").alias("f")).select("t", "f.token", "f.form")
    spelt = tokens.groupBy("form").agg(F.min("token").alias("a"), F.max("token").alias("b"))
    vocabulary = read.where("word is not null").select(F.col("word").alias("form")).distinct().withColumn("here", F.lit(True))
    known = spelt.join(vocabulary, "form", "left").where("here or a <> b").select("form")
    of_text = tokens.select("t", "form").join(known, "form").groupBy("t").agg(F.collect_set("form").alias("known"))

    @F.pandas_udf("string")
    def mend(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for folded, words_known in batches:
            yield pd.Series([t if k is None or not len(k) else repair(t, set(k)) for t, k in zip(folded, words_known, strict=True)], dtype="object")

    return odd.select("t", "folded").join(of_text, "t", "left").select("t", mend("folded", "known").alias("canonical"))


def canonical_texts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Each text in one consistent form: ``keep``, the text, ``canonical``.

    Null texts are left out, empty ones stay empty. Texts without an unusual
    character are in that form. In the others, tokens are brought to their
    dominant script where the result is in the vocabulary of all texts;
    tokens whose repaired form occurs nowhere stay as they are, as do words of
    other scripts. Copies are repaired once, repeated rows come out each.
    """
    docs = docs.select(*keep, text).where(F.col(text).isNotNull())
    unusual = F.col(text).rlike(UNUSUAL)
    mended = docs.where(unusual).withColumn("__t", F.md5(F.col(text).cast("binary"))).join(_canonical(_read(docs, text, [])).withColumnRenamed("t", "__t"), "__t")
    return docs.where(~unusual).select(*keep, text, F.col(text).alias("canonical")).unionByName(mended.select(*keep, text, "canonical"))


def same_look_pairs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Each pair a < b of documents that look the same and differ in their text.

    Two texts look the same if their canonical forms are equal. Texts without
    a letter are left out. Classes are first reduced to their distinct texts,
    and only classes with several of them are expanded, so exact copies meet
    nobody but the variants of their text.
    """
    read = _read(docs.withColumn("doc", F.col(doc_id)), text, ["doc"])
    rows = read.where("lettered").select("doc", "t", F.col("folded").isNull().alias("clean"))
    forms = cut(_canonical(read).select("t", F.md5(F.col("canonical").cast("binary")).alias("k")))
    keyed = rows.where("clean").select("doc", "t", F.col("t").alias("k")).unionByName(rows.where("not clean").select("doc", "t").join(forms, "t"))
    several = keyed.select("k", "t").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    members = cut(keyed.join(several, "k", "left_semi"))
    variants = members.select("k", "t").distinct()
    pairs = variants.withColumnRenamed("t", "t1").join(variants.withColumnRenamed("t", "t2"), "k").where("t1 < t2")
    left = members.select(F.col("t").alias("t1"), F.col("doc").alias("d1"))
    right = members.select(F.col("t").alias("t2"), F.col("doc").alias("d2"))
    both = pairs.join(left, "t1").join(right, "t2").where("d1 <> d2")
    return both.select(F.least("d1", "d2").alias("doc_id_a"), F.greatest("d1", "d2").alias("doc_id_b")).distinct()
