"""Garbled text from wrong character encoding.

A best-first search over encode, decode, unescape and case operations, with
visited states kept by hash, looks for the most plausible text that can be
reached from a value. Plausibility is a cost in bits per character that isn't
ASCII, from trigram counts over all values of the corpus: genuine text is far
more frequent than any kind of damage.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.session import cut

#: A value without any of these can't be told from genuine text: characters
#: that aren't ASCII, question marks, entities and escapes.
SUSPECT = r"[^\x00-\x7F]|\?|&#?\w+;|%[0-9A-Fa-f]{2}|\\[ux][0-9A-Fa-f]{2}"
_TRIGRAM = r"(?s)(?=(.?[^\x00-\x7F].?))"
ESCAPES = r"&#?\w+;|%[0-9A-Fa-f]{2}|\\[ux][0-9A-Fa-f]{2}"
#: A text must be cheaper by this many bits.
MARGIN = 4.5
#: A value isn't searched if each of its trigrams surely (by three deviations of its count) has a share of one in COMMON.
COMMON = 6000
_GRAMS = re.compile(r"(?s)(?=(.?[^\x00-\x7F].?))")
#: Beside Latin letters, ordinals and common signs: never skipped.
_FOREIGN = re.compile("[^\x00-\x7f\xa0\xa7\xaa\xb0\xba\xc0-\xd6\xd8-\xf6\xf8-\xff\u2013\u2014\u2018\u2019\u201c\u201d]")
_CASE_MIX = re.compile("[a-z][\xc0-\xd6\xd8-\xde]|[A-Z][\xdf-\xf6\xf8-\xfe][A-Z]")
#: Trigrams of a lesser share count as unseen, at every size of the corpus; at most 1 / LEAST_SHARE are kept.
LEAST_SHARE = 1e-5
_CODECS = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman")
#: Encoded as the first and wrongly decoded as the second; undone in reverse.
_SWAPS = [("cp850", "cp1252"), ("cp1252", "cp850"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp1252", "cp437")]
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_BLANK = re.compile("[\xa0\u2000-\u200B\u202F\u3000\uFEFF]")
_LOST = re.compile(r"�|(?<=\w)\?(?=\w)|(?<!\w)\?(?=[^\W\d_])|\?(?=\?+\w)|(?<=\d)\?(?=\s\w)|(?<=\w)\?\?|[\x80-\x9f]|[─-╿]")
_SCHEMA = T.StructType([
    T.StructField("damaged", T.BooleanType()), T.StructField("fixed", T.StringType()), T.StructField("whole", T.BooleanType()),
    T.StructField("steps", T.StringType()),
])


_HOLLOW = re.compile("[\x80-\x9f\xad]")


def _byte_tables() -> dict[str, tuple[dict[str, str], dict[str, str]]]:
    """Per codec: character -> byte as Latin-1 character, and back. Bytes a codec leaves open stand for themselves."""
    out = {}
    for codec in _CODECS:
        to_byte, to_char = {}, {}
        for b in range(128, 256):
            try:
                c = bytes([b]).decode(codec)
            except UnicodeDecodeError:
                c = chr(b)
            to_byte[c], to_char[chr(b)] = chr(b), c
        out[codec] = (to_byte, to_char)
    return out


_TABLES = _byte_tables()


def _as_utf8(text: str, codec: str) -> str:
    """Read the stretches that are UTF-8 under ``codec`` as UTF-8; the rest stays."""
    to_byte = _TABLES[codec][0]
    mapped = "".join(c if c < "\x80" else to_byte.get(c, "\uF8FF") for c in text)
    if not _UTF8.search(mapped):
        return text
    out, at = [], 0
    for m in _UTF8.finditer(mapped):
        try:
            good = m.group().encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        out += [text[at : m.start()], good]
        at = m.end()
    return "".join(out) + text[at:]


def _swap(text: str, right: str, wrong: str) -> str:
    """Undo: bytes of codec ``right`` were decoded as ``wrong``."""
    to_byte, to_char = _TABLES[wrong][0], _TABLES[right][1]
    new = "".join(c if c < "\x80" else to_char.get(to_byte.get(c, ""), c) for c in text)
    # Letters don't come from blanks or controls; a step that makes some is wrong.
    return text if _HOLLOW.search(new) and not _HOLLOW.search(text) else new


def _unpercent(text: str) -> str:
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1), 16)), text)


def _unbackslash(text: str) -> str:
    return re.sub(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1) or m.group(2), 16)), text)


_LEAD = re.compile("[\xe0-\xf4](?=[^A-Za-z\\s\\d])")
_SPLIT_LEAD = re.compile("(?<=[\xc3\xe3]) (?=\\S)")


def _recase_lead(text: str) -> str:
    return _LEAD.sub(lambda m: m.group().upper(), text)


def _recase_all(text: str) -> str:
    return "".join(c if c < "\x80" or len(c.upper()) > 1 or c.upper() < "\x80" else c.upper() for c in text)


def _lower_all(text: str) -> str:
    text = text.replace("\u039c", "\xb5")  # the capital of the micro sign
    return "".join(c if c < "\x80" or c in "\xc3\xc2\xc5" or len(c.lower()) > 1 or c.lower() < "\x80" else c.lower() for c in text)


def _smooth_case(text: str) -> str:
    """Give letters beyond ASCII the case of the word around them."""

    def one(m: re.Match[str]) -> str:
        word = m.group()
        ascii_letters = [c for c in word if c.isascii() and c.isalpha()]
        if len(ascii_letters) < 2 or word[:1].isupper() and all(c.islower() for c in ascii_letters[1:]) and ascii_letters[0].isupper():
            return word[:1] + "".join(c if c.isascii() else c.lower() for c in word[1:])
        if all(c.isupper() for c in ascii_letters):
            return "".join(c if c.isascii() or len(c.upper()) > 1 else c.upper() for c in word)
        if all(c.islower() for c in ascii_letters):
            return word[:1] + "".join(c if c.isascii() else c.lower() for c in word[1:]) if word[0].isascii() else "".join(c if c.isascii() else c.lower() for c in word)
        return word

    return re.sub(r"[^\W\d_]+", one, text)


def _operations() -> list[tuple[str, float, object]]:
    ops: list[tuple[str, float, object]] = [(f"utf8<{c}", 2.0, (lambda t, c=c: _as_utf8(t, c))) for c in _CODECS]
    ops += [(f"{a}<{b}", 2.5, (lambda t, a=a, b=b: _swap(t, a, b))) for a, b in _SWAPS]
    ops += [("entities", 1.0, html.unescape), ("percent", 2.0, _unpercent), ("backslash", 1.0, _unbackslash)]
    ops += [("lead case", 3.0, _recase_lead), ("upper case", 3.0, _recase_all), ("lower case", 3.0, _lower_all), ("lead blank", 3.0, lambda t: _SPLIT_LEAD.sub("\xa0", t))]
    return ops


_OPS = _operations()


class Plausibility:
    """Costs in bits, from trigram counts and the total of all trigrams."""

    def __init__(self, counts: dict[str, int], total: int, finals: frozenset[str] = frozenset()) -> None:
        self.total = max(total, 1)
        self.counts = counts
        self.finals = finals
        chars: dict[str, int] = {}
        for gram, n in counts.items():
            middle = gram[1] if len(gram) == 3 else next(c for c in gram if c > "\x7f")
            chars[middle] = chars.get(middle, 0) + n
        self.chars = chars
        self.cost = lru_cache(maxsize=50_000)(self._cost)
        self.common = frozenset(g for g, n in counts.items() if (n - 3 * math.sqrt(n)) * COMMON >= self.total)

    def all_common(self, text: str) -> bool:
        """True if each trigram is so frequent that the text needs no search."""
        low = text.lower()
        if len(low) != len(text) or _CASE_MIX.search(text) or _FOREIGN.search(text):
            return False
        return all(g in self.common for g in _GRAMS.findall(low)) and not re.search(ESCAPES, text)

    def _cost(self, text: str) -> float:
        """Sum of the costs of the characters that aren't ASCII, and of escapes."""
        bits = 0.0
        low = text.lower() if len(text.lower()) == len(text) else text
        for i, c in enumerate(low):
            if c < "\x80":
                continue
            if _BLANK.match(c):
                bits += 1.0
                continue
            known = self.chars.get(c, 0)
            gram = low[max(0, i - 1) : i + 2]
            n = self.counts.get(gram, 0)
            if n:
                # Without the value itself: what occurs once has no support.
                bits += math.log2(self.total / max(n - 1, 0.2))
            elif known:
                bits += math.log2(self.total / known) + 10
            else:
                bits += math.log2(self.total) + 20
            if c == "\ufffd" or "\x80" <= c <= "\x9f" or "\u2500" <= c <= "\u257f":
                bits += 20
            left, right = text[i - 1 : i], text[i + 1 : i + 2]
            if left.isalpha() and right.isalpha():
                if not c.isalpha():
                    bits += 12  # a sign within a word
                elif left.isascii() and (left.islower() and text[i].isupper() or left.isupper() and text[i].islower() and right.isascii() and right.isupper()):
                    bits += 8  # a letter of the other case within a word
        if "&" in text or "%" in text or "\\" in text:
            bits += 12 * len(re.findall(r"&#?\w+;|%[0-9A-Fa-f]{2}|\\[ux][0-9A-Fa-f]{2}", text))
        return bits


def search(text: str, model: Plausibility, max_depth: int = 4, slack: float = 16.0) -> tuple[str, float, str]:
    """The cheapest text that can be reached: text, cost, operations.

    The cost is that of the text plus that of the operations. States are
    expanded in the order of their cost; a state once visited isn't visited
    again. The number of states is finite: a path has at most ``max_depth``
    operations, and those dearer than the best text by ``slack`` bits end.
    """
    start = model.cost(text)
    best = (start, text, "")
    heap: list[tuple[float, int, str, float, tuple[str, ...]]] = [(start, 0, text, 0.0, ())]
    seen = {hash(text)}
    order = 0
    while heap:
        total, _, at, spent, path = heapq.heappop(heap)
        if total > best[0] + slack or len(path) >= max_depth:
            continue
        for name, price, op in _OPS:
            new = op(at)
            key = hash(new)
            if key in seen:
                continue
            seen.add(key)
            cost = spent + price
            # A blank that wasn't there before is dear: letters don't come from blanks.
            blanks = new.count("\xa0") - text.count("\xa0")
            all_in = model.cost(new) + cost + (16 * blanks if blanks > 0 else 0)
            order += 1
            if all_in < best[0]:
                best = (all_in, new, " ".join((*path, name)))
            heapq.heappush(heap, (all_in, order, new, cost, (*path, name)))
    return best[1], best[0], best[2]


def judge(text: str | None, model: Plausibility, margin: float = MARGIN) -> tuple[bool, str | None, bool, str]:
    """Whether a value is damaged, its best text, whether that is whole, how.

    Damaged are values with a text cheaper by more than ``margin`` bits, and
    values that hold signs of lost characters: U+FFFD, control characters of
    the upper range, box drawing, a question mark within a word or in the
    place of a word's last letter. Null is sound. A value that can't be
    restored keeps the best text found and isn't whole.
    """
    if text is None or (text.isascii() and not re.search(SUSPECT, text)):
        return False, text, True, ""
    lost = bool(_LOST.search(text)) or any(_final_lost(m, model) for m in re.finditer(r"(\w+)\?(?!\w)", text))
    if not lost and model.all_common(text):
        return False, text, True, ""
    start = model.cost(text)
    fixed, cost, steps = search(text, model)
    if fixed != text and cost > 25.0:
        # Better, but still odd: look farther, past dearer texts on the way.
        fixed, cost, steps = search(text, model, slack=40.0)
    if "case" in steps:
        fixed = _smooth_case(fixed)
    damaged = fixed != text and start - cost > margin
    if not damaged:
        fixed, steps = text, ""
    if not damaged and not lost:
        return False, text, True, ""
    whole = not _LOST.search(fixed) and damaged
    return True, fixed, whole, steps


def _final_lost(m: re.Match[str], model: Plausibility) -> bool:
    """A word whose last letter became a question mark: the corpus has the word with a last letter that isn't ASCII."""
    return m.group(1).lower() in model.finals


def learn(values: DataFrame, value: str) -> Plausibility:
    """Trigram counts and words that end in a letter beyond ASCII, over all values.

    Each counts once per value, so no long value makes its own rule. Counted
    in the cluster; only entries with a share of LEAST_SHARE come to
    the driver, at most 1 / LEAST_SHARE of each kind. An empty input gives an
    empty model, under which nothing but lost characters is damaged.
    """
    low = F.lower(F.col(value))
    grams = F.transform(F.regexp_extract_all(low, F.lit(_TRIGRAM), F.lit(1)), lambda g: F.concat(F.lit("g"), g))
    finals = F.transform(F.regexp_extract_all(low, F.lit(r"(?<![\p{L}])([a-z]{1,30})[ªºÀ-ſ](?![\p{L}])"), F.lit(1)), lambda w: F.concat(F.lit("w"), w))
    counted = values.where(F.col(value).rlike(r"[^\x00-\x7F]")).select(F.explode(F.array_distinct(F.concat(grams, finals))).alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    counted = cut(counted)
    total = counted.agg(F.sum(F.when(F.col("e").startswith("g"), F.col("n")).otherwise(0)).alias("t")).first()["t"] or 0
    kept = counted.where(F.col("n") >= max(1, math.ceil(total * LEAST_SHARE))).collect()
    counts = {r["e"][1:]: r["n"] for r in kept if r["e"][0] == "g"}
    # A final must be as frequent as words are, or chance damage would make its own rule.
    words = frozenset(r["e"][1:] for r in kept if r["e"][0] == "w" and r["n"] >= max(3, total * LEAST_SHARE))
    return Plausibility(counts, total, words)


def judge_column(spark, value: Column, model: Plausibility, margin: float = MARGIN) -> Column:
    """:func:`judge` as a Column of struct(damaged, fixed, whole, steps)."""
    shared = spark.sparkContext.broadcast((model.counts, model.total, model.finals))

    @F.pandas_udf(_SCHEMA)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Plausibility(*shared.value)
        once = lru_cache(maxsize=100_000)(lambda t: judge(t, own, margin))
        for batch in batches:
            yield pd.DataFrame([once(t) for t in batch], columns=["damaged", "fixed", "whole", "steps"])

    return judged(value)


def find_damaged(values: DataFrame, value: str, keep: list[str], margin: float = MARGIN) -> DataFrame:
    """The damaged values: ``keep``, the value, ``fixed``, ``whole``, ``steps``.

    The model is learnt from all values. Values without a suspect character
    are settled in the JVM; null and blank values are sound. Repeated rows
    are reported each; very long texts are searched whole.
    """
    model = learn(values, value)
    suspects = values.where(F.col(value).rlike(SUSPECT)).select(*keep, value)
    judged = suspects.withColumn("j", judge_column(values.sparkSession, F.col(value), model, margin))
    return judged.where("j.damaged").select(*keep, value, "j.fixed", "j.whole", "j.steps")
