"""Several values packed in one field.

The delimiters of each source are inferred from the data. Every candidate is
scored over all rows of the source: by piece type regularity (the share of
pieces that look like whole values) and by piece-count consistency (listings
of one record must agree on their number of values, whatever delimiters each
of them uses). Fields are then split, quotes respected, and exploded with
their position. Everything runs as JVM expressions.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions.text import BLANKS, strip_blanks
from sievemill.session import cut

#: Blanks other than tab and line ends, folded to a plain one in marked text.
_WIDE_BLANKS = "".join(map(chr, [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]))
#: What may stand beside a delimiter that is a word or a solidus: blanks, other delimiters, marks, the ends.
_BESIDE = rf"{BLANKS};|,\uE000-\uE0FF"


def _apart(sign: str) -> str:
    """A pattern of a sign that stands apart. The sign is matched first, so that most places fail at once."""
    return rf"(?:{sign})(?<![^{_BESIDE}](?:{sign}))(?![^{_BESIDE}])"


#: Candidate delimiters: name and Java pattern, in the order in which they are
#: marked (the longer form of a sign before the bare one).
CANDIDATES = {
    "semicolon": ";",
    "bar": r"\|",
    "newline": r"[\r\n]",
    "tab": r"\t",
    "comma": ",",
    "spaced_solidus": _apart("/"),
    "bare_solidus": "/",
    "spaced_hyphen": rf"-(?<=[{BLANKS}]-)(?=[{BLANKS}])",
    "side_vs": _apart(r"[Vv][Ss]|[Vv][Ee][Rr][Ss][Uu][Ss]|[Vv][Ss]\."),
    "side_x_dot": _apart(r"[Xx]\."),
    "side_x": _apart("[Xx×]"),
    "full_stop": r"\.",
    "ampersand": rf"&(?<=[{BLANKS}]&)(?=[{BLANKS}])",
    "word_e": rf"[Ee](?<=[{BLANKS}][Ee])(?=[{BLANKS}])",
}
#: The characters with which each candidate can begin: runs of others are passed in one step.
_FIRST = {
    "semicolon": ";", "bar": "|", "newline": "\r\n", "tab": "\t", "comma": ",", "spaced_solidus": "/", "bare_solidus": "/", "spaced_hyphen": "-",
    "side_vs": "Vv", "side_x_dot": "Xx", "side_x": "Xx×", "full_stop": ".", "ampersand": "&", "word_e": "Ee",
}


def _cases(word: str) -> list[str]:
    """A word in all mixtures of case."""
    return ["".join(x) for x in itertools.product(*((c.upper(), c) for c in word))]


#: What a text of plain blanks holds if it holds the candidate: texts without any of these are passed over.
_HOLDS = {
    "spaced_solidus": ["/"], "bare_solidus": ["/"], "spaced_hyphen": [" - "], "side_vs": _cases("vs") + _cases("sus"), "side_x_dot": ["X.", "x."],
    "side_x": ["X", "x", "×"], "full_stop": ["."], "ampersand": [" & "], "word_e": [" E ", " e "],
}
#: Candidates of one character each are marked in one pass.
_SINGLE_SIGNS = {"semicolon": ";", "bar": "|", "newline": "\r\n", "tab": "\t", "comma": ","}
_MARK = {name: chr(0xE000 + k) for k, name in enumerate(CANDIDATES)}
_ALL_MARKS = "".join(_MARK.values())
_MARK_CLASS = r"[\uE000-\uE0FF]"

_SHARED_SOURCES = 100_000

#: A quoted span. Double quotes may open anywhere but inside a word; single
#: quotes only where a piece can begin, since they are apostrophes too.
_DOUBLE = r'"(?<![\p{L}\p{N}"]")(?:[^"]++|"")*+"(?![\p{L}\p{N}])'
_SINGLE = rf"'(?<![^{_BESIDE}/]')(?:[^']++|''|'(?=\p{{L}}))*+'(?![^{_BESIDE}/])"
_QUOTED = f"{_DOUBLE}|{_SINGLE}"
#: A piece that can be a whole value: at least two words, the first of letters.
_REGULAR = r"\p{L}[^ \uE000-\uE0FF]*+ ++[^ \uE000-\uE0FF]"


def _quotes(field: Column) -> Column:
    return F.contains(field, F.lit('"')) | F.contains(field, F.lit("'"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _mark(text: Column, names: list[str]) -> Column:
    """A text of plain blanks with each of the named delimiters replaced by its mark."""
    signs = {c: _MARK[n] for n, cs in _SINGLE_SIGNS.items() if n in names for c in cs}
    text = F.translate(text, "".join(signs) + _WIDE_BLANKS, "".join(signs.values()) + " " * len(_WIDE_BLANKS))
    for name in CANDIDATES:
        if name in names and name not in _SINGLE_SIGNS:
            text = _let(text, _marker([name], _MARK[name]))
    return text


def _marker(names: list[str], mark: str):
    pattern = "|".join(CANDIDATES[n] for n in names)
    return lambda t: F.when(_holds(t, names), F.regexp_replace(t, pattern, mark)).otherwise(t)


def _holds(text: Column, names: list[str]) -> Column:
    """Whether a text can hold one of the candidates."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in dict.fromkeys(c for n in names for c in _HOLDS[n])])


def _value_count(signature: Column, marks: Column) -> Column:
    """Values of a signature when only the delimiters ``marks`` part them."""
    off = F.call_function("translate", F.lit(_ALL_MARKS), marks, F.lit(""))
    bare = F.regexp_replace(F.call_function("translate", signature, off, F.lit("")), _MARK_CLASS, " ")
    return F.size(F.filter(F.split(bare, " "), lambda x: x != ""))


def infer_delimiters(
    df: DataFrame, field: str, source: Column | None = None, group: str | None = None, least_score: float = 0.85, prior_rows: int = 0
) -> DataFrame:
    """The accepted delimiters of each source with their scores.

    One row per source and candidate that occurs: ``source_key, candidate,
    n_rows, regularity, whole_rows, agree_with, agree_without, accepted``.
    ``regularity`` is the share of regular pieces, ``whole_rows`` the share of
    rows in which all pieces are regular. With ``group``, a key under which
    the field is listed again and again, ``agree_with`` and ``agree_without``
    are the shares of keys whose listings all have one value count when the
    candidate is or isn't among the delimiters. A candidate is accepted if
    the mean of regularity and whole_rows reaches ``least_score`` and leaving
    it out doesn't make more keys agree.

    A source with few rows says little: its four shares are means of its own
    and of those of all sources, the latter with the weight of ``prior_rows``
    rows (or keys). With 0 each source stands for itself.

    Null and blank fields are left out, an empty input gives no rows. Counts
    are pre-aggregated per key and signature (the order of delimiters in a
    field), so one key may hold any share of the rows.
    """
    rows = df.select(
        (F.lit("all") if source is None else source).cast("string").alias("source_key"),
        (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("group_key"),
        F.col(field).alias("packed_text"),
    ).where(F.col("packed_text").rlike(f"[^{BLANKS}]"))
    masked = F.when(_quotes(F.col("packed_text")), F.regexp_replace("packed_text", _QUOTED, "Q Q")).otherwise(F.col("packed_text"))
    rows = rows.select("source_key", "group_key", _mark(masked, list(CANDIDATES)).alias("marked"))
    # From the first to the last letter between two marks is one value; what then stands between values and marks is dropped.
    sig = F.regexp_replace(F.regexp_replace("marked", r"[\p{L}\p{N}](?:[^\uE000-\uE0FF]*[\p{L}\p{N}])?", "w"), r"[^w\uE000-\uE0FF]++", "")
    stats = []
    for name, mark in _MARK.items():
        pieces = F.split("marked", mark, -1)
        named = F.filter(pieces, lambda p: p.rlike(r"[\p{L}\p{N}]"))
        regular = F.filter(named, lambda p: p.rlike(_REGULAR))
        found = F.when(F.contains("marked", F.lit(mark)), F.struct(F.size(named).alias("k"), F.size(regular).alias("r")))
        stats.append(found.alias(name))
    keyed = rows.select("source_key", "group_key", sig.alias("signature"), *stats)
    keyed = keyed.groupBy("source_key", "group_key", "signature").agg(
        F.count(F.lit(1)).alias("n"),
        *(
            F.struct(F.sum(f"{c}.k").alias("k"), F.sum(f"{c}.r").alias("r"), F.count_if(F.col(f"{c}.k") == F.col(f"{c}.r")).alias("w"), F.count(c).alias("n")).alias(c)
            for c in CANDIDATES
        ),
    )
    keyed = cut(keyed)
    long = keyed.select("source_key", F.explode(F.array(*(F.struct(F.lit(c).alias("candidate"), F.lit(_MARK[c]).alias("mark"), F.col(c).alias("s")) for c in CANDIDATES))).alias("c"))
    scores = (
        long.where("c.s.n > 0")
        .groupBy("source_key", F.col("c.candidate").alias("candidate"), F.col("c.mark").alias("mark"))
        .agg(*(F.sum(f"c.s.{x}").alias(x) for x in ("n", "k", "r", "w")))
    )
    scores = _with_prior(scores, {"regularity": ("r", "k"), "whole_rows": ("w", "n")}, "n", prior_rows)
    scores = cut(scores.withColumnRenamed("n", "n_rows").withColumn("fits", (F.col("regularity") + F.col("whole_rows")) / 2 >= least_score))
    fitting = scores.where("fits").groupBy("source_key").agg(F.array_join(F.sort_array(F.collect_set("mark")), "").alias("marks"))
    # The signatures under all fitting delimiters, and with each left out. There are far fewer of them than rows.
    spread = keyed.where("group_key is not null").select("source_key", "group_key", "signature", "n")
    kinds = spread.select("source_key", "signature").distinct().join(fitting, "source_key").select(
        "source_key", "signature", _value_count(F.col("signature"), F.col("marks")).alias("full"),
        F.transform(
            F.split("marks", ""),
            lambda m: F.struct(m.alias("mark"), F.contains("signature", m).alias("here"), _value_count(F.col("signature"), F.replace(F.col("marks"), m, F.lit(""))).alias("left")),
        ).alias("outs"),
    )
    counts = spread.join(kinds, ["source_key", "signature"])
    flat = counts.select("source_key", "group_key", "n", "full", F.explode("outs").alias("o"))
    agree = (
        flat.groupBy("source_key", "group_key", F.col("o.mark").alias("mark"))
        .agg(
            F.sum("n").alias("n"), F.bool_or("o.here").alias("here"),
            (F.min("full") == F.max("full")).alias("same_full"), (F.min("o.left") == F.max("o.left")).alias("same_left"),
        )
        .where("n > 1 and here")
        .groupBy("source_key", "mark")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("same_full").alias("full"), F.count_if("same_left").alias("left"))
    )
    agree = _with_prior(agree, {"agree_with": ("full", "n"), "agree_without": ("left", "n")}, "n", prior_rows).select("source_key", "mark", "agree_with", "agree_without")
    out = scores.join(agree, ["source_key", "mark"], "left")
    accepted = F.col("fits") & (F.coalesce("agree_with", F.lit(1.0)) >= F.coalesce("agree_without", F.lit(0.0)))
    return out.select("source_key", "candidate", "n_rows", "regularity", "whole_rows", "agree_with", "agree_without", accepted.alias("accepted"))


def _with_prior(counted: DataFrame, shares: dict[str, tuple[str, str]], size: str, prior: int) -> DataFrame:
    """Shares of two counts per source and mark, drawn towards those of all sources by the weight of ``prior`` rows."""
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    if not prior:
        return counted.select("*", *(share(F.col(a), F.col(b)).alias(name) for name, (a, b) in shares.items()))
    pooled = counted.groupBy(F.col("mark").alias("__m")).agg(*(share(F.sum(a), F.sum(b)).alias(f"__{name}") for name, (a, b) in shares.items()))
    own = F.col(size) / (F.col(size) + F.lit(prior))
    joined = counted.join(pooled, F.col("mark") == F.col("__m"))
    return joined.select(*counted.columns, *((own * share(F.col(a), F.col(b)) + (1 - own) * F.col(f"__{name}")).alias(name) for name, (a, b) in shares.items()))


def unquote(piece: Column) -> Column:
    """Drop enclosing quotes, halve doubled quotes inside them, trim again."""
    double = piece.rlike(r'(?s)^"(?:[^"]++|"")*+"$')
    single = piece.rlike(r"(?s)^'(?:[^']++|''|'(?=\p{L}))*+'$")
    inner = F.regexp_replace(piece, r"(?s)^.|.$", "")
    return strip_blanks(
        F.when(double, F.replace(inner, F.lit('""'), F.lit('"')))
        .when(single, F.replace(inner, F.lit("''"), F.lit("'")))
        .otherwise(piece)
    )


_CUT = chr(0xE0FF)


def _cut_marks(field: Column, names: list[str]) -> Column:
    """A field with one mark for any of the delimiters; its blanks stay as they are."""
    signs = "".join(c for n, cs in _SINGLE_SIGNS.items() if n in names for c in cs)
    text = F.translate(field, signs, _CUT * len(signs)) if signs else field
    others = [n for n in names if n not in _SINGLE_SIGNS]
    if not others:
        return text
    pattern = "|".join(CANDIDATES[n] for n in others)
    first = {c for n in others for c in _FIRST[n] if n != "side_vs"}
    wide = [n for n in others if n == "side_vs"]
    holds = [F.contains(field, F.lit(c)) for c in [*sorted(first), *(c for n in wide for c in _HOLDS[n])]]
    return _let(text, lambda t: F.when(reduce(lambda a, b: a | b, holds), F.regexp_replace(t, pattern, _CUT)).otherwise(t))


def split_packed(field: Column, names: list[str]) -> Column:
    """The values of a field under the given delimiters, as an array."""
    ordered = [n for n in CANDIDATES if n in names]
    delimiter = "|".join(CANDIDATES[n] for n in ordered)
    # Runs of characters that begin no delimiter and no quote are passed in one step. Possessive groups
    # run in a loop in Java, so no field is too long for the stack.
    begins = "".join(sorted({c for n in ordered for c in _FIRST[n]}))
    run = "[^\"'" + "".join(f"\\u{ord(c):04X}" for c in begins) + "]++"
    piece = rf"(?s)(?:{delimiter})*+((?:{run}|{_QUOTED}|(?!{delimiter}).)*+)" if ordered else "(?s)(.++)"
    quoted = F.transform(F.regexp_extract_all(field, F.lit(piece), F.lit(1)), lambda p: unquote(strip_blanks(p)))
    plain = F.transform(F.split(_cut_marks(field, ordered), _CUT), strip_blanks)
    return F.filter(F.when(_quotes(field), quoted).otherwise(plain), lambda p: p != "")


def explode_packed(
    df: DataFrame,
    field: str,
    keep: list[str],
    source: Column | None = None,
    group: str | None = None,
    out: str = "value",
    least_score: float = 0.85,
    prior_rows: int = 0,
) -> DataFrame:
    """One row per value of a packed field: ``keep`` columns, ``pos``, ``out``.

    The delimiters are those of :func:`infer_delimiters`. ``pos`` counts the
    values of a field from 0 in reading order; empty pieces don't count. Null
    and blank fields give no rows. Enclosing quotes and outer white space of
    any kind are dropped; a doubled quote within quotes is one quote. Repeated
    rows give repeated rows. A source without an accepted delimiter has one
    value per field. Extra columns don't matter.

    The sets of delimiters that occur are at most two to the power of the 14
    candidates, however many sources there are; each becomes one branch of a
    CASE, so splitting stays a JVM expression.
    """
    model = infer_delimiters(df, field, source, group, least_score, prior_rows).where("accepted")
    model = model.groupBy("source_key").agg(F.sort_array(F.collect_set("candidate")).alias("delimiters"))
    if source is None:
        names = [r["delimiters"] for r in model.collect()]
        values = split_packed(F.col(field), names[0] if names else [])
        base = df
    else:
        model = cut(model)
        variants = [r["delimiters"] for r in model.select("delimiters").distinct().collect()]
        keyed = model.select(F.col("source_key").alias("__source"), F.col("delimiters").alias("__delimiters"))
        # Up to so many sources (some 30 MB) the model goes to the rows, beyond that rows and model are shuffled.
        if keyed.limit(_SHARED_SOURCES + 1).count() <= _SHARED_SOURCES:
            keyed = F.broadcast(keyed)
        base = df.withColumn("__source", source.cast("string")).join(keyed, "__source", "left")
        values = split_packed(F.col(field), [])
        for names in variants:
            values = F.when(F.col("__delimiters") == F.array(*map(F.lit, names)), split_packed(F.col(field), names)).otherwise(values)
    return base.where(F.col(field).rlike(f"[^{BLANKS}]")).select(*keep, F.posexplode(values).alias("pos", out))
