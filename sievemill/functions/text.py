"""White space, case numbers, instants and paths as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, as a character class body for Java patterns:
#: the blanks of Unicode plus the zero-width ones that are typed as blanks.
BLANKS = r"\s\x85\xA0\u1680\u180E\u2000-\u200B\u2028\u2029\u202F\u205F\u2060\u3000\uFEFF"


#: The same blanks as characters.
BLANK_CHARS = " \t\n\x0b\f\r\x85\xa0\u1680\u180e" + "".join(map(chr, range(0x2000, 0x200C))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"


def strip_blanks(value: Column) -> Column:
    """Trim white space of any kind at both ends."""
    return F.btrim(value, F.lit(BLANK_CHARS))


def is_blank(value: Column) -> Column:
    """True for null and for a value of white space only."""
    return value.isNull() | ~value.rlike(f"[^{BLANKS}]")


def case_number(value: Column) -> Column:
    """The canonical NNNNNNN-DD.YYYY.J.TR.OOOO form of a case number as met.

    Anything around and between the 20 digits is dropped. A value without
    exactly 20 digits has no canonical form; its trimmed text is returned,
    so that equal spellings still compare equal. Null stays null.
    """
    wide = "".join(chr(0xFF10 + d) for d in range(10))
    digits = F.regexp_replace(F.translate(value, wide, "0123456789"), "[^0-9]", "")
    formed = F.regexp_replace(digits, r"^(\d{7})(\d{2})(\d{4})(\d)(\d{2})(\d{4})$", "$1-$2.$3.$4.$5.$6")
    return F.when(F.length(digits) == 20, formed).otherwise(strip_blanks(value))


def instant(value: Column) -> Column:
    """An ISO 8601 string as TIMESTAMP; UTC where no offset is written.

    Accepts ``T`` or a blank between date and time, any number of fraction
    digits, ``Z`` and offsets with or without a colon. Null if unreadable.
    """
    text = F.upper(strip_blanks(value))
    text = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    text = F.regexp_replace(text, r"(\d)[ T]++(\d)", "$1T$2")
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text).otherwise(
        F.when(text.contains("T"), F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))
    )
    return zoned.try_cast("timestamp")


def instant_micros(value: Column) -> Column:
    """:func:`instant` as microseconds since 1970 in UTC."""
    return F.unix_micros(instant(value))


def nfc_latin(value: Column) -> Column:
    """Compose Latin letters and combining marks, without leaving the JVM.

    The pairs are derived from the Unicode tables for U+00C0 to U+024F; only
    values that hold a combining mark pay for the replacement.
    """
    pairs = []
    for code in range(0xC0, 0x250):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) == 2:
            pairs.append(F.struct(F.lit(parts).alias("a"), F.lit(chr(code)).alias("b")))
    composed = F.aggregate(F.array(*pairs), value, lambda acc, p: F.replace(acc, p["a"], p["b"]))
    return F.when(value.rlike(r"[\u0300-\u036F]"), composed).otherwise(value)


def file_path(value: Column) -> Column:
    """One spelling per file: slashes, ``.`` steps and composed letters."""
    path = F.regexp_replace(strip_blanks(value), r"\\", "/")
    path = F.regexp_replace(path, r"/(?:\.?/)++", "/")
    path = F.regexp_replace(path, r"^(?:\./)++|/\.?$", "")
    return nfc_latin(path)
