"""Text folding and numeric-text parsing, without Python UDFs."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions import formats

# Letters and signs that Unicode does not decompose.
MULTI_CHAR_FOLDS = {
    "ß": "ss",
    "æ": "ae",
    "Æ": "AE",
    "œ": "oe",
    "Œ": "OE",
    "þ": "th",
    "Þ": "Th",
    "…": "...",
    "—": "--",
    "«": "<<",
    "»": ">>",
    "€": "EUR",
    "©": "(c)",
    "®": "(r)",
    "°": "deg",
}
SINGLE_CHAR_FOLDS = {
    "ø": "o",
    "Ø": "O",
    "đ": "d",
    "Đ": "D",
    "ð": "d",
    "Ð": "D",
    "ł": "l",
    "Ł": "L",
    "ħ": "h",
    "Ħ": "H",
    "ı": "i",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "–": "-",
    "¡": "!",
    "¿": "?",
    "´": "'",
    "•": "*",
    "·": "*",
}

# What is left after folding and is folded to nothing.
NOT_ASCII = r"[^\x00-\x7F]+"

# A plain decimal number, and the part before its point.
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"
WHOLE_PART = r"^([+-]?[0-9]*)"


# Signs that become several characters first become one of the private-use area, each
# its own. They are a range, so one comparison per character finds whether there are any.
PRIVATE = 0xE000

# More characters than a text has.
MOST = 2**31 - 1

def _several_table() -> dict[str, str]:
    """Signs that Unicode decomposes to several ASCII characters: fractions, ligatures."""
    found = dict(MULTI_CHAR_FOLDS)
    for code in [*range(0x00A0, 0x0250), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07)]:
        char = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        ).replace("\u2044", "/")
        if len(base) > 1 and base.isascii() and base.strip() and char not in SINGLE_CHAR_FOLDS:
            found.setdefault(char, base)
    return found


def _fold_table(several: dict[str, str]) -> tuple[str, str]:
    """Arguments for ``translate``: Latin letters by their base letter, the signs of
    ``several`` by their private-use character.

    The table follows from Unicode decomposition. Combining marks, and private-use
    characters that a text brings itself, come last, beyond the replacements, which makes
    ``translate`` delete them.
    """
    singles = {char: chr(PRIVATE + at) for at, char in enumerate(several)} | SINGLE_CHAR_FOLDS
    for code in [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if len(base) == 1 and base.isascii() and char not in singles:
            singles[char] = base
    gone = [*range(0x0300, 0x0370), *range(PRIVATE, PRIVATE + len(several))]
    return "".join(singles) + "".join(map(chr, gone)), "".join(singles.values())


_SEVERAL = _several_table()
_FROM, _TO = _fold_table(_SEVERAL)


# Finds a private-use character of the table, which is one comparison per character, and
# the places before one.
_SIGN = f"[\\x{{{PRIVATE:X}}}-\\x{{{PRIVATE + len(_SEVERAL) - 1:X}}}]"
_BEFORE_SIGN = f"(?={_SIGN})"
_BETWEEN = "\x01"


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _spelled_out(folded: Column) -> Column:
    """Private-use characters as what they stand for. The text is cut before each of them,
    so work follows the signs that it has and not the table."""
    plain = F.split(F.lit(_BETWEEN.join(_SEVERAL.values())), _BETWEEN)

    def piece(part: Column) -> Column:
        meaning = F.get(plain, F.ascii(part) - PRIVATE)
        return F.coalesce(F.concat(meaning, F.substring(part, 2, MOST)), part)

    return F.array_join(F.transform(F.split(folded, _BEFORE_SIGN), piece), "")


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def fold_accents(text: Column) -> Column:
    """ASCII form of text; null stays null.

    Latin letters and signs become their base letters or what they stand for. All else
    that is not ASCII goes: pictographs, stars, and letters of other scripts. Rows that
    are plain ASCII already skip the folding.
    """

    def spelled(one_by_one: Column) -> Column:
        whole = F.when(one_by_one.rlike(_SIGN), _spelled_out(one_by_one)).otherwise(one_by_one)
        return _once(whole, without_others)

    def without_others(latin: Column) -> Column:
        return F.when(_is_ascii(latin), latin).otherwise(F.regexp_replace(latin, NOT_ASCII, ""))

    folded = _once(F.translate(text, _FROM, _TO), spelled)
    return F.when(_is_ascii(text), text).otherwise(folded)


def shout(text: Column) -> Column:
    """Accents folded, upper case."""
    return F.upper(fold_accents(text))


def whole_number(value: Column) -> Column:
    """Integer part of numeric text, null where the text is not a number in range."""
    trimmed = F.trim(value.cast("string"), F.lit(formats.BLANKS))
    whole = F.regexp_extract(trimmed, WHOLE_PART, 1)
    digits = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
    return F.when(trimmed.rlike(NUMBER), digits.try_cast("int"))
