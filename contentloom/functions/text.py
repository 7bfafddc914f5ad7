"""Text cleaning, tokenizing and formatting as native column expressions.

White space means the 29 code points Python treats as white space. Java's ``\\s`` is
narrower, so the remaining ones are added from their code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE_CODE_POINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
WHITESPACE_CHARS = "".join(map(chr, WHITESPACE_CODE_POINTS))


def _char_class(code_points) -> str:
    return "[" + "".join(f"\\x{{{cp:04x}}}" for cp in code_points) + "]"


def _class_without(code_points) -> str:
    """Every code point but the given ones, as ranges: faster to test than a negation."""
    ranges, start = [], 0
    for cut in [*sorted(code_points), 0x110000]:
        if cut > start:
            ranges.append(f"\\x{{{start:04x}}}-\\x{{{cut - 1:04x}}}")
        start = cut + 1
    return "[" + "".join(ranges) + "]"


# The JVM tests its named classes much faster than a long list of characters, so the rare white
# space that ``\\s`` leaves out is looked at only where a character was about to match.
_JAVA_WHITESPACE = (0x20, *range(0x09, 0x0E))
_RARE_SPACE = _char_class(cp for cp in WHITESPACE_CODE_POINTS if cp not in _JAVA_WHITESPACE)
_SPACE = _char_class(WHITESPACE_CODE_POINTS)
_NEITHER_LETTER_NOR_SPACE = rf"[\P{{Alpha}}&&\S](?<!{_RARE_SPACE})"
_LONG_WORD = _class_without(WHITESPACE_CODE_POINTS) + "{3,}"


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def letters_only(text: Column) -> Column:
    """Delete everything but ASCII letters and white space."""
    return F.regexp_replace(text, _NEITHER_LETTER_NOR_SPACE, "")


def clean_text(text: Column) -> Column:
    """ASCII letters and white space only, lower case, stripped. NULL stays NULL."""
    return strip(F.lower(letters_only(text)))


def _all_matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern, an empty array for NULL."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def tokenize(text: Column) -> Column:
    """White-space separated words of three or more characters; NULL gives an empty array."""
    return _all_matches(text, _LONG_WORD)


def clean_tokens(cleaned: Column) -> Column:
    """``tokenize`` for the outcome of ``clean_text``, whose words are made of a to z alone."""
    return _all_matches(cleaned, "[a-z]{3,}")


def words(text: Column, keep_empty: bool = False, cleaned: bool = False) -> Column:
    """Lower-case words of a topic-model document.

    ``cleaned`` says that ``text`` comes from ``clean_text`` and need not be cleaned again.

    ``keep_empty`` splits at every single white-space character instead of at runs, so that
    neighbouring separators produce empty words.
    """
    lowered = text if cleaned else F.lower(letters_only(text))
    if keep_empty:
        return F.split(F.rtrim(lowered, F.lit(WHITESPACE_CHARS)), _SPACE)
    return F.regexp_extract_all(lowered, F.lit("[a-z]+"), F.lit(0))


def normalize_label(label: Column) -> Column:
    """Lower case without surrounding blanks (U+0020 only)."""
    return F.lower(F.trim(label))


def truncate(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)


def looks_like_markup(text: Column) -> Column:
    return text.contains("<") & text.contains(">")


def two_decimals(number: Column) -> Column:
    """``number`` with two decimals, rounding its exact binary value half to even.

    ``format_string('%.2f')`` rounds the shortest decimal form half up, which differs on values
    such as 0.125 and 0.145. Splitting the fraction into a coarse and a fine part keeps every
    product below exact in double arithmetic, so the comparison with one half is exact too.
    Meant for magnitudes below 1e15.
    """
    size = F.abs(number.cast("double"))
    whole = F.floor(size)
    fraction = size - whole
    coarse = F.floor(fraction * F.lit(2.0**26)) / F.lit(2.0**26)
    fine = (fraction - coarse) * F.lit(100.0)
    hundredths = F.floor(coarse * F.lit(100.0))
    missing_to_half = F.lit(0.5) - (coarse * F.lit(100.0) - hundredths)
    round_up = (fine > missing_to_half) | ((fine == missing_to_half) & (hundredths % 2 == 1))
    cents = whole * 100 + hundredths + F.when(round_up, 1).otherwise(0)
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        sign,
        (F.floor(cents / 100)).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("bigint").cast("string"), 2, "0"),
    )
