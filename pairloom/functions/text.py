"""Character classes and small text expressions shared by changes and predicates.

Java's ``\\s``, ``\\w`` and ``\\b`` do not agree with the Unicode text rules this
library follows, so every pattern is put together from the constants below.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -------------------------------------------------------------
# The 29 code points that count as whitespace.
WHITESPACE = "".join(
    chr(c)
    for c in [
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
    ]
)
# Letters and digits; word characters add the underscore. The last member is a letter
# already: a supplementary character written out makes Java look behind by whole code
# points instead of by UTF-16 units.
ALNUM = r"\p{L}\p{N}" + "\U00010400"
WORD = r"\p{L}\p{N}_" + "\U00010400"
# Letters whose Unicode name contains LATIN, as hexadecimal ranges.
LATIN_RANGES = (
    "41-5a 61-7a c0-d6 d8-f6 f8-2af 1d00-1d25 1d62-1d65 1d6b-1d77 1d79-1d9a 1e00-1eff "
    "2071 207f 2090-209c 2184 2c2e 2c5e 2c60-2c7c 2c7e-2c7f a722-a76f a771-a787 a78b-a7ca "
    "a7d0-a7d1 a7d3 a7d5-a7d9 a7f5-a7f7 a7fa-a7ff ab30-ab5a ab60-ab64 ab66-ab68 fb00-fb06 "
    "ff21-ff3a ff41-ff5a 1df00-1df1e 1df25-1df2a"
)
# ------------------------------------------------------------------------------


def _hex(code_point: int) -> str:
    return rf"\x{{{code_point:x}}}"


def members(chars) -> str:
    """The inside of a regex class matching exactly the given characters.

    Java tests Latin-1 members of a class with one table lookup, and all others one
    after the other. The others are merged into ranges and stand in a nested class
    behind a test of their overall range, so that common characters skip them.
    """
    points = sorted({ord(c) for c in chars})
    latin1 = "".join(_hex(p) for p in points if p <= 0xFF)
    ranges: list[list[int]] = []
    for p in (p for p in points if p > 0xFF):
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return latin1 + _guarded(ranges)


def _guarded(ranges: list[list[int]]) -> str:
    if not ranges:
        return ""
    inside = "".join(f"{_hex(low)}-{_hex(high)}" for low, high in ranges)
    return f"[{_hex(ranges[0][0])}-{_hex(ranges[-1][1])}&&[{inside}]]"


def char_class(chars) -> str:
    return f"[{members(chars)}]"


def _latin() -> str:
    bounds = [[int(bound, 16) for bound in item.split("-")] for item in LATIN_RANGES.split()]
    ranges = [[bound[0], bound[-1]] for bound in bounds]
    ascii_letters = "".join(f"{_hex(low)}-{_hex(high)}" for low, high in ranges if high < 0x80)
    return ascii_letters + _guarded([r for r in ranges if r[1] >= 0x80])


WS = members(WHITESPACE)
LATIN = _latin()
# A letter that is not Latin. ASCII characters fail the first test.
NOT_LATIN_LETTER = rf"[\x{{80}}-\x{{10ffff}}&&\p{{L}}&&[^{LATIN}]]"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def count_chars(text: Column, inside: str) -> Column:
    """Number of characters in the class ``inside``.

    Deletes the runs of all other characters and takes the length: one match per run,
    where counting matches would build one string per counted character.
    """
    return F.length(F.regexp_replace(text, f"[^{inside}]+", ""))


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))
