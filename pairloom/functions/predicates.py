"""Text predicates: each takes a string column and returns a boolean column.

True means the text is flawed. Texts are never null here; the flaw operator
passes ``coalesce(text, '')``.

Patterns start with a plain character class and look behind only after it has
matched, so the regex engine rejects almost every position with one class test.
"""

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import text as tx

# --- Fixed values -------------------------------------------------------------
# A URL: a scheme, www. or a domain. A domain is a word boundary, one or more parts of
# [A-Za-z0-9-]+ with a full stop each, and [A-Za-z]{2,}.
URL_SCHEMES = r"(?:https?|ftp)://"
URL_WWW = "www."
# An e-mail address: a word boundary, [A-Za-z0-9._%+-]+, @, [A-Za-z0-9.-]+, a full stop,
# [A-Za-z]{2,} and a word boundary.
MAIL_HOST = r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
GERMAN_CHARS = "äöüÄÖÜß"
# All characters of category Cc.
CONTROL_CHARS = [chr(c) for c in [*range(0x00, 0x20), *range(0x7F, 0xA0)]]
ALLOWED_CONTROL_CHARS = "\t\n\r"
QUOTE_CHARS = "\"'„“”‚‘’«»"
APOSTROPHES = "'’"
# Opening brackets, and closing ones with the opener each needs. A character that
# could be both opens: “ and ‘ therefore never close „ and ‚.
OPENERS = "([{«‹“„‘‚"
CLOSERS = ")]}»›”’"
OPENER_OF_CLOSER = "([{«‹“‘"
# ------------------------------------------------------------------------------

# Numbers that are added up in one fold, and the place of the depth in a bracket's sorting key.
SUM_PIECE = 256
DEPTH_SHIFT = 36
_W = tx.WORD
# These two find the same texts as the definitions above, in linear time. A boundary
# somewhere in the run of allowed characters before the stop or the @ is enough, so only
# the last stretch of letters and digits, or of the other characters, is examined: it
# must begin at a boundary. Before a stop, parts made of hyphens only may follow.
DOMAIN = rf"(?:[A-Za-z0-9](?<![{_W}].)[A-Za-z0-9]*+|-(?<=[{_W}].)-*+)\.(?:-++\.)*+[A-Za-z]{{2}}"
EMAIL = rf"(?:[A-Za-z0-9_](?<![{_W}].)[A-Za-z0-9_]*+|[.%+-](?<=[{_W}].)[.%+-]*+)@{MAIL_HOST}(?![{_W}])"


def contains_url(text: Column) -> Column:
    """A scheme, ``www.`` or a domain: also a missing space after a full stop.

    Each part has a cheap test that most texts fail before the expensive one.
    """
    scheme = text.contains("://") & text.rlike(URL_SCHEMES)
    domain = text.rlike(r"\.[A-Za-z]{2}") & text.rlike(DOMAIN)
    return scheme | text.contains(URL_WWW) | domain


def contains_email(text: Column) -> Column:
    return text.contains("@") & text.rlike(EMAIL)


def contains_german_chars(text: Column) -> Column:
    return text.rlike(f"[{GERMAN_CHARS}]")


def is_blank(text: Column) -> Column:
    return tx.strip(text) == ""


def is_too_short(text: Column, *, min: int) -> Column:
    if min < 0:
        raise ValueError(f"a text can't be shorter than {min} characters")
    return F.length(text) < min


def is_too_long(text: Column, *, max: int) -> Column:
    if max < 0:
        raise ValueError(f"no text has at most {max} characters")
    return F.length(text) > max


def contains_control_chars(text: Column, *, allow: str = ALLOWED_CONTROL_CHARS) -> Column:
    """A category-Cc character that is not in ``allow``."""
    forbidden = set(CONTROL_CHARS) - set(allow)
    return text.rlike(tx.char_class(forbidden)) if forbidden else F.lit(False)


def contains_invisible_format_chars(text: Column) -> Column:
    """A category-Cf character: soft hyphen, zero-width and direction marks."""
    return text.rlike(r"\p{Cf}")


def has_odd_number_of_quotes(text: Column, *, quote_chars: Iterable[str] = QUOTE_CHARS) -> Column:
    """An odd count of quotes, leaving out quotes that are apostrophes.

    An apostrophe stands between letters or digits, or after one and before a
    whitespace and an s, or after an s and not before a letter or digit.
    """
    quotes = set(quote_chars)
    if not quotes:
        return F.lit(False)
    count = tx.count_matches(text, tx.char_class(quotes))
    apostrophes = quotes & set(APOSTROPHES)
    if apostrophes:
        mark = tx.char_class(apostrophes)
        pattern = (
            f"{mark}(?:(?<=[sS].)(?![{tx.ALNUM}])"
            f"|(?<=[{tx.ALNUM}].)(?=[{tx.ALNUM}]|[{tx.WS}][sS]))"
        )
        count = count - tx.count_matches(text, pattern)
    return text.rlike(tx.char_class(quotes)) & (F.pmod(count, F.lit(2)) == 1)


def _sums_before(numbers: Column) -> Column:
    """For each number, the sum of those before it.

    In pieces: a fold copies its state at every step, so it must not grow with the text.
    """
    zero = F.lit(0).cast("bigint")

    def running(piece: Column, base: Column) -> Column:
        start = F.struct(base.cast("bigint").alias("now"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            piece,
            start,
            lambda state, n: F.struct(
                (state["now"] + n).alias("now"), F.array_append(state["out"], state["now"]).alias("out")
            ),
            lambda state: state["out"],
        )

    def within(pieces: Column) -> Column:
        sums = F.transform(pieces, lambda piece: F.aggregate(piece, zero, lambda x, n: x + n))
        return F.flatten(F.zip_with(pieces, running(sums, zero), running))

    def cut(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), F.lit(SUM_PIECE))
        return F.transform(starts, lambda at: F.slice(values, at, F.lit(SUM_PIECE)))

    return _let(_let(numbers, cut), within)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def has_unbalanced_brackets(text: Column) -> Column:
    """Brackets that do not nest properly, each closer needing its own opener.

    Brackets are sorted by depth, then place. If they nest, an opener and its closer are neighbours
    then, at the same depth. Texts without brackets, and those with more brackets of one kind than of the
    other, are decided at once; the time for others grows like that of sorting.
    """
    inside = tx.members(OPENERS + CLOSERS)
    # Brackets as letters: an opener is a capital, a closer the small letter of its opener.
    letters = "ABCDEFGHIJ"[: len(OPENERS)]
    closing = "".join(letters[OPENERS.index(c)].lower() for c in OPENER_OF_CLOSER)
    small = ord("a") - ord("A")

    def wrong(keys: Column) -> Column:
        def bad(key: Column, k: Column) -> Column:
            before = F.get(keys, k - 1)
            same_depth = F.shiftright(key, DEPTH_SHIFT) == F.shiftright(before, DEPTH_SHIFT)
            closes = key.bitwiseAND(F.lit(0xFF)) == before.bitwiseAND(F.lit(0xFF)) + small
            opens = key.bitwiseAND(F.lit(0xFF)) < ord("a")
            return F.when(k % 2 == 0, ~opens).otherwise(~(same_depth & closes))

        return F.exists(F.transform(keys, bad), lambda x: x)

    def walked(codes: Column) -> Column:
        steps = F.transform(codes, lambda c: F.when(c < ord("a"), 1).otherwise(-1))
        # The depth of a closer is that of its opener.
        keys = F.transform(
            F.zip_with(codes, _sums_before(steps), lambda c, d: F.struct(c.alias("c"), d.alias("d"))),
            lambda x, k: F.shiftleft(x["d"] - F.when(x["c"] < ord("a"), 0).otherwise(1), DEPTH_SHIFT)
            + F.shiftleft(k.cast("bigint"), 8)
            + x["c"],
        )
        return _let(F.sort_array(keys), wrong)

    def unbalanced(brackets: Column) -> Column:
        closers = F.length(F.translate(brackets, letters, ""))
        codes = F.transform(F.split(brackets, ""), F.ascii)
        return F.when(closers * 2 != F.length(brackets), F.lit(True)).otherwise(_let(codes, walked))

    brackets = F.translate(F.regexp_replace(text, f"[^{inside}]+", ""), OPENERS + CLOSERS, letters + closing)
    return F.when(text.rlike(f"[{inside}]"), _let(brackets, unbalanced)).otherwise(False)


def target_not_latin_like(text: Column, *, min_letters: int = 20, min_latin_ratio: float = 0.6) -> Column:
    """At least ``min_letters`` letters, of which too small a share is Latin."""
    letters = tx.count_chars(text, r"\p{L}")
    others = tx.count_chars(text, tx.NOT_LATIN_LETTER)
    latin_share = (letters - others) / F.greatest(letters, F.lit(1))
    flawed = (letters >= min_letters) & (latin_share < min_latin_ratio)
    if min_latin_ratio > 1:
        return flawed
    # Without a letter of another script the share is 1. A condition, unlike "and", keeps
    # the repeated letter count from being computed up front.
    return F.when(text.rlike(tx.NOT_LATIN_LETTER), flawed).otherwise(False)
