"""Text changes: each takes a string column and returns the changed column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import text as tx

# --- Fixed values -------------------------------------------------------------
# Control characters that are removed; tab, line feed and carriage return stay.
CONTROL = [chr(c) for c in range(0x20) if chr(c) not in "\t\n\r"]
# Typographic quotes and their plain counterparts.
SINGLE_QUOTES = "’‘‚‛‹›"
DOUBLE_QUOTES = "“”„‟«»"
APOSTROPHES = "'’"
# ------------------------------------------------------------------------------


def strip_edges(text: Column) -> Column:
    """Remove whitespace at both ends."""
    return tx.strip(text)


def remove_control_chars(text: Column) -> Column:
    """Delete control characters below U+0020 other than tab, LF and CR."""
    return F.regexp_replace(text, tx.char_class(CONTROL) + "+", "")


def collapse_whitespace(text: Column) -> Column:
    """Turn each whitespace run into one space.

    A single plain space is already what it should become, so the pattern passes over
    it: a first plain space needs more whitespace behind it, another character does not.
    """
    return F.regexp_replace(text, f"[{tx.WS}](?:(?<! )[{tx.WS}]*+|[{tx.WS}]++)", " ")


def normalize_unicode_quotes(text: Column) -> Column:
    """Map typographic quotes to plain ones."""
    quotes, plain = SINGLE_QUOTES + DOUBLE_QUOTES, "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES)
    # Most texts have none; the test is cheaper than translating every character.
    return F.when(text.rlike(tx.char_class(quotes)), F.translate(text, quotes, plain)).otherwise(text)


def fix_apostrophe_spacing(text: Column) -> Column:
    """Close the gap in ``minute' s``: word char, apostrophe, whitespace, word char.

    The lookbehind stands after the apostrophe so that it only runs on apostrophes.
    """
    pattern = f"[{APOSTROPHES}](?<=[{tx.WORD}][{APOSTROPHES}])[{tx.WS}]++(?=[{tx.WORD}])"
    return F.regexp_replace(text, pattern, "'")
