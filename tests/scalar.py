"""Plain-Python definitions of the text operators, the yardstick of the random tests.

Written from the definitions, one character at a time, with the standard library's
Unicode data.
"""

import re
import unicodedata


def strip_edges(t):
    while t and t[0].isspace():
        t = t[1:]
    while t and t[-1].isspace():
        t = t[:-1]
    return t


def remove_control_chars(t):
    return "".join(c for c in t if not (ord(c) < 32 and c not in "\t\n\r"))


def collapse_whitespace(t):
    out = ""
    for c in t:
        if not c.isspace():
            out += c
        elif not out.endswith(" ") or not space:
            out += " "
        space = c.isspace()
    return out


def normalize_unicode_quotes(t):
    return "".join("'" if c in "’‘‚‛‹›" else '"' if c in "“”„‟«»" else c for c in t)


def _word(c):
    return c.isalnum() or c == "_"


def fix_apostrophe_spacing(t):
    out, i = "", 0
    while i < len(t):
        j = i + 1
        if t[i] in "'’" and i and _word(t[i - 1]):
            while j < len(t) and t[j].isspace():
                j += 1
            if j > i + 1 and j < len(t) and _word(t[j]):
                out, i = out + "'", j
                continue
        out, i = out + t[i], i + 1
    return out


def contains_control_chars(t):
    return any(unicodedata.category(c) == "Cc" and c not in "\t\n\r" for c in t)


def contains_invisible_format_chars(t):
    return any(unicodedata.category(c) == "Cf" for c in t)


def contains_url(t):
    part = r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
    return any(s in t for s in ("http://", "https://", "ftp://", "www.")) or bool(re.search(r"\b" + part, t))


def contains_email(t):
    return bool(re.search(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", t))


def has_odd_number_of_quotes(t):
    padded = " " + t + "  "
    odd = False
    for before, c, after, later in zip(padded, padded[1:], padded[2:], padded[3:] + " "):
        if c not in "\"'„“”‚‘’«»":
            continue
        inner = before.isalnum() and (after.isalnum() or (after.isspace() and later in "sS"))
        plural = before in "sS" and not after.isalnum()
        if c in "'’" and (inner or plural):
            continue
        odd = not odd
    return odd


def has_unbalanced_brackets(t):
    kept = "".join(c for c in t if c in "([{«‹“„‘‚)]}»›”’")
    while True:
        shorter = kept
        for pair in ("()", "[]", "{}", "«»", "‹›", "“”", "‘’"):
            shorter = shorter.replace(pair, "")
        if shorter == kept:
            return kept != ""
        kept = shorter


def target_not_latin_like(t, least=20, share=0.6):
    letters = [c for c in t if unicodedata.category(c).startswith("L")]
    latin = [c for c in letters if "LATIN" in unicodedata.name(c, "")]
    return len(letters) >= least and len(latin) / len(letters) < share


def is_blank(t):
    return strip_edges(t) == ""
