"""Text functions as column expressions: folding, tokens, business labels, label scores.

None of these is a Python function at run time, so they stay inside whole-stage code generation.
Null texts count as empty ones throughout.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, functions as F

# Words that say nothing about a business.
BUSINESS_STOPWORDS = [
    "CLIENT", "CLIENTS", "LAN2LAN", "L2L", "TRUNK", "VERS", "CPE", "DSP", "VLAN", "POP", "SITE", "PORT", "ACCES", "ACCESS",
    "TRANSPORT", "COLLECTE", "SERVICE", "SERVICES", "SHUT", "TEMPORAIRE", "NE", "PAS", "CPEDSP", "CLIENTLAN2LAN", "CLIENTL2L",
    "TELOISE", "BAIE", "HOTEL", "POLICE", "RUE",
]


#: No character from here on decomposes to Latin letters or digits or is a mark that goes with them.
_LAST = 0x20000


def _folding() -> tuple[str, str, dict[str, str]]:
    """Characters that decompose to one character, with it, followed by marks, which go; and those
    that decompose to several, with these. Only what ends as letters or digits matters."""
    one, several, marks = {}, {}, []
    for c in map(chr, range(0x80, _LAST)):
        if unicodedata.combining(c):
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if not plain:
            marks.append(c)
        elif plain != c and re.search("[A-Z0-9]", plain.upper()):
            (one if len(plain) == 1 else several)[c] = plain
    return "".join([*one, *marks]), "".join(one.values()), several


_FROM, _TO, _SEVERAL = _folding()


def _ranges(characters) -> str:
    """A class of characters by its runs, which a pattern tests far faster than one by one."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


# Most characters are ASCII and are not held against all the runs.
_LONG = rf"[^\x00-\x7F](?<={_ranges(_SEVERAL)})"


def _unfolded(text: Column) -> Column:
    """text with each character of _SEVERAL written out, letter by letter where it has one."""
    tabbed = lambda xs: F.split(F.lit("\t".join(xs)), "\t")
    table = F.map_from_arrays(tabbed(_SEVERAL), tabbed(_SEVERAL.values()))
    spell = lambda c: F.when((F.octet_length(c) > 1) & c.rlike(_LONG), F.element_at(table, c)).otherwise(c)
    return F.when(text.rlike(_LONG), F.array_join(F.transform(F.split(text, ""), spell), "")).otherwise(text)


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def norm_text(text: Column) -> Column:
    """Upper case without accents, all but letters and digits as single spaces. Texts of ASCII alone
    skip the folding. The text is worked out once, as it may itself be made of many parts."""
    fold = lambda raw: F.when(F.octet_length(raw) == F.length(raw), raw).otherwise(F.translate(_unfolded(raw), _FROM, _TO))
    return F.trim(F.regexp_replace(F.upper(let(F.coalesce(text, F.lit("")), fold)), "[^A-Z0-9]+", " "))


def words(normed: Column) -> Column:
    return F.filter(F.split(normed, " "), lambda t: t != "")


def text_list(*values: str) -> Column:
    return F.array(*map(F.lit, values))


def ordered_union(*arrays: Column) -> Column:
    """Distinct elements in order of their first occurrence."""
    return F.array_distinct(F.concat(*arrays))


def place_tokens(text: Column, stopwords: list[str] = BUSINESS_STOPWORDS) -> Column:
    """Distinct tokens of four or more characters that may name a place, in order."""
    good = lambda t: (F.length(t) >= 4) & ~t.rlike("^[0-9]+$") & ~t.isin(stopwords) & ~t.endswith("FO")
    return F.array_distinct(F.filter(words(norm_text(text)), good))


def clean_label(text: Column, stopwords: list[str] = BUSINESS_STOPWORDS) -> Column:
    """The business name in a label: references, numbers of 3 to 5 digits and stopwords are left out."""
    gone = [r"\bTOIP\s*\d+\b", r"\b(?:OPE|PE)\s*\d+\b", r"\bL2L\s*\d+\b", r"\b\d{3,5}\b"]
    bare = reduce(lambda c, p: F.regexp_replace(c, p, " "), gone, norm_text(text))
    return F.array_join(F.filter(words(bare), lambda t: ~t.isin(stopwords)), " ")


def business_tokens(cleaned: Column) -> Column:
    """Distinct tokens of four or more characters of a cleaned label, which is cleaned once more."""
    return F.array_distinct(F.filter(words(clean_label(cleaned)), lambda t: F.length(t) >= 4))


def label_score(seed: Column, candidate: Column, overlap: Column) -> Column:
    """How well two cleaned labels match, from 0 to 96; overlap: how many tokens they share."""
    within = F.contains(seed, candidate) | F.contains(candidate, seed)
    return (
        F.when((seed == "") | (candidate == ""), 0)
        .when(seed == candidate, 96)
        .when(within & (overlap >= 2), 90)
        .when(overlap >= 3, F.least(F.lit(88), 18 * overlap + 20))
        .when(overlap == 2, 72)
        .otherwise(0)
        .cast("int")
    )


def hash16(*parts: Column) -> Column:
    """16 hex digits of the SHA-1 of the normalised parts."""
    return F.substring(F.sha1(F.concat_ws("||", *map(norm_text, parts)).cast("binary")), 1, 16)


def hash16_lower(*parts: Column) -> Column:
    """16 hex digits of the SHA-1 of the parts, trimmed and in lower case."""
    return F.substring(F.sha1(F.concat_ws("||", *(F.lower(F.trim(F.coalesce(p, F.lit("")))) for p in parts)).cast("binary")), 1, 16)


def ascii_upper(text: Column) -> Column:
    """a-z in upper case; letters with accents stay as they are, as where texts are compared without case."""
    return F.translate(text, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def first_filled(*texts: Column) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*(F.when(~is_blank(t), t) for t in texts))
