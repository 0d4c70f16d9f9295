"""Text normalisation as column expressions (no Python in the row path)."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.arrays import let

# Code-point ranges treated as CJK ideographs.
CJK_RANGES = (
    (0x4E00, 0x9FFF),
    (0x3400, 0x4DBF),
    (0x20000, 0x2A6DF),
    (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F),
    (0x2B820, 0x2CEAF),
    (0xF900, 0xFAFF),
    (0x2F800, 0x2FA1F),
)
# Characters deleted from tweet tokens and from review tokens.
TWEET_PUNCTUATION = "!#$%&\\()*+-/:;<=>?@[]^_`{|}"
REVIEW_PUNCTUATION = TWEET_PUNCTUATION + "."
# Whitespace that separates words of a question-answer context.
CONTEXT_SPACE = "[ \\t\\r\\n\\x{202F}]+"

# Every character Python's str.split() treats as whitespace.
SPACE = "[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]"
# ASCII symbols that count as punctuation although Unicode files them under S.
_SYMBOLS = "$+<=>^`|~"
_PUNCTUATION = "([\\p{P}" + "".join("\\" + c for c in _SYMBOLS) + "])"
_CJK = "([" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES) + "])"
_NON_ASCII = "[^\\x00-\\x7F]"
# Category C spelled out, as class intersections match several times slower.
_CONTROL_BUT_NEWLINE = (
    "[\\x00-\\x09\\x0B-\\x1F\\x7F-\\x9F\\p{Cf}\\p{Co}\\p{Cn}\\p{Cs}\\x{FFFD}]"
)
#: Anything but printable ASCII, without and with newlines.
_NOT_PLAIN = ("[^ -~]", "[^ -~\\n]")
_HANGUL = ("가", "힣")
# All that is left of SPACE in a cleaned text, but plain spaces and newlines.
_CLEAN_SPACE = "[\\x{2028}\\x{2029}]"


@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str, dict[str, str]]:
    """Accent stripping derived from the Unicode database.

    Returns the 1:1 replacements as two aligned strings and the few
    non-Hangul characters that decompose into several kept characters.
    """
    src, dst, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char) or _HANGUL[0] <= char <= _HANGUL[1]:
            continue
        kept = "".join(
            c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"
        )
        if kept == char or unicodedata.category(char) == "Mn":
            continue
        if len(kept) == 1:
            src.append(char)
            dst.append(kept)
        elif kept:
            longer[char] = kept
    return "".join(src), "".join(dst), longer


def utf8_text(raw: Column) -> Column:
    """Bytes to text, dropping invalid sequences."""
    return F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "\\x{FFFD}", "")


def clean(text: Column, keep_lines: bool = False) -> Column:
    """Drop control characters; every kind of space becomes a plain space."""
    # Plain spaces, the most frequent of all, are passed over.
    if keep_lines:
        spaced = F.regexp_replace(text, "(?! )[\\p{Zs}\\t\\r]", " ")
        return F.regexp_replace(spaced, _CONTROL_BUT_NEWLINE, "")
    spaced = F.regexp_replace(text, "(?! )[\\p{Zs}\\t\\n\\r]", " ")
    return F.regexp_replace(spaced, "[\\p{C}\\x{FFFD}]", "")


def space_cjk(text: Column) -> Column:
    # The plain range test is much cheaper than the eight-range replacement.
    first = min(a for a, _ in CJK_RANGES)
    possible = text.rlike(f"[\\x{{{first:X}}}-\\x{{10FFFF}}]")
    return F.when(possible, F.regexp_replace(text, _CJK, " $1 ")).otherwise(text)


def _from_code(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _decompose(char: Column) -> Column:
    """One character into its kept canonical parts; Hangul syllables by arithmetic."""
    longer = accent_tables()[2]
    table = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    syllable = F.ascii(char) - F.lit(0xAC00)
    tail = syllable % 28
    jamo = F.concat(
        _from_code(F.lit(0x1100) + F.floor(syllable / 588)),
        _from_code(F.lit(0x1161) + F.floor((syllable % 588) / 28)),
        F.when(tail > 0, _from_code(F.lit(0x11A7) + tail)).otherwise(""),
    )
    return F.when((char >= _HANGUL[0]) & (char <= _HANGUL[1]), jamo).otherwise(
        F.coalesce(F.element_at(table, char), char)
    )


def _ranges(chars) -> str:
    """Characters as the fewest ranges of a character class."""
    runs: list[list[int]] = []
    for code in sorted(ord(c) for c in chars):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs)


def strip_accents(text: Column) -> Column:
    """Canonical decomposition without the non-spacing marks."""
    src, dst, longer = accent_tables()
    # Only these characters have several kept parts; all others are one table away.
    hangul = "-".join(f"\\x{{{ord(c):X}}}" for c in _HANGUL)
    # The plain test goes first, as a class of many ranges is slow on each character.
    opened = F.when(
        text.rlike(f"(?={_NON_ASCII})[{_ranges(longer)}{hangul}]"), F.array_join(F.transform(F.split(text, ""), _decompose), "")
    ).otherwise(text)
    plain = F.regexp_replace(F.translate(opened, src, dst), "\\p{Mn}", "")
    return F.when(text.rlike(_NON_ASCII), plain).otherwise(text)


def space_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, _PUNCTUATION, " $1 ")


def words_of(text: Column) -> Column:
    """Split on runs of separators; no empty words."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def basic_text(text: Column, lower: bool = True, keep_lines: bool = False) -> Column:
    """Normalised text in which every word and punctuation mark stands alone."""
    # Steps that look at their text several times get it bound, or each look
    # would go through all the steps before.

    def spaced(text: Column) -> Column:
        made = let(space_cjk, clean(text, keep_lines))
        return let(strip_accents, F.lower(made)) if lower else made

    # Printable ASCII has nothing but its case to be changed before the punctuation.
    plain = lambda t: F.when(t.rlike(_NOT_PLAIN[keep_lines]), spaced(t)).otherwise(F.lower(t) if lower else t)
    return space_punctuation(let(plain, text))


def _plain_spaces(cleaned: Column) -> Column:
    return F.regexp_replace(cleaned, _CLEAN_SPACE, " ")


def _spaced_words(line: Column) -> Column:
    # One plain character: a pattern would be compiled for every line.
    return F.array_remove(F.split(line, " "), "")


def spaced_text(text: Column, lower: bool = True, keep_lines: bool = False) -> Column:
    """Normalised text whose words stand between plain spaces, and lines between newlines where they are kept."""
    return _plain_spaces(basic_text(text, lower, keep_lines))


def basic_tokens(text: Column, lower: bool = True) -> Column:
    return _spaced_words(spaced_text(text, lower))


def unit_tokens(lines: Column, lower: bool = True) -> Column:
    """Tokens of a newline-joined text as ``array<struct<unit int, word string>>``.

    ``unit`` is the 0-based number of the line a token came from.
    """
    return line_units(spaced_text(lines, lower, keep_lines=True))


def line_units(spaced: Column) -> Column:
    """``unit_tokens`` of a text that is normalised already."""
    return F.flatten(
        F.transform(
            F.split(spaced, "\n"),
            lambda line, i: F.transform(
                _spaced_words(line), lambda w: F.struct(i.alias("unit"), w.alias("word"))
            ),
        )
    )


def word_units(spaced: Column) -> Column:
    """Words of a normalised text as ``array<struct<unit int, word string>>``, each a unit of its own."""
    return F.transform(_spaced_words(spaced), lambda w, i: F.struct(i.alias("unit"), w.alias("word")))


def strip_handles(text: Column) -> Column:
    """Remove links, then mentions, then hashtags."""
    for opening in ("http", "@", "#"):
        text = F.regexp_replace(text, opening + SPACE.replace("[", "[^", 1) + "+", "")
    return text


def delete_chars(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def flat_lines(text: Column) -> Column:
    """Newline and tab to space, carriage return deleted."""
    return F.translate(text, "\n\t\r", "  ")


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, _NON_ASCII, "")


def squeeze(text: Column) -> Column:
    """Collapse whitespace runs and strip the ends."""
    # Where single spaces are all there is, none is replaced.
    runs = lambda t: F.when(t.rlike("[^ -~]|  "), F.regexp_replace(t, SPACE + "+", " ")).otherwise(t)
    return F.trim(let(runs, text))


def sentences(text: Column) -> Column:
    """Rule split: after ``.``, ``!`` or ``?`` when spaces and a capital follow."""
    marked = F.regexp_replace(text, "([.!?])" + SPACE + "+(\\p{Lu})", "$1\n$2")
    return F.filter(
        F.transform(F.split(marked, "\n"), lambda s: F.trim(s)), lambda s: s != ""
    )


def rule_words(text: Column) -> Column:
    """Rule word split: punctuation stands alone, whitespace separates."""
    return words_of(space_punctuation(text))


def joined_lower(tokens: Column, strip: bool) -> Column:
    """Lower-case, join, delete doubled apostrophes, collapse whitespace."""
    text = F.array_join(F.transform(tokens, lambda t: F.lower(t)), " ")
    text = F.regexp_replace(F.replace(text, F.lit("''"), F.lit("")), SPACE + "+", " ")
    return F.trim(text) if strip else text


def label_name(label: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(label, SPACE + "+", " ")), " ", "_")


def join_pieces(text: Column) -> Column:
    """Glue continuation pieces of a space-joined piece list back into words."""
    glued = F.replace(F.replace(text, F.lit(" ##"), F.lit("")), F.lit("##"), F.lit(""))
    return squeeze(glued)


def url_key(url: Column) -> Column:
    return F.md5(url)
