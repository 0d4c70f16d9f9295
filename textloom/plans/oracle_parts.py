"""SQL fragments shared by the check queries (DuckDB dialect)."""

from __future__ import annotations

from textloom.functions.text import CJK_RANGES
from textloom.plans.vocabulary import SPECIALS

SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_CJK = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES)


def clean(x: str) -> str:
    spaced = rf"regexp_replace({x}, '[\p{{Zs}}\t\n\r]', ' ', 'g')"
    return rf"regexp_replace({spaced}, '[\p{{C}}\x{{FFFD}}]', '', 'g')"


def space_cjk(x: str) -> str:
    return rf"regexp_replace({x}, '([{_CJK}])', ' \1 ', 'g')"


def fold(x: str) -> str:
    return f"strip_accents(lower({x}))"


def space_punctuation(x: str) -> str:
    return rf"regexp_replace({x}, '([\p{{P}}$+<=>^`|~])', ' \1 ', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPACE}+'), lambda w: w <> '')"


def basic(x: str, lower: bool = True) -> str:
    spaced = space_cjk(clean(x))
    return space_punctuation(fold(spaced) if lower else spaced)


def tokens(x: str, lower: bool = True) -> str:
    return words(basic(x, lower))


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?]){SPACE}+(\p{{Lu}})', '\1' || chr(10) || '\2', 'g')"
    return (
        f"list_filter(list_transform(string_split({marked}, chr(10)), lambda s: trim(s)),"
        " lambda s: s <> '')"
    )


def bits(digest: str, part: int = 0) -> str:
    return f"('0x' || substr({digest}, {8 * part + 1}, 8))::BIGINT"


def digest(seed: str, *keys: str) -> str:
    return "md5('" + seed + "' || " + " || ".join(f"'|' || {k}" for k in keys) + ")"


def pick(digest_sql: str, n: str, part: int = 0) -> str:
    return f"(({bits(digest_sql, part)} * ({n})::BIGINT) >> 32)"


def joined(x: str) -> str:
    return f"array_to_string({x}, ' ')"


LINES = """
lines AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit
  FROM documents)"""


def line_words(source: str = "lines") -> str:
    """Words of lines: (doc_id, unit, wpos, word)."""
    return f"""
line_tokens AS (SELECT doc_id, unit, {tokens('line')} AS toks FROM {source}),
occ AS MATERIALIZED (
  SELECT doc_id, unit, unnest(toks) AS word, generate_subscripts(toks, 1) AS wpos
  FROM line_tokens)"""


_SPECIAL_ROWS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SPECIALS))

# The corpus vocabulary of plans.vocabulary, from all words of `documents`.
VOCAB = f"""
vcounts AS MATERIALIZED (
  SELECT token, count(*) AS n
  FROM (SELECT unnest({tokens('text')}) AS token FROM documents) GROUP BY 1),
vtop AS (
  SELECT token, row_number() OVER (ORDER BY n DESC, token) AS place FROM vcounts
  QUALIFY place <= 1000),
vchars AS (
  SELECT DISTINCT substr(token, i, 1) AS token
  FROM (SELECT token, unnest(range(1, length(token) + 1)) AS i FROM vcounts)),
ventries AS (
  SELECT token, 0 AS block, place FROM (VALUES {_SPECIAL_ROWS}) s(place, token)
  UNION ALL SELECT token, 1, 0 FROM vchars
  UNION ALL SELECT '##' || token, 2, 0 FROM vchars
  UNION ALL SELECT token, 3, place FROM vtop
  UNION ALL SELECT '##' || token, 4, place FROM vtop WHERE place <= 300),
vfirst AS (
  SELECT token, min(block * 1000000 + place) AS sort_key FROM ventries GROUP BY 1),
vocab AS MATERIALIZED (
  SELECT token, row_number() OVER (ORDER BY sort_key, token) - 1 AS token_id FROM vfirst)"""


def dictionary(occurrences: str = "occ") -> str:
    """Pieces of distinct words: (word, k, piece, id) rows, k from 1."""
    return f"""
dwords AS MATERIALIZED (SELECT DISTINCT word FROM {occurrences}),
dstarts AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS s FROM dwords WHERE length(word) <= 200),
dspans AS (
  SELECT word, s, unnest(range(s, length(word) + 1)) AS e FROM dstarts),
dbest AS MATERIALIZED (
  SELECT word, s, max(e) AS e FROM dspans
  JOIN vocab ON token = (CASE WHEN s > 1 THEN '##' ELSE '' END) || substr(word, s, e - s + 1)
  GROUP BY 1, 2),
dwalk AS (
  SELECT word, 0::BIGINT AS s, 0::BIGINT AS e, 0 AS k FROM dwords
  UNION ALL
  SELECT w.word, b.s, b.e, w.k + 1 FROM dwalk w JOIN dbest b ON b.word = w.word AND b.s = w.e + 1),
dwhole AS (SELECT word FROM dwalk WHERE k > 0 AND e = length(word)),
dpieces AS (
  SELECT word, k, (CASE WHEN s > 1 THEN '##' ELSE '' END) || substr(word, s, e - s + 1) AS piece
  FROM dwalk JOIN dwhole USING (word) WHERE k > 0
  UNION ALL
  SELECT word, 1, '[UNK]' FROM dwords WHERE word NOT IN (SELECT word FROM dwhole)),
dict AS MATERIALIZED (
  SELECT word, k, piece, token_id AS id FROM dpieces JOIN vocab ON token = piece)"""


ENCODED = """
enc AS MATERIALIZED (
  SELECT doc_id, unit, wpos, k, word, piece, id,
         row_number() OVER (PARTITION BY doc_id ORDER BY unit, wpos, k) AS pno
  FROM occ JOIN dict USING (word))"""


def with_parts(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"


CORPUS = with_parts(LINES, line_words(), VOCAB, dictionary(), ENCODED).rstrip()
