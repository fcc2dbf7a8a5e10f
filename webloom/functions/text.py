"""Text Column expressions: tokenizer, stop words, number test, id helpers.

Everything here returns a ``Column`` built from JVM built-ins (regex, higher
order array functions), so it runs inside whole-stage code generation or the
interpreted expression path -- never a Python worker.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's analyzer -------------------
# English stop words of the standard analyzer's default stop set (33 words,
# from the public Lucene documentation), in their natural order.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will",
    "with",
)
# -----------------------------------------------------------------------------

# --- fixed values of the Unicode word-break rules (UAX #29) ------------------
# Characters that join two letters, two digits, or either (MidLetter, MidNum,
# MidNumLet with the single quote).
MID_LETTER = r":\x{B7}\x{387}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
MID_NUM = r",;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
MID_NUM_LET = r"'.\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
# Marks and format characters belong to what they follow (Extend, Format).
EXTEND = r"\p{M}\x{AD}\x{200C}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{FF9E}\x{FF9F}"
# Katakana with its sound and repeat marks; scripts that need a dictionary to
# be cut into words (a run is one token); scripts whose characters stand alone.
KATAKANA = r"\p{IsKatakana}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}\x{30FC}\x{FF70}"
COMPLEX = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
ALONE = r"\p{IsHan}\p{IsHiragana}"
# -----------------------------------------------------------------------------


def re2(pattern: str) -> str:
    """The same pattern for RE2 (the SQL oracle): no possessive quantifiers, script
    names without 'Is'.  Only for patterns that match alike without backtracking."""
    return re.sub(r"([*+?])\+", r"\1", pattern).replace(r"\p{Is", r"\p{")


# The state table of the word-break rules as one pattern, a state per line.  Every
# choice is settled by the next character, so possessive quantifiers (which keep
# the Java engine from recursing or backtracking on long tokens) change nothing.
#   letters: a letter of an alphabet or Hangul, joined by MidLetter | MidNumLet
#   digits:  joined by MidNum | MidNumLet; letters and digits join directly
#   connectors ('_' and the like) join letters, digits and Katakana runs
def _tokens(letter: str) -> str:
    letters = rf"{letter}(?:{letter}++|[{EXTEND}]++)*+"
    digits = rf"\p{{Nd}}[\p{{Nd}}{EXTEND}]*+"
    word = (rf"(?:{letters}(?:[{MID_LETTER}{MID_NUM_LET}][{EXTEND}]*+{letters})*+"
            rf"|{digits}(?:[{MID_NUM}{MID_NUM_LET}][{EXTEND}]*+{digits})*+)++")
    run = rf"(?:{word}|[{KATAKANA}][{KATAKANA}{EXTEND}]*+)"
    connect = rf"\p{{Pc}}[\p{{Pc}}{EXTEND}]*+"
    joined = rf"{run}(?:{connect}{run})*+(?:{connect})?+"
    return (rf"(?:{joined}|{connect}(?:{joined})?+"
            rf"|[{ALONE}][{EXTEND}]*+|[{COMPLEX}][{COMPLEX}{EXTEND}]*+)")


# Java looks scripts up slowly: a look-ahead passes over blanks and punctuation, and
# a-z are named first; neither changes a match.
_LETTER = rf"^\P{{L}}{ALONE}{KATAKANA}{COMPLEX}"
#: Lower-case letters of Latin-1, as single characters: the engine looks them up in a table.
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
# First a run of these letters that a blank, a stop with a blank or the end follows: the
# rules join nothing to it, so it is the token that they give, without the table of states.
_PLAIN = rf"[{LATIN_LETTERS}]++(?=[ \n]|[.,](?:[ \n]|\z)|\z)"
TOKEN_PATTERN_JAVA = (rf"(?:{_PLAIN}|" + r"(?=[\p{L}\p{N}\p{M}\p{S}\p{Pc}\x{30A0}])" + _tokens(rf"[a-z[{_LETTER}]]") + ")")
TOKEN_PATTERN = re2(_tokens(rf"[{_LETTER}]"))
# A token must carry at least one letter or number (a run of '_' is not a word).
WORDISH_PATTERN = r"[\p{L}\p{N}]"

# Number test on a lower-cased token: "0x" + hex digits; otherwise only digits,
# ',' and hex letters, or digits and ',' with at most one '.'.  Words made of
# the letters a-f ("bad", "face") are numbers under this rule, as in the
# reference.  Fullwidth a-f carry the same numeric values as a-f.
HEX_PATTERN = r"^0x[\p{Nd}a-fａ-ｆ]+$"
NUMBER_PATTERN = r"^(?:[\p{Nd},a-fａ-ｆ]*|[\p{Nd},]*\.?[\p{Nd},]*)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """array<string> of lower-cased word tokens by the word-break rules: ideographs and
    Hiragana one by one, Katakana and Hangul in runs, scripts without spaces (Thai, Lao,
    Khmer, Burmese) a run each.  Null text gives null; the Hebrew quote rules are left out."""
    raw = F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN_JAVA), 0)
    return F.filter(raw, lambda t: t.rlike(WORDISH_PATTERN))


def is_stop_word(token) -> Column:
    return _c(token).isin(*STOP_WORDS)


def is_number_string(token) -> Column:
    """True when the (lower-cased) token reads as an int, float or hex number."""
    t = F.lower(_c(token))
    return F.when(t.startswith("0x"), t.rlike(HEX_PATTERN)).otherwise(t.rlike(NUMBER_PATTERN))


def index_terms(text) -> Column:
    """Tokens that reach the index: tokenized, stop words and numbers removed."""
    return F.filter(tokenize(text), lambda t: ~is_stop_word(t) & ~is_number_string(t))


def doc_key(trec_id) -> Column:
    """Row key from an archive id: the digits from the first 'en' onwards
    (the whole string when there is no 'en')."""
    s = _c(trec_id)
    start = F.greatest(F.instr(s, "en"), F.lit(1))
    return F.regexp_replace(s.substr(start, F.length(s)), r"[^\p{Nd}]", "")


def strip_http_header(body) -> Column:
    """Drop an HTTP header in front of the HTML: from 'Content-Length' cut to
    the next '<'; no '<' after it -> empty; no 'Content-Length' -> unchanged."""
    s = _c(body)
    at = F.instr(s, "Content-Length")
    rel = F.instr(s.substr(at, F.length(s)), "<")
    return (F.when(at == 0, s)
            .when(rel == 0, F.lit(""))
            .otherwise(s.substr(at + rel - 1, F.length(s))))


def header_key(line) -> Column:
    """Key of a 'key: value' header line (text before the first ':', trimmed)."""
    return F.trim(F.split(_c(line), ":", 2).getItem(0))


def header_value(line) -> Column:
    """Value of a header line (after the first ':', trimmed); '' without a colon."""
    parts = F.split(_c(line), ":", 2)
    return F.when(F.size(parts) > 1, F.trim(parts.getItem(1))).otherwise(F.lit(""))


# Placeholders of the external-program command template (fixed values).
INPUT_PLACEHOLDER = "#_INPUTFILE_#"
OUTPUT_PLACEHOLDER = "#_OUTPUTFILE_#"


def fill_command(template, input_path, output_path) -> Column:
    """Substitute the input/output placeholders of a command template."""
    t = F.replace(_c(template), F.lit(INPUT_PLACEHOLDER), _c(input_path))
    return F.replace(t, F.lit(OUTPUT_PLACEHOLDER), _c(output_path))


def base_name(path) -> Column:
    """File name after the last '/'."""
    return F.element_at(F.split(_c(path), "/"), -1)


def lines_containing(text, keyword) -> Column:
    """array<string> of the lines of ``text`` containing ``keyword``."""
    kw = keyword if isinstance(keyword, Column) else F.lit(keyword)
    return F.filter(F.split(_c(text), "\n"), lambda ln: ln.contains(kw))
