"""Column-level text rules: analyzers, keys, normalisation, dates.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the original tool's behaviour) -------------
# Characters replaced by "_" when a page title becomes a file key:
#   ? ” : / “
TITLE_KEY_CHARS = "?\u201d:/\u201c"
# Whitespace rules for page text: NBSP becomes a space; ideographic space
# (U+3000), CR, LF and TAB are removed.
NBSP = "\u00a0"
IDEOGRAPHIC_SPACE = "\u3000"
# Label prefixes inside page spans and the editor block.
SOURCE_LABEL = "来源："
EDITOR_LABEL = "编辑："
EDITOR_MARK = "编辑"
PERIOD_LABEL = "期次："
READCOUNT_LABEL = "阅读："
FULLWIDTH_COLON = "："
# Publish-time format of the page header (strptime "%Y-%m-%d %H:%M").
PUBLISH_TIME_FORMAT = "yyyy-M-d H:m"
# --------------------------------------------------------------------------

# Analyzer patterns (Java regex).  A "standard" token is a run of letters or
# digits; every Han character is a token of its own.  URL tokens keep dotted
# host names together, as the standard tokenizer does for "a.b.c".
WORD_PATTERN = r"[\p{L}\p{N}]+"
HAN_PATTERN = r"(\p{IsHan})"
# one regex pass: a Han character, or a run of other letters and digits
STANDARD_TOKEN_PATTERN = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"
URL_TOKEN_PATTERN = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standard_tokens(c: Column | str) -> Column:
    """Lower-case, split into letter/digit runs, one token per Han character."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(STANDARD_TOKEN_PATTERN), 0)


def url_tokens(c: Column | str) -> Column:
    """Lower-case URL terms; host names such as ``a.example.com`` stay whole."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(URL_TOKEN_PATTERN), 0)


def keyword_tokens(c: Column | str) -> Column:
    """Un-analysed field: the whole value is the single term ('' gives none)."""
    v = _col(c)
    return F.when(F.coalesce(v, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(v))


def title_key(c: Column | str) -> Column:
    """File key of a page title: ``? ” : / “`` each become ``_``."""
    return F.translate(_col(c), TITLE_KEY_CHARS, "_" * len(TITLE_KEY_CHARS))


def snapshot_key(c: Column | str) -> Column:
    """Snapshot lookup key: the file key with spaces removed."""
    return F.replace(title_key(c), F.lit(" "), F.lit(""))


def strip_all(c: Column | str, suffixes: Iterable[str]) -> Column:
    """Remove every occurrence of each string, in the given order."""
    out = _col(c)
    for s in suffixes:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: trim Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), r"^[\s\p{Z}\u0085]+|[\s\p{Z}\u0085]+$", "")


def record_title(c: Column | str, suffixes: Iterable[str] = ()) -> Column:
    """Record title: site suffixes removed, NBSP to space, U+3000 removed.
    Not trimmed."""
    out = strip_all(c, suffixes)
    return F.translate(out, NBSP + IDEOGRAPHIC_SPACE, " ")


def normalize_text(c: Column | str) -> Column:
    """Body text: NBSP to space; U+3000, CR, LF and TAB removed."""
    return F.translate(_col(c), NBSP + IDEOGRAPHIC_SPACE + "\r\n\t", " ")


def clean_editor(c: Column | str) -> Column:
    """Editor block: label removed, CR/LF/TAB and ASCII spaces removed."""
    out = F.replace(_col(c), F.lit(EDITOR_LABEL), F.lit(""))
    return F.translate(out, "\r\n\t ", "")


def parse_publish_time(c: Column | str) -> Column:
    """``%Y-%m-%d %H:%M`` to timestamp_ntz; anything else gives NULL."""
    v = py_strip(_col(c))
    ok = v.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$")
    return F.when(ok, F.try_to_timestamp(v, F.lit(PUBLISH_TIME_FORMAT))).cast("timestamp_ntz")


def last_after_colon(c: Column | str) -> Column:
    """``text.split('：')[-1].strip()``."""
    return py_strip(F.element_at(F.split(_col(c), FULLWIDTH_COLON, -1), -1))


#: An escaped character, a wildcard, or a run of plain characters.
WILDCARD_PART = r"(?s)\\.|[*?]|[^*?\\]+|\\$"


def wildcard_to_regex(c: Column | str) -> Column:
    """Translate a wildcard pattern (``*`` any run, ``?`` one character, a
    backslash makes the next character literal) to an anchored Java regex;
    every other character is matched literally."""
    parts = F.regexp_extract_all(_col(c), F.lit(WILDCARD_PART), 0)

    def part(p: Column) -> Column:
        literal = F.when(p.startswith("\\") & (F.length(p) > 1), F.substring(p, 2, 2)).otherwise(p)
        quoted = F.regexp_replace(literal, r"([\\\[\]{}()^$.|+*?])", r"\\$1")
        return F.when(p == "?", ".").when(p == "*", ".*").otherwise(quoted)

    return F.concat(F.lit("^"), F.array_join(F.transform(parts, part), ""), F.lit("$"))


#: Ends of a term, as characters of its trigrams (fixed values no text has).
TERM_START, TERM_END = "\x02", "\x03"


def _trigrams(c: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))


def term_trigrams(c: Column | str) -> Column:
    """Distinct trigrams of a term (not empty) with both its ends."""
    return F.array_distinct(_trigrams(F.concat(F.lit(TERM_START), _col(c), F.lit(TERM_END))))


def wildcard_trigrams(c: Column | str, case_insensitive: bool = False) -> Column:
    """Trigrams that every term matching a wildcard pattern has: those of its
    literal runs, an end of the pattern being one of the term's.  None where no
    run is long enough.  Without regard to case, only runs of ASCII count (other
    letters may change their number), in small letters, as the terms are."""
    gap = "\x00"
    parts = F.regexp_extract_all(_col(c), F.lit(WILDCARD_PART), 0)

    def part(p: Column) -> Column:
        return F.when(p.isin("*", "?"), F.lit(gap)).when(p.startswith("\\") & (F.length(p) > 1), F.substring(p, 2, 2)).otherwise(p)

    runs = F.split(F.concat(F.lit(TERM_START), F.array_join(F.transform(parts, part), ""), F.lit(TERM_END)), gap, -1)
    if case_insensitive:
        runs = F.transform(F.filter(runs, lambda r: r.rlike(r"^[\x00-\x7F]*$")), F.lower)
    return F.array_distinct(F.flatten(F.transform(F.filter(runs, lambda r: F.length(r) >= 3), _trigrams)))
