"""Text functions, all ``Column -> Column`` and free of Python workers.

They also apply unchanged to streaming DataFrames.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.numbers import bind
from presswork.functions.wordlists import ABBREVIATIONS, MONTHS, SEQUENCE_FILTERS, STOP_WORDS

# Patterns that decide what is cut from a text.
MARKUP = r"(&[A-Za-z]+)|\([^\n]*\)"
FONT = r"(FONT|font)[^\n]*/(FONT|font)"
DATES = "[0-9 ]*(" + "|".join(MONTHS) + ")[., ]*[0-9]*[., ]*[0-9]*"
# the same matches: no month starts with a digit or blank, so that run never has to be given back
_FAST_DATES = DATES.replace("[0-9 ]*(", "[0-9 ]*+(?=[ADFJMNOS])(", 1)
DATELINE = r"^[A-Za-z0-9/,. ]*\(*[A-Za-z.]+\)* -"
DATELINE_CHARS = 35

# Word-splitting rules in their order, applied to a space-padded text.
SPLIT_RULES = [
    (r"""([;@#$%&?!()\[\]{}<>"])""", " $1 "),
    (r"(--|\.\.\.)", " $1 "),
    (r"([,:])([^0-9])", " $1 $2"),
    (r"([^' ])(' )", "$1 $2"),
    (r"(?i)('ll|'re|'ve|'s|'m|'d)([ .])", " $1 $2"),
    (r"(?i)(n't)([ .])", " $1 $2"),
    (r"(?i) (can)(not) ", " $1 $2 "),
    (r"(?i) (gon|wan)(na) ", " $1 $2 "),
    (r"(?i) (got)(ta) ", " $1 $2 "),
    (r"(?i) (gim|lem)(me) ", " $1 $2 "),
]

# Unicode white space spelled out, since regex engines differ on \s
SPACES = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD_CHARS = r"\p{L}\p{N}_"


def strip_markup(text: Column) -> Column:
    """Delete ``&name`` and, per line, everything from the first ( to the last )."""
    return F.regexp_replace(text, MARKUP, "")


def strip_font(text: Column) -> Column:
    """Delete ``FONT ... /FONT``, greedy within a line."""
    return F.regexp_replace(text, FONT, "")


def strip_dates(text: Column) -> Column:
    """Replace month names and the numbers around them by one space (no word borders)."""
    return F.regexp_replace(text, _FAST_DATES, " ")


def dateline(text: Column) -> Column:
    """Leading news source within the first 35 characters, '' where there is none."""
    return F.regexp_extract(F.substring(text, 1, DATELINE_CHARS), DATELINE, 0)


def _spaced(text: Column, abbreviations: Sequence[str]) -> Column:
    text = F.concat(F.lit(" "), F.regexp_replace(text, r"[ \t\n\r\f]+", " "), F.lit(" "))
    for pattern, replacement in SPLIT_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    kept = "|".join(abbreviations)
    guard = rf"(?!(?i:{kept})\.)" if kept else ""
    return F.regexp_replace(text, rf"(?<= ){guard}([^. ]{{2,}}+)\.(?= )", "$1 .")


def treebank_tokens(text: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """Penn-Treebank style word tokens."""
    return F.filter(F.split(_spaced(text, abbreviations), " "), lambda t: t != "")


def lower_tokens(tokens: Column) -> Column:
    return F.transform(tokens, F.lower)


def alpha_tokens(tokens: Column) -> Column:
    """Keep tokens made of letters only."""
    return F.filter(tokens, lambda t: t.rlike(r"^\p{L}+$"))


def drop_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def clean_text(
    text: Column,
    font: bool = False,
    stop_words: Sequence[str] = STOP_WORDS,
    abbreviations: Sequence[str] = ABBREVIATIONS,
) -> Column:
    """Markup out, tokens lower-cased, letters only, stop words out; null becomes ''.

    Equal to chaining the single steps, but the all-letter tokens are picked
    from the spaced text by one expression instead of one test per token.
    """
    text = strip_markup(F.coalesce(text, F.lit("")))
    if font:
        text = strip_font(text)
    letters = F.regexp_extract_all(
        F.lower(_spaced(text, abbreviations)), F.lit(r"(?<= )\p{L}++(?= )"), F.lit(0)
    )
    return join_tokens(drop_stop_words(letters, stop_words))


@functools.cache
def _ascii_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    singles, targets, expansions = [], [], []
    for code in range(0x80, 0x20000):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 0x80)
        if len(plain) == 1:
            singles.append(char)
            targets.append(plain)
        elif len(plain) > 1:
            expansions.append((char, plain))
    return "".join(singles), "".join(targets), tuple(expansions)


def strip_accents_ascii(text: Column) -> Column:
    """Compatibility-decompose and drop everything outside ASCII."""
    singles, targets, expansions = _ascii_tables()
    pairs = "\x02".join(f"{char}\x01{plain}" for char, plain in expansions)
    longer = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))
    without = F.translate(text, "".join(char for char, _ in expansions), "")
    spelled = F.array_join(
        F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(longer, c), c)), ""
    )
    text = F.when(F.length(without) < F.length(text), spelled).otherwise(text)
    return F.regexp_replace(F.translate(text, singles, targets), r"[^\x00-\x7F]", "")


def word_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case words of two or more a-z letters that are whole word runs."""
    pattern = rf"(?<![{WORD_CHARS}])[a-z]{{2,}}+(?![{WORD_CHARS}])"
    words = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return drop_stop_words(words, stop_words) if stop_words else words


def word_ngrams(tokens: Column, low: int = 2, high: int = 3) -> Column:
    """All runs of ``low`` to ``high`` tokens joined by a space; tokens hold no spaces."""

    def runs(line: Column) -> Column:
        return F.concat(
            *[
                F.regexp_extract_all(
                    line, F.lit(rf"(?<![^ ])(?=([^ ]++(?: [^ ]++){{{n - 1}}}))[^ ]++"), F.lit(1)
                )
                for n in range(low, high + 1)
            ]
        )

    return bind(F.array_join(tokens, " "), runs)


def squeezed(text: Column) -> Column:
    """The lower-case text with runs of white space as one blank."""
    return F.regexp_replace(F.lower(text), rf"[{SPACES}]{{2,}}", " ")


def char_ngrams(text: Column, low: int = 2, high: int = 3) -> Column:
    """All runs of ``low`` to ``high`` characters of the lower-case text."""

    def runs(line: Column) -> Column:
        return F.concat(
            *[
                F.regexp_extract_all(line, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))
                for n in range(low, high + 1)
            ]
        )

    return bind(squeezed(text), runs)


def wordpunct_tokens(text: Column) -> Column:
    """Alternating runs of word characters and of punctuation."""
    pattern = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{SPACES}]+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def sequence_tokens(text: Column) -> Column:
    """Lower-case words split at blanks after punctuation became blanks."""
    blanks = " " * len(SEQUENCE_FILTERS)
    return F.filter(F.split(F.translate(F.lower(text), SEQUENCE_FILTERS, blanks), " "), lambda t: t != "")


def context_windows(word_ids: Column, window: int = 2, pad: int = 0) -> Column:
    """For each word id its neighbours, left-padded: array of (pos, context, target)."""

    def windows(ids: Column) -> Column:
        def one(target: Column, i: Column) -> Column:
            start = F.greatest(i - window, F.lit(0))
            left = F.slice(ids, start + 1, i - start)
            right = F.slice(ids, i + 2, F.lit(window))
            missing = F.lit(2 * window) - F.size(left) - F.size(right)
            padding = F.array_repeat(F.lit(pad).cast("bigint"), missing)
            return F.struct(
                i.alias("pos"), F.concat(padding, left, right).alias("context"), target.alias("target")
            )

        return F.transform(ids, one)

    return bind(word_ids, windows)
