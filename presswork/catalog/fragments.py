"""SQL renderings of the text rules, for the DuckDB side of each check."""

from __future__ import annotations

from presswork.catalog.registry import quoted
from presswork.functions.text import DATELINE, DATES, FONT, MARKUP, SPACES, SPLIT_RULES
from presswork.functions.wordlists import ABBREVIATIONS, SEQUENCE_FILTERS, STOP_WORDS

RE2_SPACES = SPACES.replace(r"\x1C-\x1F", r"\x{1C}-\x{1F}").replace(r"\x0B", r"\x{0B}")


def replace_all(text: str, pattern: str, replacement: str) -> str:
    replacement = replacement.replace("$", "\\")
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def sql_list(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def markup(text: str) -> str:
    return replace_all(text, MARKUP, "")


def font(text: str) -> str:
    return replace_all(text, FONT, "")


def dates(text: str) -> str:
    return replace_all(text, DATES, " ")


def dateline(text: str) -> str:
    return f"regexp_extract(substr({text}, 1, 35), {quoted(DATELINE)}, 0)"


def treebank(text: str) -> str:
    spaced = f"concat(' ', {replace_all(text, r'[ \t\n\r\f]+', ' ')}, ' ')"
    for pattern, replacement in SPLIT_RULES:
        spaced = replace_all(spaced, pattern, replacement)
    words = f"list_filter(string_split({spaced}, ' '), lambda t: t <> '')"
    final = (
        "flatten(list_transform(" + words + ", lambda t: CASE WHEN regexp_full_match(t, '[^.]{2,}[.]') "
        f"AND NOT list_contains({sql_list(ABBREVIATIONS)}, lower(t[:-2])) "
        "THEN [t[:-2], '.'] ELSE [t] END))"
    )
    return final


def lowered(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: lower(t))"


def alphabetic(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: regexp_full_match(t, '\\p{{L}}+'))"


def no_stop_words(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({sql_list(STOP_WORDS)}, t))"


def joined(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def clean(text: str, with_font: bool = False) -> str:
    stripped = markup(f"coalesce({text}, '')")
    if with_font:
        stripped = font(stripped)
    return joined(no_stop_words(alphabetic(lowered(treebank(stripped)))))


def words(text: str, stop: bool = False) -> str:
    runs = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')"
    found = f"list_filter({runs}, lambda t: regexp_full_match(t, '[a-z]{{2,}}'))"
    return no_stop_words(found) if stop else found


def ngrams(tokens: str, low: int = 2, high: int = 3) -> str:
    """Subquery column: unnest of all n-grams of the list column ``tokens``."""
    parts = [
        f"list_transform(range(1, greatest(len({tokens}) - {n - 2}, 1)), "
        f"lambda i: array_to_string({tokens}[i:i + {n - 1}], ' '))"
        for n in range(low, high + 1)
    ]
    return f"unnest(list_concat({', '.join(parts)}))"


def characters(text: str) -> str:
    return f"string_split({replace_all(f'lower({text})', '[' + RE2_SPACES + ']{2,}', ' ')}, '')"


def char_ngrams(chars: str, low: int = 2, high: int = 3) -> str:
    parts = [
        f"list_transform(range(1, greatest(len({chars}) - {n - 2}, 1)), "
        f"lambda i: {' || '.join(f'{chars}[i + {d}]' for d in range(n))})"
        for n in range(low, high + 1)
    ]
    return f"unnest(list_concat({', '.join(parts)}))"


def wordpunct(text: str) -> str:
    pattern = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_" + RE2_SPACES + "]+"
    return f"regexp_extract_all({text}, {quoted(pattern)})"


def sequence(text: str) -> str:
    source = "concat(" + quoted(SEQUENCE_FILTERS[:-2]) + ", chr(9), chr(10))"
    blanks = quoted(" " * len(SEQUENCE_FILTERS))
    return f"list_filter(string_split(translate(lower({text}), {source}, {blanks}), ' '), lambda t: t <> '')"
