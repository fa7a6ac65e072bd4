"""Response constraints: one column builder for each kind, pass or fail for a response text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold, tokens


def lines(text: Column) -> Column:
    """Non-blank lines."""
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")


def keyword_counts(text: Column, word: str, n: int) -> Column:
    return F.size(F.filter(tokens(text), lambda t: t == word.lower())) == n


def forbidden_words(text: Column, banned: Sequence[str]) -> Column:
    return ~F.arrays_overlap(tokens(text), F.array(*[F.lit(w.lower()) for w in banned]))


def no_digits(text: Column) -> Column:
    return ~text.rlike(r"\p{Nd}")


def all_lowercase(text: Column) -> Column:
    return text == F.lower(text)


def word_count_range(text: Column, least: int, most: int) -> Column:
    return F.size(tokens(text)).between(least, most)


def sentence_count(text: Column, n: int) -> Column:
    parts = F.split(F.trim(text), r"(?<=[.!?])\s+")
    return F.size(F.filter(parts, lambda s: F.trim(s) != "")) == n


def paragraph_count(text: Column, n: int) -> Column:
    return F.size(F.filter(F.split(text, r"\n\s*\n"), lambda p: F.trim(p) != "")) == n


def line_count(text: Column, n: int) -> Column:
    return F.size(lines(text)) == n


def first_word(text: Column, word: str) -> Column:
    return F.coalesce(F.get(tokens(text), F.lit(0)) == word.lower(), F.lit(False))


def end_phrase(text: Column, phrase: str) -> Column:
    return F.regexp_replace(text, r"\s+$", "").endswith(phrase)


def last_word(text: Column, word: str) -> Column:
    t = tokens(text)
    return F.coalesce(F.get(t, F.size(t) - 1) == word.lower(), F.lit(False))


def numbered_list(text: Column, n: int) -> Column:
    marked = F.transform(lines(text), lambda x, i: F.trim(x).startswith(F.concat((i + 1).cast("string"), F.lit("."))))
    return (F.size(marked) == n) & F.forall(marked, lambda m: m)


def bullet_list(text: Column, n: int) -> Column:
    rows = lines(text)
    return (F.size(rows) == n) & F.forall(rows, lambda x: F.trim(x).startswith("- "))


def json_keys(text: Column, keys: Sequence[str]) -> Column:
    got = F.array_sort(F.json_object_keys(text))
    return F.coalesce(got == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False))


def xml_tags(text: Column, root: str, children: Sequence[str]) -> Column:
    """A root element with exactly these children in order; only tags are looked at."""
    tags = F.regexp_extract_all(text, F.lit(r"<([A-Za-z_][\w.-]*)[^<>]*>"), F.lit(1))
    closed = F.trim(text).rlike(rf"(?s)^<{root}[^<>]*>.*</{root}>$")
    return closed & (tags == F.array(*[F.lit(t) for t in (root, *children)]))


def two_responses(text: Column, separator: str = "******") -> Column:
    parts = F.split(text, "\\Q" + separator + "\\E", -1)
    return (F.size(parts) == 2) & F.forall(parts, lambda p: F.trim(p) != "")


def word_positions(text: Column, places: Sequence[tuple[int, str]]) -> Column:
    t, ok = tokens(text), F.lit(True)
    for at, word in places:
        ok = ok & F.coalesce(F.get(t, F.lit(at - 1)) == word.lower(), F.lit(False))
    return ok


def line_indent(text: Column, n: int, step: int) -> Column:
    marked = F.transform(lines(text), lambda x, i: F.length(x) - F.length(F.ltrim(x)) == i * step)
    return (F.size(marked) == n) & F.forall(marked, lambda m: m)


def no_commas(text: Column) -> Column:
    return F.instr(text, ",") == 0


def semicolon_count(text: Column, n: int) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(";"), F.lit(""))) == n


def ordered_keywords(text: Column, first: str, second: str) -> Column:
    a, b = (F.array_position(tokens(text), w.lower()) for w in (first, second))
    return (a > 0) & (b > 0) & (a < b)


def quoted_spans(text: Column, n: int) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r'"[^"\n]+"'), F.lit(0))) == n


CHECKERS = {
    "count:keywords_multiple": keyword_counts,
    "words:forbidden_words": forbidden_words,
    "format:no_digits": no_digits,
    "change_case:all_lowercase": all_lowercase,
    "count:word_count_range": word_count_range,
    "count:sentences": sentence_count,
    "count:paragraphs": paragraph_count,
    "count:line_count": line_count,
    "start_end:first_word": first_word,
    "start_end:end_phrase": end_phrase,
    "start_end:last_word": last_word,
    "format:numbered_list": numbered_list,
    "format:bullet_list": bullet_list,
    "format:json_keys": json_keys,
    "format:xml_tags": xml_tags,
    "format:two_responses": two_responses,
    "words:word_positions": word_positions,
    "format:line_indent": line_indent,
    "punctuation:no_commas": no_commas,
    "punctuation:semicolon_count": semicolon_count,
    "words:ordered_keywords": ordered_keywords,
    "format:quoted_spans": quoted_spans,
}


def loose_variants(text: Column) -> Column:
    """The response, without asterisks, and each without its first, last, or both end lines."""
    plain = F.replace(text, F.lit("*"), F.lit(""))

    def trimmed(t: Column) -> list[Column]:
        ls = F.split(t, "\n")
        n = F.size(ls)
        cut = lambda a, b: F.trim(F.array_join(F.slice(ls, a, F.greatest(b, F.lit(0))), "\n"))
        return [cut(2, n - 1), cut(1, n - 1), cut(2, n - 2)]

    both = [text, plain, *trimmed(text), *trimmed(plain)]
    return F.array_distinct(F.array(*both))


def passes_loosely(text: Column, check) -> Column:
    """Whether any loose variant passes ``check`` (a builder that takes the text alone)."""
    return F.exists(loose_variants(text), check)


__all__ = ["CHECKERS", "fold", "loose_variants", "passes_loosely"]
