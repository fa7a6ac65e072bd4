"""Text functions as column builders: cleaning, words, tokens, sentences, hashes, formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Function words by language; other languages have none.
STOPWORDS = {
    "en": ["and", "the", "for", "with", "from", "that", "this", "was", "are"],
    "da": ["og", "det", "den", "der", "som", "med", "for", "til", "fra", "var"],
}
BLANKS = " \t\r\x0b\x0c"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``use``, also inside other lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapse(text: Column) -> Column:
    """White space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_lines(text: Column) -> Column:
    """Strip every line and drop the empty ones."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def sections(text: Column) -> Column:
    """Parts between blank lines, stripped; a text without any is one section."""
    parts = F.filter(F.transform(F.split(text, "\n\n"), lambda x: F.btrim(x, F.lit(BLANKS + "\n"))), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(text))


def words(text: Column) -> Column:
    """White-space separated words; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def fold(text: Column) -> Column:
    """Caseless form: lower case, sharp s as ss."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the folded text."""
    return F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def normalized(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


def index_tokens(text: Column, most: int = 128) -> Column:
    """The first ``most`` distinct tokens in code point order."""
    return F.slice(F.array_sort(F.array_distinct(tokens(text))), 1, most)


def meaningful(text: Column, lang: str = "en") -> Column:
    """Distinct tokens of more than two letters that are not function words."""
    stop = STOPWORDS.get(lang, [])
    long = F.array_distinct(F.filter(tokens(text), lambda t: F.length(t) > 2))
    return F.array_except(long, F.array(*map(F.lit, stop))) if stop else long


def sentences(text: Column) -> Column:
    """Collapsed text split after a full stop, exclamation or question mark and a space."""
    return F.filter(F.split(collapse(text), r"(?<=[.!?])\s+"), lambda s: s != "")


def slug(text: Column) -> Column:
    """Lower case, everything but a-z and 0-9 as single hyphens, none at the ends; null if nothing is left."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    return F.nullif(F.regexp_replace(dashed, "^-+|-+$", ""), F.lit(""))


def stable_index(text: Column, n: int) -> Column:
    """h = 33 h + code point, mod 2147483647, over the text; then mod n."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    start = F.lit(0).cast("long")
    return F.aggregate(chars, start, lambda h, c: (h * 33 + F.ascii(c)) % 2147483647) % n


def hash_order(seed: int, key: Column) -> Column:
    """A fixed shuffle: order rows by this."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def excerpt(text: Column, most: int = 220) -> Column:
    """One line of at most ``most`` characters, an ellipsis where it is cut."""
    line = collapse(text)
    return F.when(F.length(line) > most, F.concat(F.rtrim(F.substring(line, 1, most - 1)), F.lit("…"))).otherwise(line)


def path_text(value: Column) -> Column:
    """A nested value as stripped text; empty is null."""
    return F.nullif(F.btrim(value.cast("string"), F.lit(BLANKS + "\n")), F.lit(""))


def length_bucket(text: Column) -> Column:
    n = F.size(tokens(text))
    return F.when(n <= 10, "short").when(n <= 22, "medium").otherwise("long")


def row_seed(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256), 1, 16)
