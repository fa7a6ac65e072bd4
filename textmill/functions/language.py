"""Language filter of parallel texts by function-word shares, without a model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent words that tell the languages apart.
FUNCTION_WORDS = {
    "da": "og det der den til at er som på ikke med har af for de en et".split(),
    "en": "the of and to in is that for it was on are as with this by".split(),
    "de": "der die das und ist nicht ein eine mit auf den von zu sich im".split(),
    "fr": "le la les des et est une que dans pour qui sur pas du au".split(),
    "es": "el la los las que y en un una por con para del se es".split(),
}


def sample(text: Column, most: int = 4000) -> Column:
    """Letters only; of a long text its beginning, middle and end."""
    letters = F.array_join(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0)), " ")
    third, n = max(most // 3, 1), F.length(letters)
    middle = F.substr(letters, F.greatest(F.floor((n - third) / 2), F.lit(0)).cast("int") + 1, F.lit(third))
    return F.when(n <= most, letters).otherwise(F.concat_ws(" ", F.substring(letters, 1, third), middle, F.right(letters, F.lit(third))))


def detect(text: Column, languages: tuple[str, ...] = ("da", "en", "de", "fr", "es")) -> Column:
    """The language with most function words in the sample; ties go to the earlier, none to null."""
    words = F.split(F.lower(sample(text)), " ")
    counts = [F.struct(F.size(F.filter(words, lambda w: w.isin(*FUNCTION_WORDS[lang]))).alias("n"), F.lit(-k).alias("k"), F.lit(lang).alias("lang")) for k, lang in enumerate(languages)]
    best = F.array_max(F.array(*counts))
    return F.when(best.n > 0, best.lang)


def passes(text: Column, allowed: tuple[str, ...], min_chars: int = 80, min_words: int = 4) -> Column:
    """Short samples pass; others must be in an allowed language."""
    s = sample(text)
    short = (F.length(s) < min_chars) & (F.size(F.filter(F.split(s, " "), lambda w: w != "")) < min_words)
    return short | F.coalesce(detect(text).isin(*allowed), F.lit(False))
