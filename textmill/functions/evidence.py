"""Evidence wording and entity facts: what a row may say and what is known of its subject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, path_text

# Wording that points at hidden material, with what replaces it, in order.
REWORDINGS = (
    (r"\baccording to the provided texts\b", "from what is known"),
    (r"\baccording to the provided text\b", "from what is known"),
    (r"\baccording to the retrieved support\b", "from what is known"),
    (r"\baccording to the support\b", "from what is known"),
    (r"\baccording to the evidence\b", "from what is known"),
    (r"\bthe provided texts?\b", "what is known"),
    (r"\bthe hidden facts\b", "what is known"),
    (r"\bthe hidden grounding facts\b", "what is known"),
    (r"\bthe hidden grounding details\b", "the known details"),
    (r"\bthe teacher bundle\b", "the remembered facts"),
    (r"\bthe source claim\b", "the core claim"),
    (r"\bthe source\b", "the topic"),
    (r"\bretrieved support\b", "known details"),
    (r"\bprovided support\b", "known details"),
    (r"\bthe evidence\b", "the known facts"),
    (r"\bevidence\b", "known facts"),
    (r"\bthis is supported by\b", "this is consistent with"),
    (r"\bthe text states that\b", ""),
    (r"\bthe text says that\b", ""),
    (r"\bthe passage states that\b", ""),
    (r"\bthe passage says that\b", ""),
)
# Marks of a person in descriptions, categories and infoboxes.
PERSON = {
    "en": (
        ("physicist", "chemist", "writer", "politician", "artist", "actor", "philosopher", "scientist"),
        ("births", "deaths", "people", "actors", "actresses", "writers", "scientists", "philosophers", "politicians", "artists"),
        ("infobox person", "infobox scientist"),
    ),
    "da": (
        ("fysiker", "kemiker", "forfatter", "politiker", "kunstner", "skuespiller", "filosof", "forsker"),
        ("fødsler", "dødsfald", "personer", "skuespillere", "forfattere", "forskere", "filosoffer", "politikere", "kunstnere"),
        ("infoboks person", "infoboks forsker"),
    ),
}


def recall_text(text: Column) -> Column:
    """Wording without pointers to hidden material, spacing mended, dashes and spaces off the ends."""
    reworded = reduce(lambda t, rule: F.regexp_replace(t, f"(?i){rule[0]}", rule[1]), REWORDINGS, F.trim(text))
    spaced = F.regexp_replace(F.regexp_replace(reworded, r"\s+", " "), r"\s+([.,;:!?])", "$1")
    return F.regexp_replace(spaced, "^[ -]+|[ -]+$", "")


def recall_list(values: Column) -> Column:
    return F.filter(F.transform(values, lambda v: recall_text(v)), lambda v: v != "")


def is_person(description: Column, categories: Column, infoboxes: Column, lang: str = "en") -> Column:
    """Whether any mark of the language is part of the description, a category or an infobox name."""
    said, filed, boxed = ("|".join(marks) for marks in PERSON[lang])
    any_of = lambda values, marks: F.coalesce(F.exists(values, lambda v: F.lower(v).rlike(marks)), F.lit(False))
    return F.coalesce(F.lower(description).rlike(said), F.lit(False)) | any_of(categories, filed) | any_of(infoboxes, boxed)


def title_variants(title: Column) -> Column:
    """The title with and without a leading article, longest first."""
    longer = F.concat(F.lit("The "), title)
    return F.when(F.lower(title).startswith("the "), F.array(title)).otherwise(F.array(longer, title))


def facts(description: Column, aliases: Column, categories: Column, infoboxes: Column, links: Column, most: int) -> Column:
    """Up to ``most`` sentences of what is known of an entity; empty fields give none."""

    def listed(label: str, values: Column, n: int) -> Column:
        kept = F.filter(F.transform(values, lambda v: path_text(v)), lambda v: v.isNotNull())
        return F.when(F.size(kept) > 0, F.concat(F.lit(f"{label}: "), F.array_join(F.slice(kept, 1, n), ", ")))

    told = path_text(description)
    rows = F.array(
        F.when(told.isNotNull(), F.concat(F.lit("Wikidata description: "), told)),
        listed("Aliases", aliases, 3), listed("Categories", categories, 3), listed("Infobox templates", infoboxes, 2), listed("Related links", links, 3),
    )
    return F.slice(F.filter(rows, lambda r: r.isNotNull()), 1, most)


def source_block(ids: Column, titles: Column, snippets: Column) -> Column:
    """XML lines of sources, one for each position."""
    from .render import xml_escape

    rows = F.arrays_zip(ids.alias("id"), titles.alias("title"), snippets.alias("snippet"))
    line = lambda s: F.concat(F.lit('<source id="'), s["id"].cast("string"), F.lit('" title="'), xml_escape(s["title"]), F.lit('">'), xml_escape(s["snippet"]), F.lit("</source>"))
    return F.array_join(F.transform(rows, line), "\n")


def default_target(kind: Column, title: Column, sentence: Column, points: Column) -> Column:
    """A fallback answer: the title, the first coverage points, the predicate after the title, or the sentence."""
    predicate = F.regexp_extract(collapse(sentence), r"(?i)^\S.*?\b(?:is|was|are|were)\s+(.+?)[.!?]?$", 1)
    opened = F.lower(sentence).startswith(F.lower(title))
    return (
        F.when(kind.isin("reverse_definition", "source_clue", "name_the_topic"), title)
        .when(F.size(points) > 0, F.array_join(F.slice(points, 1, 2), " "))
        .when(opened & (predicate != ""), predicate)
        .otherwise(sentence)
    )
