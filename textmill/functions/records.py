"""Record fields as column builders: lists of any form, keys, joined fields, plans by language."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, stable_index

# The axes of a prompt's surface, the lines of a source plan, words a constraint takes.
SURFACE_AXES = {
    "surface_intro": ("context", "assignment", "task_first"),
    "surface_instruction": ("solve", "unique", "consistency"),
    "surface_answer": ("respond", "write", "complete"),
    "surface_clue": ("plain", "compact", "deductive"),
    "surface_response_envelope": ("answer_block", "solution_block", "final_block", "json", "xml", "yaml"),
}
PLAN_LINES = {
    "da": ("Kilde %s er central, fordi den dækker %s", "Kilde %s er sekundær støtte og bør kun bruges til detaljer"),
    "en": ("Source %s is central because it covers %s", "Source %s is secondary support and should only add detail"),
}
KEYWORDS_TAKEN = {"words:ordered_keywords": 2, "words:word_positions": 2, "start_end:first_word": 1, "start_end:last_word": 1}
NONE = "cast(array() as array<string>)"


def _full(values: Column) -> Column:
    return F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def as_list(value: Column) -> Column:
    """A scalar as a list of one; trimmed, without blanks; null as none."""
    return _full(F.array(value.cast("string")))


def list_values(value: Column, most: int) -> Column:
    """The first ``most`` items of a list written with brackets and quotes, or the text itself; blanks are left out."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    quoted = F.regexp_extract_all(text, F.lit(r"'([^']*)'|\"([^\"]*)\"|([^\[\],'\"\s][^\[\],'\"]*)"), F.lit(0))
    items = F.transform(quoted, lambda x: F.regexp_replace(x, r"^['\"]|['\"]$", ""))
    listed = text.startswith("[") & text.endswith("]")
    return F.when(listed, _full(F.slice(items, 1, most))).otherwise(_full(F.array(text)))


def age_at_least(age: Column, least: int) -> Column:
    """Unknown ages pass."""
    return age.isNull() | (age.cast("int") >= least)


def joined_fields(*fields: Column) -> Column:
    """The fields that have a text, one a line."""
    return F.concat_ws("\n", *[F.nullif(F.trim(f.cast("string")), F.lit("")) for f in fields])


def item_key(row_id: Column, row: Column) -> Column:
    """The row's id, else ``row-`` and twelve hex digits of its JSON's SHA-1."""
    own = F.nullif(row_id.cast("string"), F.lit(""))
    return F.coalesce(own, F.concat(F.lit("row-"), F.substring(F.sha1(F.to_json(row)), 1, 12)))


def filter_values(value: Column) -> Column:
    """The items of a list of texts as single lines without blanks; null has none."""
    return F.filter(F.transform(F.coalesce(value, F.expr(NONE)), lambda x: collapse(F.coalesce(x, F.lit("")))), lambda x: x != "")


def ordered_choices(values: Column, allowed: Sequence[str]) -> Column:
    """Distinct values in order; one that is not allowed is an error."""
    wrong = F.array_except(values, F.array(*map(F.lit, allowed)))
    return F.when(F.size(wrong) == 0, F.array_distinct(values)).otherwise(F.raise_error(F.concat(F.lit("not allowed: "), F.array_join(wrong, ", "))))


def surface_plan(key: Column, axes: Mapping[str, Sequence[str]] = SURFACE_AXES) -> Column:
    """struct of one value for each axis, chosen by the key and the axis alone."""
    pick = lambda name, values: F.get(F.array(*map(F.lit, values)), stable_index(F.concat(key, F.lit(f"|{name}")), len(values)).cast("int"))
    return F.struct(*[pick(name, values).alias(name) for name, values in axes.items()])


def support_query(*parts: Column, lists: Sequence[Column] = ()) -> Column:
    """What is said on the source's side, as one query for sources of another language."""
    said = F.concat(_full(F.array(*[p.cast("string") for p in parts])), *[_full(x) for x in lists])
    return F.array_join(said, " ")


def source_plan(sources: Column, required: Column, lang: str = "en") -> Column:
    """A line for each required source (citation_id, claim), then for up to two that support."""
    central, support = PLAN_LINES[lang if lang in PLAN_LINES else "en"]
    return F.concat(
        F.transform(F.slice(sources, F.lit(1), required), lambda s: F.format_string(central, s.citation_id, s.claim)),
        F.transform(F.slice(sources, required + 1, F.lit(2)), lambda s: F.format_string(support, s.citation_id)),
    )


def language_plan(source: Column, prompt: Column, reasoning: Column, target: Column) -> Column:
    """The languages of prompt, reasoning and target; without any plan all are the source's."""
    none = prompt.isNull() & reasoning.isNull() & target.isNull()
    need = lambda c, name: F.when(none, source).when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"language plan without {name}")))
    return F.struct(source.alias("source"), need(prompt, "prompt").alias("prompt"), need(reasoning, "reasoning").alias("reasoning"), need(target, "target").alias("target"))


def qa_grounded(expected: Column, retrieved: Column) -> Column:
    """The first expected source was retrieved, and a second one if more are expected."""
    both = F.size(F.array_intersect(expected, retrieved))
    return F.coalesce((F.size(retrieved) > 0) & F.array_contains(retrieved, F.get(expected, F.lit(0))) & ((F.size(expected) == 1) | (both >= 2)), F.lit(False))


def constraints_supported(ids: Column, lang: Column, shape: Column, definitions: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> Column:
    """Whether all constraints (at least one) know the language and suit the shape; unknown ids do not."""
    fits = lambda c, kind: F.coalesce(
        *[F.when(c == name, (lang if kind == 0 else shape).isin(*allowed[kind])) for name, allowed in definitions.items()], F.lit(False)
    )
    return (F.size(ids) > 0) & F.forall(ids, lambda c: fits(c, 0) & fits(c, 1))


def keywords_taken(constraint: Column) -> Column:
    """How many keywords a constraint (id, n) takes: its own number, or what its kind takes."""
    taken = F.when(constraint.id == "count:keywords_multiple", constraint.n)
    for name, n in KEYWORDS_TAKEN.items():
        taken = taken.when(constraint.id == name, n)
    return taken.otherwise(0)


def keyword_budget(constraints: Column) -> Column:
    return F.aggregate(constraints, F.lit(0), lambda a, c: a + keywords_taken(c))


def rotate_keywords(constraints: Column, keywords: Column) -> Column:
    """For each constraint (id, n) the keywords it gets: the next ones in turn, from the first again after the last."""

    def words(c: Column, k: Column) -> Column:
        before = keyword_budget(F.slice(constraints, 1, k))
        places = F.filter(F.sequence(F.lit(0), F.greatest(keywords_taken(c), F.lit(1)) - 1), lambda j: j < keywords_taken(c))
        return F.transform(places, lambda j: F.get(keywords, (before + j) % F.size(keywords)))

    return F.when(F.size(keywords) > 0, F.transform(constraints, words)).otherwise(F.transform(constraints, lambda c: F.expr(NONE)))
