"""Prompt and target rendering of parallel texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .surfaces import NAMES, STYLES, WORDING


def xml_escape(text: Column) -> Column:
    out = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def json_string(text: Column) -> Column:
    """A JSON string literal; other than ASCII stays as it is."""
    out = text
    for raw, escape in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(escape))
    return F.concat(F.lit('"'), out, F.lit('"'))


def json_object(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys, spaced like a plain dump."""
    parts = [F.concat(F.lit(f'"{k}": '), json_string(fields[k])) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


@F.pandas_udf(StringType())
def yaml_text(fields: pd.DataFrame) -> pd.Series:
    """A struct of texts as a YAML mapping in key order; null fields are left out."""
    import yaml  # quoting and folding follow the text's own signs

    def dump(row: dict) -> str:
        return yaml.safe_dump({k: v for k, v in row.items() if v is not None}, allow_unicode=True, sort_keys=True).strip()

    return pd.Series([dump(r) for r in fields.to_dict("records")], dtype=object)


def target(mode: Column, text: Column, source: Column, source_lang: Column, target_lang: Column) -> Column:
    """The answer in its output mode: plain, JSON string or object, XML."""
    meta = {"source_language": source_lang, "target_language": target_lang, "translation": text}
    opening = F.concat(F.lit('<translation source_language="'), xml_escape(source_lang), F.lit('" target_language="'), xml_escape(target_lang), F.lit('">'))
    return (
        F.when(mode == "json_string", json_string(text))
        .when(mode == "json_object", json_object({"translation": text}))
        .when(mode == "json_object_meta", json_object(meta))
        .when(mode == "json_object_source", json_object(meta | {"source_text": source}))
        .when(mode == "xml_tag", F.concat(F.lit("<translation>"), xml_escape(text), F.lit("</translation>")))
        .when(mode == "xml_tag_meta", F.concat(opening, xml_escape(text), F.lit("</translation>")))
        .otherwise(text)
    )


def yaml_target(mode: Column, text: Column, source: Column, source_lang: Column, target_lang: Column) -> Column:
    """The answer in one of the YAML modes; null for any other mode. It runs Python, so apart from the rest."""
    meta = mode.isin("yaml_field_meta", "yaml_field_source")
    fields = {"source_language": F.when(meta, source_lang), "target_language": F.when(meta, target_lang), "source_text": F.when(mode == "yaml_field_source", source), "translation": text}
    return F.when(mode.startswith("yaml_"), yaml_text(F.struct(*[c.alias(k) for k, c in fields.items()])))


def _capital(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1000))


def _worded(lang: str, style: Column, source: Column, source_lang: Column, target_lang: Column) -> Column:
    """The task text in the wording of one language."""
    say = WORDING[lang]
    name = lambda code: F.coalesce(*[F.when(code == k, v) for k, v in NAMES[lang].items()], code)
    fill = lambda text: F.replace(F.replace(F.lit(text), F.lit("{source_language}"), name(source_lang)), F.lit("{target_language}"), name(target_lang))
    whole = lambda *parts: F.concat_ws("\n\n", *parts)
    block = F.concat(F.lit(f"{say['label']}:\n"), source)
    named = F.concat(_capital(name(source_lang)), F.lit(f" {say['suffix']}:\n"), source)
    marked = F.concat_ws("\n", F.lit(say["note_before"]), F.lit("<translate_me>"), source, F.lit("</translate_me>"), F.lit(say["note_after"]))
    payload = json_object({k: F.lit(v) for k, v in say["payload"].items()} | {say["field"]: source})
    short = F.concat(_capital(name(source_lang)), F.lit(f" {say['arrow']} "), _capital(name(target_lang)), F.lit("."))
    out = (
        F.when(style == "translate_into", whole(fill(say["translate_into"]), F.lit(say["reply_only"]), block))
        .when(style == "from_to", whole(fill(say["from_to"]), block))
        .when(style == "translator_role", whole(fill(say["translator_role"]), F.lit(say["translator_role_rule"]), named))
        .when(style == "strict_instructions", whole(fill(say["strict_intro"]), F.lit(say["strict_rule"]), named))
        .when(style == "minimal_output", whole(short, F.lit(say["output_only"]), source))
        .when(style == "marked_text_only", whole(fill(say["marked_text_only"]), marked))
        .when(style == "json_field_only", whole(fill(say["json_field_only"]), F.concat(F.lit("Payload:\n"), payload)))
    )
    for name_, mode in STYLES.items():
        if mode != "plain":
            out = out.when(style == name_, whole(fill(say["strict_intro"]), F.lit(say[name_]), named))
    return out


def prompt(style: Column, source: Column, source_lang: Column, target_lang: Column, prompt_lang: Column | None = None) -> Column:
    """The task text in one of the styles, worded in the prompt's language (else in English); sections are a blank line apart."""
    args = (style, source, source_lang, target_lang)
    if prompt_lang is None:
        return _worded("en", *args)
    return F.when(prompt_lang == "da", _worded("da", *args)).otherwise(_worded("en", *args))


def output_mode(style: Column) -> Column:
    """The mode in which a style asks for the answer."""
    return F.coalesce(*[F.when(style == name, mode) for name, mode in STYLES.items()])


def prompt_blocks(blocks: list[tuple[str | None, Column, bool]]) -> Column:
    """Ordered blocks (heading, array of lines, numbered) joined by blank lines."""
    out = []
    for heading, lines, numbered in blocks:
        body = F.array_join(F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)) if numbered else lines, "\n")
        out.append(F.concat(F.lit(f"{heading}\n"), body) if heading else body)
    return F.concat_ws("\n\n", *out)
