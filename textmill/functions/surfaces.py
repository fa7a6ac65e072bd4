"""Wording of translation prompts by language."""

# Prompt styles with the mode of their answer, and the wording of each language.
STYLES = {
    "translate_into": "plain",
    "from_to": "plain",
    "translator_role": "plain",
    "strict_instructions": "plain",
    "minimal_output": "plain",
    "marked_text_only": "plain",
    "json_field_only": "plain",
    "json_object_output": "json_object",
    "json_object_meta_output": "json_object_meta",
    "json_object_source_output": "json_object_source",
    "xml_output": "xml_tag",
    "xml_meta_output": "xml_tag_meta",
    "yaml_output": "yaml_field",
    "yaml_meta_output": "yaml_field_meta",
    "yaml_source_output": "yaml_field_source",
    "json_string_output": "json_string",
}
NAMES = {"da": {"da": "dansk", "en": "engelsk"}, "en": {"da": "Danish", "en": "English"}}
WORDING = {
    "da": {
        "field": "tekst",
        "label": "Tekst",
        "suffix": "tekst",
        "arrow": "til",
        "reply_only": "Svar kun med oversættelsen.",
        "output_only": "Svar kun med den oversatte tekst.",
        "translate_into": "Oversæt denne tekst til {target_language}.",
        "from_to": "Fra {source_language} til {target_language}. Returner kun oversættelsen.",
        "translator_role": "Du oversætter tekst på {source_language} til {target_language}.",
        "translator_role_rule": "Returner kun oversættelsen. Medtag ikke en introduktion, forklaring, noter, alternativer, markdown-formatering eller citationstegn omkring svaret, medmindre citationstegnene hører til selve oversættelsen.",
        "strict_intro": "Oversæt følgende tekst fra {source_language} til {target_language}.",
        "strict_rule": "Returner kun den oversatte tekst. Ingen forklaring, noter, alternativer, markdown eller citationstegn omkring svaret, medmindre oversættelsen kræver det.",
        "marked_text_only": "Oversæt kun teksten inde i <translate_me>-taggene fra {source_language} til {target_language}. Ignorer al tekst uden for taggene. Returner kun oversættelsen.",
        "json_field_only": 'Oversæt kun værdien i feltet "tekst" fra {source_language} til {target_language}. Ignorer de andre felter. Returner kun den oversatte værdi.',
        "note_before": "Dokumentoversigt: kategori=oversættelse | prioritet=normal | reference=DA-2048",
        "note_after": "Intern journalnote: behold kun indholdet mellem taggene i svaret.",
        "payload": {"document_id": "da-2048", "domain": "forvaltning", "review_status": "klar til behandling", "comment": "bevar betydningen præcist"},
        "json_object_output": 'Returner et JSON-objekt med præcis én nøgle, "translation", og ingen anden tekst.',
        "json_object_meta_output": 'Returner et JSON-objekt med præcis nøglerne "source_language", "target_language" og "translation", og ingen anden tekst. Brug ISO-sprogkoder i language-felterne.',
        "json_object_source_output": 'Returner et JSON-objekt med præcis nøglerne "source_language", "target_language", "source_text" og "translation", og ingen anden tekst. Brug ISO-sprogkoder i language-felterne.',
        "xml_output": "Returner XML i formen <translation>...</translation> og intet andet.",
        "xml_meta_output": 'Returner XML i formen <translation source_language="..." target_language="...">...</translation> og intet andet. Brug ISO-sprogkoder i attributterne.',
        "yaml_output": "Returner YAML med præcis ét felt, translation: ..., og ingen anden tekst.",
        "yaml_meta_output": "Returner YAML med præcis felterne source_language, target_language og translation, og ingen anden tekst. Brug ISO-sprogkoder i language-felterne.",
        "yaml_source_output": "Returner YAML med præcis felterne source_language, target_language, source_text og translation, og ingen anden tekst. Brug ISO-sprogkoder i language-felterne.",
        "json_string_output": "Returner oversættelsen som en JSON-strengliteral og intet andet.",
    },
    "en": {
        "field": "text",
        "label": "Text",
        "suffix": "text",
        "arrow": "to",
        "reply_only": "Reply with the translation and nothing else.",
        "output_only": "Output only the translated text.",
        "translate_into": "Translate this text into {target_language}.",
        "from_to": "From {source_language} to {target_language}. Return only the translation.",
        "translator_role": "You are translating {source_language} text into {target_language}.",
        "translator_role_rule": "Return only the translation. Do not include an introduction, explanation, notes, alternatives, markdown formatting, or a quoted wrapper unless quotes are part of the translation.",
        "strict_intro": "Translate the following {source_language} text into {target_language}.",
        "strict_rule": "Only output the translated text. No explanation, notes, alternatives, markdown, or surrounding quotes unless the translation requires them.",
        "marked_text_only": "Translate only the text inside the <translate_me> tags from {source_language} to {target_language}. Ignore any text outside the tags. Return only the translation.",
        "json_field_only": 'Translate only the value of the "text" field from {source_language} to {target_language}. Ignore the other fields. Return only the translated value.',
        "note_before": "Document summary: category=translation | priority=normal | reference=EN-2048",
        "note_after": "Internal processing note: the answer should only use the tagged segment.",
        "payload": {"document_id": "en-2048", "domain": "public-administration", "review_status": "ready", "comment": "preserve meaning exactly"},
        "json_object_output": 'Return a JSON object with exactly one key, "translation", and no other text.',
        "json_object_meta_output": 'Return a JSON object with exactly the keys "source_language", "target_language", and "translation", and no other text. Use ISO language codes in the language fields.',
        "json_object_source_output": 'Return a JSON object with exactly the keys "source_language", "target_language", "source_text", and "translation", and no other text. Use ISO language codes in the language fields.',
        "xml_output": "Return XML in the form <translation>...</translation> and nothing else.",
        "xml_meta_output": 'Return XML in the form <translation source_language="..." target_language="...">...</translation> and nothing else. Use ISO language codes in the attributes.',
        "yaml_output": "Return YAML with exactly one field, translation: ..., and nothing else.",
        "yaml_meta_output": "Return YAML with exactly the fields source_language, target_language, and translation, and nothing else. Use ISO language codes in the language fields.",
        "yaml_source_output": "Return YAML with exactly the fields source_language, target_language, source_text, and translation, and nothing else. Use ISO language codes in the language fields.",
        "json_string_output": "Return the translation as a JSON string literal and nothing else.",
    },
}
