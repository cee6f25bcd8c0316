"""Prompt texts and transform signatures: constants of a run, made once."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How much of an article goes into the prompt unless ``transform.prompt_chars`` says
#: otherwise. Posts always keep the whole text.
PROMPT_CHARS = 4000

DEFAULT_TEMPLATE = """\
You edit news. Answer with one JSON object and nothing else. Its members:
"title": a factual headline in sentence case, at most 80 characters;
"category": one of these labels, spelled the same: {labels};
"date": the likely year and month of publication as YYYY-MM, between \
{win_start} and {win_end}, judged by the events, people and dates in the text.
Example: {{"title": "Storm closes two ports", "category": "{example_label}", \
"date": "{example_date}"}}
"""


def system_prompt(template: str | None, labels: list[str], start: str, end: str) -> str:
    """Fill the template; labels go in as they are, braces included."""
    return (template or DEFAULT_TEMPLATE).format(
        labels=", ".join(labels),
        win_start=start[:7],
        win_end=end[:7],
        example_label=labels[0],
        example_date=start[:7],
    )


def user_message(body: Column, chars: int = PROMPT_CHARS) -> Column:
    return F.concat(F.lit("Article:\n\n"), F.left(body, F.lit(chars)), F.lit("\n\nJSON:"))


def response_schema(labels: list[str]) -> dict:
    """The JSON schema an endpoint with structured output is asked to keep."""
    text = {"type": "string"}
    members = {
        "title": text,
        "category": {**text, "enum": list(labels)},
        "date": {**text, "pattern": r"^\d{4}-(0[1-9]|1[0-2])$"},
    }
    return {
        "type": "object",
        "properties": members,
        "required": list(members),
        "additionalProperties": False,
    }


def signature(**parts: object) -> str:
    """A short digest of everything that shapes a transform's output."""
    text = json.dumps(parts, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def source_identity(source: dict) -> str:
    """What tells one corpus from another, so that equal ids never share a cache entry."""
    names = ("type", "name", "config", "split", "path", "field_map")
    return json.dumps({name: source.get(name) for name in names}, sort_keys=True)


def json_text(value: Column) -> Column:
    """A string as JSON text in ASCII, the form that signatures are made of; null as null."""
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def letter(c: Column) -> Column:
        code = F.ascii(c)
        out = F.when((code >= 32) & (code <= 126), c).when(code < 65536, unit(code))
        far = code - 65536  # as a pair of surrogates
        out = out.otherwise(F.concat(unit(55296 + F.shiftright(far, 10)), unit(56320 + far.bitwiseAND(1023))))
        for known, written in short.items():
            out = F.when(code == known, F.lit(written)).otherwise(out)
        return out

    plain = ~value.rlike(r'[^ !#-\[\]-~]')
    escaped = F.when(plain, value).otherwise(F.array_join(F.transform(F.split(value, ""), letter), ""))
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("null"))


def json_object(**members: Column) -> Column:
    """Members that are JSON text already as an object, in the order of their names."""
    pairs = [F.concat(F.lit(f'"{name}": '), members[name]) for name in sorted(members)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def source_identity_of(**given: Column) -> Column:
    """``source_identity`` per row, of text columns (``type``, ``name``, ``path``, ...)."""
    names = ("type", "name", "config", "split", "path", "field_map")
    return json_object(**{n: json_text(given[n]) if n in given else F.lit("null") for n in names})


def signature_of(**parts: Column) -> Column:
    """``signature`` per row; the parts are JSON text."""
    return F.left(F.sha2(json_object(**parts), 256), F.lit(16))
