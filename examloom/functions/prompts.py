"""Prompt templates and candidate lists."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.text import is_json, raw_lines, strip

TOPIC_SLOT = "{topic}"
MIN_LINE_CHARS = 5


def render(template: Column, value: Column, slot: str = TOPIC_SLOT) -> Column:
    """``template`` with every ``slot`` replaced by ``value``, which is not re-expanded."""
    return F.replace(template, F.lit(slot), value)


def has_other_slots(template: Column, slot: str = TOPIC_SLOT) -> Column:
    """True when braces remain once ``slot`` is taken out: such a template is malformed."""
    return F.replace(template, F.lit(slot), F.lit("")).rlike(r"[{}]")


def fill(template: str, values: dict[str, Column]) -> Column:
    """A fixed template text with each ``{name}`` taken from ``values``.

    Unknown names stay as they are; inserted text is never expanded again.
    """
    pieces = re.split(r"\{(\w+)\}", template)
    out = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            if piece:
                out.append(F.lit(piece))
        elif piece in values:
            out.append(values[piece].cast("string"))
        else:
            out.append(F.lit("{" + piece + "}"))
    return F.concat(*out) if out else F.lit("")


def parse_candidates(text: Column) -> Column:
    """New templates in a model reply.

    A JSON array gives its non-blank strings; any other valid JSON gives none;
    text that is not JSON is read line by line, bullets and quotes removed,
    keeping lines longer than five characters.
    """
    reply = F.coalesce(text, F.lit(""))
    no_strings = F.array().cast("array<string>")
    bare = F.transform(
        raw_lines(reply),
        lambda line: F.btrim(
            F.ltrim(F.ltrim(strip(line), F.lit("- ")), F.lit("* ")), F.lit("\"'")
        ),
    )
    from_lines = F.filter(bare, lambda s: F.length(s) > MIN_LINE_CHARS)

    items = F.from_json(reply, "ARRAY<VARIANT>", {"allowSingleQuotes": "false"})
    strings = F.transform(
        F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"),
        lambda v: strip(F.try_variant_get(v, "$", "string")),
    )
    from_array = F.filter(strings, lambda s: s != "")
    is_array = strip(reply).startswith("[")
    return F.when(
        is_json(reply),
        F.when(is_array, F.coalesce(from_array, no_strings)).otherwise(no_strings),
    ).otherwise(from_lines)
