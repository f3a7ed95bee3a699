"""Parsers for judge and reviewer replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.text import BREAKS, DIGIT, SPACE, STRICT, is_field, let, to_int

# Reply patterns, markers and default reasons.
# A line score is the first one of its line: the rest of the line is passed over.
SCORE = rf"(?i)Score[:{SPACE}]*({DIGIT}+)"
LINE_SCORE = rf"(?i)Score[:{SPACE}&&[^{BREAKS}]]*({DIGIT}+)[^{BREAKS}]*"
MULTI_SCORE = rf"(?i)Model[{SPACE}]*({DIGIT}+)[{SPACE}:]*Score?[{SPACE}:：-]*({DIGIT}+)"
FINAL_RATINGS = "Final Ratings:"
WINNER_N = rf"(?i)Winner:[{SPACE}]*(Model[{SPACE}]*{DIGIT}+)"
SPACED_LABEL = rf"(?i)^Model[{SPACE}]+({DIGIT}+)$"
JSON_OBJECT = r"(?s)(\{.*\})"
PARSE_FAILED = "JSON parse failed"
GATE_FAILED = "審查模型錯誤"
UNSCORED = -1
MIN_SCORE, MAX_SCORE = 1, 10
UNKNOWN_LABEL = -1


def json_slice(reply: Column) -> Column:
    """Text from the first ``{`` to the last ``}``; empty when there is none."""
    return F.regexp_extract(reply, JSON_OBJECT, 1)


def parse_object(reply: Column, fields: str) -> Column:
    """The one JSON object in ``reply`` as a struct, null unless it is strict JSON.

    The slice is parsed as a one-element array and must also stand as a field
    of an object, so single quotes, text after the object, a second object and
    a slice that closes a wrapper itself are all refused.
    """

    def parse(text: Column) -> Column:
        parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"ARRAY<STRUCT<{fields}>>", STRICT)
        one = lambda p: F.when((F.size(p) == 1) & is_field(text), F.try_element_at(p, F.lit(1)))
        return let(parsed, one)

    return let(json_slice(reply), parse)


def truthy(value: Column) -> Column:
    """Truth of a VARIANT: empty, zero, false and null are false."""
    as_text = F.try_variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", as_text != "")
        .when(kind.startswith("ARRAY"), as_text != "[]")
        .when(kind.startswith("OBJECT"), as_text != "{}")
        .otherwise(F.try_variant_get(value, "$", "double") != 0.0),
        F.lit(False),
    )


def parse_verdict_json(
    reply: Column, mode: str = "strict", failed_reason: str = PARSE_FAILED
) -> Column:
    """STRUCT<keep, reason, ok> of a reviewer reply.

    ``strict`` keeps only on JSON ``true``; ``truthy`` also on any other value
    that counts as true. A reply that does not parse is not kept and carries
    ``failed_reason``.
    """
    if mode not in ("strict", "truthy"):
        raise ValueError(f"unknown mode {mode!r}")
    keep_type = "VARIANT" if mode == "truthy" else "BOOLEAN"
    parsed = parse_object(reply, f"keep: {keep_type}, reason: STRING")

    def shape(p: Column) -> Column:
        ok = p.isNotNull()
        keep = truthy(p.keep) if mode == "truthy" else F.coalesce(p.keep, F.lit(False))
        return F.struct(
            (ok & keep).alias("keep"),
            F.when(ok, F.coalesce(p.reason, F.lit("")))
            .otherwise(F.lit(failed_reason))
            .alias("reason"),
            ok.alias("ok"),
        )

    return let(parsed, shape)


def _valid_score(digits: Column) -> Column:
    value = to_int(digits)
    return F.when(value.between(MIN_SCORE, MAX_SCORE), value).otherwise(F.lit(UNSCORED))


def parse_score(reply: Column) -> Column:
    """First ``Score`` number if it lies in 1..10, else -1."""
    return _valid_score(F.regexp_extract(reply, SCORE, 1))


def parse_two_scores(reply: Column) -> Column:
    """STRUCT<a, b>: the first two valid line scores in order, -1 where missing."""
    per_line = F.regexp_extract_all(reply, F.lit(LINE_SCORE), 1)
    valid = F.filter(F.transform(per_line, _valid_score), lambda s: s != UNSCORED)
    return let(
        valid,
        lambda v: F.struct(
            F.coalesce(F.try_element_at(v, F.lit(1)), F.lit(UNSCORED)).alias("a"),
            F.coalesce(F.try_element_at(v, F.lit(2)), F.lit(UNSCORED)).alias("b"),
        ),
    )


def parse_multi_scores(reply: Column, n_models: int) -> Column:
    """MAP<label, score> for labels 1..n found after the last ratings marker.

    The last score of a label wins; values are taken as they are.
    """
    area = F.element_at(F.split(reply, FINAL_RATINGS), -1)

    def collect(text: Column) -> Column:
        found = F.arrays_zip(
            F.transform(F.regexp_extract_all(text, F.lit(MULTI_SCORE), 1), to_int).alias("label"),
            F.transform(F.regexp_extract_all(text, F.lit(MULTI_SCORE), 2), to_int).alias("score"),
        )

        def last_per_label(pairs: Column) -> Column:
            entries = F.transform(
                F.sequence(F.lit(1), F.lit(n_models)),
                lambda i: F.struct(
                    i.alias("label"),
                    F.try_element_at(F.filter(pairs, lambda p: p["label"] == i), F.lit(-1))[
                        "score"
                    ].alias("score"),
                ),
            )
            return F.map_from_entries(F.filter(entries, lambda e: e.score.isNotNull()))

        return let(found, last_per_label)

    return let(area, collect)


def parse_winner_n(reply: Column) -> Column:
    """Label number of the first ``Winner: Model k``.

    Null when no winner line is found, -1 when the label is written without a
    space and so names no known model.
    """

    def number(label: Column) -> Column:
        spaced = to_int(F.regexp_extract(label, SPACED_LABEL, 1))
        return F.when(label != "", F.coalesce(spaced, F.lit(UNKNOWN_LABEL)))

    return let(F.regexp_extract(reply, WINNER_N, 1), number)


def parse_winner_ab(reply: Column) -> Column:
    """``A``, ``B`` or ``Tie``; A is looked for first, no verdict is a tie."""
    return (
        F.when(reply.contains("Winner: A"), F.lit("A"))
        .when(reply.contains("Winner: B"), F.lit("B"))
        .otherwise(F.lit("Tie"))
    )


def unswapped(a_is_x: Column, if_a: Column, if_b: Column) -> Column:
    """Value of arm x: the A side when x was shown as A, else the B side."""
    return F.when(a_is_x, if_a).otherwise(if_b)
