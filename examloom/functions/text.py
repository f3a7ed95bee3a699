"""Shared text helpers: whitespace, lines, token counts, keyed draws, log text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as whitespace, the same set as a regular
# expression class, and the line breaks (a carriage return and line feed is one).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BREAKS = "\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029"
RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
DIGIT = "[0-9０-９]"
STRICT = {"allowSingleQuotes": "false"}
# The same whitespace in the form that is fastest to search for its complement.
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace, including U+3000."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(col), F.lit("")) == ""


def raw_lines(col: Column) -> Column:
    """Split at every line break; a trailing break leaves an empty last element."""
    return F.split(col, LINE_BREAK)


def one_break(col: Column) -> Column:
    """Every line break written as a line feed, so that searches need only look for that."""

    def spelled(text: Column) -> Column:
        plain = F.replace(text, F.lit("\r\n"), F.lit("\n"))
        rare = F.translate(plain, RARE_BREAKS, "\n" * len(RARE_BREAKS))
        return F.when(text.rlike(f"[{RARE_BREAKS}]"), rare).otherwise(text)

    return let(col, spelled)


def ws_tokens(col: Column) -> Column:
    """Number of whitespace-separated tokens; null counts as 0."""
    return F.coalesce(F.regexp_count(col, F.lit(NOT_SPACE)), F.lit(0))


def to_int(digits: Column) -> Column:
    """Matched digits, ASCII or full-width, as INT; null if empty or too large."""
    return F.translate(digits, FULL_WIDTH_DIGITS, "0123456789").try_cast("int")


def keyed_hash(seed: int, purpose: str, *keys: Column) -> Column:
    """Hex digest of (seed, purpose, keys): the source of every random choice."""
    parts = [F.lit(str(seed)), F.lit(purpose), *(k.cast("string") for k in keys)]
    return F.md5(F.concat_ws("|", *parts))


def keyed_index(n: int | Column, seed: int, purpose: str, *keys: Column) -> Column:
    """Reproducible uniform index in ``0 .. n-1``; same value on every rerun."""
    first_32_bits = F.conv(F.substring(keyed_hash(seed, purpose, *keys), 1, 8), 16, 10)
    size = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(first_32_bits.cast("bigint"), size.cast("bigint"))


def is_json(col: Column) -> Column:
    """True when the text is exactly one strict JSON value; a repeated key is allowed.

    The text is read both as the one element of an array and as a field with
    another after it. A text that closes either wrapper by itself is refused by
    the other.
    """
    values = F.from_json(F.concat(F.lit("["), col, F.lit("]")), "ARRAY<STRING>", STRICT)
    return F.coalesce((F.size(values) == 1) & is_field(col), F.lit(False))


def is_field(col: Column) -> Column:
    """True when a JSON object with the text as a field and one more field is whole."""
    wrapped = F.concat(F.lit('{"value":'), col, F.lit(',"end":1}'))
    return F.from_json(wrapped, "value STRING, end INT", STRICT)["end"].eqNullSafe(1)


def checked_object(col: Column, schema: str) -> Column:
    """STRUCT<value, whole, fits>: a text read as one strict JSON object of ``schema``.

    ``whole`` tells whether the text is exactly one object, ``fits`` whether every
    field has the type the schema names; both are never null. The text is read in
    two wrappers, as ``is_json`` does, and the first gives the value as well.
    """
    wrapped = F.concat(F.lit('{"value":'), col, F.lit(',"end":1}'))
    found = F.from_json(
        wrapped,
        f"value STRUCT<{schema}>, end INT, _text STRING",
        STRICT | {"columnNameOfCorruptRecord": "_text"},
    )
    values = F.from_json(F.concat(F.lit("["), col, F.lit("]")), "ARRAY<STRING>", STRICT)

    def shape(p: Column) -> Column:
        whole = p["value"].isNotNull() & p["end"].eqNullSafe(1) & F.size(values).eqNullSafe(1)
        return F.struct(
            p["value"].alias("value"),
            F.coalesce(whole, F.lit(False)).alias("whole"),
            p["_text"].isNull().alias("fits"),
        )

    return let(found, shape)


def json_string(col: Column) -> Column:
    """A text as a quoted JSON string, non-ASCII kept; null becomes ``null``."""
    wrapped = F.to_json(F.struct(col.alias("v")))
    quoted = F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)
    return F.when(col.isNull(), F.lit("null")).otherwise(quoted)


# Fixed value: the tokens of JSON text: strings, marks, and everything between them.
JSON_TOKEN = r'"(?:[^"\\]|\\.)*+"|[{}\[\],:]|[^\s{}\[\],:"]+'


def json_indented(col: Column, spaces: int = 2) -> Column:
    """JSON text with one member or element a line, indented by its depth.

    The tokens are kept as they stand and only the space between them is made anew;
    objects and lists without members stay ``{}`` and ``[]``. One fold over the tokens
    that carries the text so far, the depth and whether something was just opened.
    """
    tokens = F.regexp_extract_all(col, F.lit(JSON_TOKEN), F.lit(0))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("depth"), F.lit(False).alias("fresh"))

    def line(depth: Column) -> Column:
        return F.concat(F.lit("\n"), F.repeat(F.lit(" " * spaces), depth))

    def add(s: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        before = F.when(closes, F.when(s["fresh"], F.lit("")).otherwise(line(depth))).when(
            s["fresh"], line(s["depth"])
        ).otherwise(F.lit(""))
        after = F.when(token == ",", line(depth)).when(token == ":", F.lit(" ")).otherwise(F.lit(""))
        return F.struct(
            F.concat(s["out"], before, token, after).alias("out"), depth.alias("depth"), opens.alias("fresh")
        )

    return F.aggregate(tokens, start, add, lambda s: s["out"])


def log_text(col: Column, max_chars: int | None = None) -> Column:
    r"""One-line log form: newline written as ``\n``; cut only at a named ``max_chars``."""
    line = F.replace(col, F.lit("\n"), F.lit("\\n"))
    return line if max_chars is None else F.substring(line, 1, max_chars)


def log_excerpt(col: Column, max_chars: int) -> Column:
    """Short log form: newline to space, first ``max_chars``, then ``...``."""
    return F.concat(
        F.substring(F.replace(col, F.lit("\n"), F.lit(" ")), 1, max_chars), F.lit("...")
    )


def model_name(path: Column) -> Column:
    """Last part of a model path, trailing slashes of either kind ignored."""
    return F.regexp_extract(F.rtrim(path, F.lit("/\\")), "([^/]*)$", 1)


def rate_str(rate: Column) -> Column:
    """A rate as ``12.3%``, one decimal, halves to even."""
    return F.concat(F.format_string("%.1f", F.bround(rate, 1)), F.lit("%"))
