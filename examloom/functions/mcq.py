"""Multiple-choice question text: scrubbing, extraction, answer lines, subjects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.text import BREAKS, SPACE, json_string, let, one_break, strip

# The patterns and words that define the question format.
# (?d) makes "." stop only at a line feed. Every line is cut at its first answer
# label or hint; the look-ahead only lets the search skip other characters faster.
ANSWER_TEXT = (
    r"(?d)(?=[答正解])"
    r"(?:(?:答案|正確答案|解析|解釋)[:：]|正確為|正確選項|答案是|答案為).*"
)
ENGLISH_ANSWER = "the correct answer is"
MARK_SYMBOLS = "✓✔✗✘→←★⭐•＊*"
BRACKETED_VERDICT = r"(?id)\(.*?(正確|錯誤|correct|incorrect).*?\)"
TITLE_PREFIX = rf"^題目[:：]?[{SPACE}]*"
CONTENT_PREFIX = rf"(?d)^以下.*內容[:：][{SPACE}]*"
VERSION_PREFIX = rf"(?d)^這.*版本[{SPACE}]*"
TITLE_HEADER = rf"###[{SPACE}]*題目[{SPACE}]*"
NOISE_TOKENS = ("###", "```", "$")
ARROWS = r"←|→|<-|->"
OPTION_VERDICT = r"(?d)(正確|最佳選項|最合適).*"
LATEX_MOD = r"\pmod"
MOD_PLUS_ONE = (
    rf"(?U)\b([A-Za-z0-9_]+)[{SPACE}]*mod[{SPACE}]*([A-Za-z0-9_]+)[{SPACE}]*\+[{SPACE}]*1\b"
)
OPTION_KEYS = ("A", "B", "C", "D")
ANSWER_WORD = "答案"
EXPLAIN_WORD = "解析"
FLAT_FIELD = "資訊工程"
DEFAULT_SUBJECT = "資料結構"

# Searches over a whole text that act per line: a line starts after a line feed,
# white space and a title before its content are passed over.
_GAP = rf"[{SPACE}&&[^\n]]*+"
_LINE = f"(?md)^{_GAP}(?:題目[:：]?{_GAP})?+"
_ANSWER_LINE = f"(?md)^(?:{ANSWER_WORD}|{EXPLAIN_WORD}).*\\n?"


def _option(letters: str, strict: bool) -> str:
    """Pattern of the start of a line that opens one of the options ``letters``."""
    label = rf"(?:\([{letters}]\)|[{letters}][.)])" if strict else rf"\(?[{letters}]\)?[.)]?"
    return _LINE + label


def _drop(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, "")


def _drop_if(col: Column, needed: Column, pattern: str) -> Column:
    """``_drop`` for texts that hold what the pattern needs; others are passed on unsearched."""
    return F.when(needed, _drop(col, pattern)).otherwise(col)


def scrub_mcq(col: Column, strict: bool = False) -> Column:
    """Remove answers, hints, marks and headers from a question text.

    By default a bracketed verdict is removed from the first ``(`` of its line,
    which can take an option label with it; ``strict`` removes only brackets
    that hold no other bracket. Searches are made only in texts that hold a word the
    pattern cannot do without.
    """
    verdict = r"(?i)\([^()\n]*(正確|錯誤|correct|incorrect)[^()\n]*\)" if strict else BRACKETED_VERDICT

    def unlabelled(text: Column) -> Column:
        return let(_drop(text, ANSWER_TEXT), cut_english)

    def cut_english(text: Column) -> Column:
        return let(_drop_if(text, F.lower(text).contains(ENGLISH_ANSWER), f"(?id){ENGLISH_ANSWER}.*"), unmarked)

    def unmarked(text: Column) -> Column:
        out = text
        for mark in MARK_SYMBOLS:
            out = F.replace(out, F.lit(mark), F.lit(""))
        return let(out, unbracketed)

    def unbracketed(text: Column) -> Column:
        said = text.contains("正確") | text.contains("錯誤") | F.lower(text).contains("correct")
        return let(_drop_if(text, text.contains("(") & said, verdict), untitled)

    def untitled(text: Column) -> Column:
        return let(_drop_if(text, text.startswith("題目"), TITLE_PREFIX), unprefixed)

    def unprefixed(text: Column) -> Column:
        return let(_drop_if(text, text.startswith("以下"), CONTENT_PREFIX), unversioned)

    def unversioned(text: Column) -> Column:
        return let(_drop_if(text, text.startswith("這"), VERSION_PREFIX), headless)

    def headless(text: Column) -> Column:
        return _drop_if(text, text.contains("###"), TITLE_HEADER)

    out = let(col, unlabelled)
    for token in NOISE_TOKENS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return F.replace(out, F.lit(LATEX_MOD), F.lit("mod"))


def normalize_option(col: Column) -> Column:
    r"""``\pmod`` to ``mod`` and ``a mod b + 1`` to ``((a mod b) + 1)``."""
    plain = F.replace(col, F.lit(LATEX_MOD), F.lit("mod"))
    return F.regexp_replace(plain, MOD_PLUS_ONE, "(($1 mod $2) + 1)")


def _option_text(col: Column) -> Column:
    without_arrows = strip(_drop(strip(col), ARROWS))
    return normalize_option(strip(_drop(without_arrows, OPTION_VERDICT)))


def _stem(before_options: Column) -> Column:
    """Non-blank lines, stripped and without title, joined by one space."""
    content = F.filter(F.transform(F.split(before_options, "\n"), strip), lambda s: s != "")
    untitled = F.transform(
        content, lambda s: F.when(s.startswith("題目"), _drop(s, TITLE_PREFIX)).otherwise(s)
    )
    return _drop(strip(F.array_join(untitled, " ")), TITLE_PREFIX)


def extract_mcq(col: Column, strict: bool = False) -> Column:
    """Stem and four options of a scrubbed question.

    A line that starts like an option opens one; the first line per letter
    counts, lines before the first option form the stem. Missing options are
    empty. ``strict`` needs a bracket or punctuation after the letter.

    The first option is searched for in the text as a whole, the options in what
    follows; only the lines of the stem are taken apart.
    """

    def parts(text: Column) -> Column:
        before_options = F.split(text, _option("A-Da-d", strict), 2)[0]
        both = F.struct(
            before_options.alias("stem"),
            F.substring(text, F.length(before_options) + 1, F.length(text)).alias("rest"),
        )
        return let(both, questions)

    def questions(p: Column) -> Column:
        options = [
            _option_text(
                F.regexp_extract(p["rest"], f"{_option(key + key.lower(), strict)}{_GAP}(.*)", 1)
            ).alias(key)
            for key in OPTION_KEYS
        ]
        return F.struct(_stem(p["stem"]).alias("stem"), F.struct(*options).alias("options"))

    return let(one_break(col), parts)


def mcq_json(mcq: Column) -> Column:
    """The question struct as JSON text indented by two spaces."""

    def quoted(value: Column) -> Column:
        return json_string(F.coalesce(value, F.lit("")))

    body = [F.lit('{\n  "stem": '), quoted(mcq.stem), F.lit(',\n  "options": {\n')]
    for i, key in enumerate(OPTION_KEYS):
        body += [
            F.lit(f'    "{key}": '),
            quoted(mcq.options[key]),
            F.lit("\n" if i == len(OPTION_KEYS) - 1 else ",\n"),
        ]
    return F.concat(*body, F.lit("  }\n}"))


def _labelled_line(col: Column, word: str) -> Column:
    # The word is searched for first and then must be at the start of its line.
    line = F.regexp_extract(col, f"({word}(?<![^{BREAKS}]{word})[^{BREAKS}]*)", 1)
    text = strip(F.replace(line, F.lit(f"{word}："), F.lit("")))
    return F.when(line != "", text).otherwise(F.lit("N/A"))


def answer_line(col: Column) -> Column:
    """Text of the first line starting with the answer word, else ``N/A``."""
    return _labelled_line(col, ANSWER_WORD)


def explain_line(col: Column) -> Column:
    """Text of the first line starting with the explanation word, else ``N/A``."""
    return _labelled_line(col, EXPLAIN_WORD)


def strip_answer_lines(col: Column) -> Column:
    """Drop every line that starts with the answer or explanation word."""
    return strip(_drop(one_break(col), _ANSWER_LINE))


def subject_prefixed(topic: Column) -> Column:
    """Field name before ``" - "`` with the general field in front of it."""
    field = strip(F.split_part(topic, F.lit(" - "), F.lit(1)))
    return F.when(topic.contains(" - "), F.concat(F.lit(FLAT_FIELD), field)).otherwise(
        F.lit(FLAT_FIELD)
    )


def subject(topic: Column) -> Column:
    """Text before the first hyphen, trimmed; a default for an empty topic."""
    return F.when(F.coalesce(topic, F.lit("")) == "", F.lit(DEFAULT_SUBJECT)).otherwise(
        strip(F.split_part(topic, F.lit("-"), F.lit(1)))
    )
