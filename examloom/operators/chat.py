"""Chat-formatted training examples: messages, rendered text, completion span."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.functions.mcq import mcq_json
from examloom.functions.text import json_indented, let, ws_tokens
from examloom.schemas import CHAT_MESSAGES

# Chat markers, the default system turn and the token budget.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
RESPONSE_TEMPLATE = "<|im_start|>assistant"
TOOL_OPEN, TOOL_CLOSE = "\n<tool_response>\n", "\n</tool_response>"
MAX_TOKENS = 1024
PLAIN_ROLES = ("user", "assistant", "system")


def completion_text(df: DataFrame, column: str = "LLMans") -> Column:
    """The answer as text: a question struct as indented JSON, anything else as string."""
    dtype = dict(df.dtypes)[column]
    if dtype.startswith("struct"):
        return F.when(F.col(column).isNotNull(), mcq_json(F.col(column)))
    return F.col(column).cast("string")


def line_completion(line: Column, field: str = "LLMans") -> Column:
    """The answer in a JSON line as text, whatever its type there.

    An object becomes indented JSON with its members in their order, a text is taken as
    it is, other values as their JSON text; absent and null ones are empty.
    """
    value = F.get_json_object(line, f"$.{field}")
    is_object = F.from_json(line, f"`{field}` MAP<STRING, STRING>")[field].isNotNull()
    return F.coalesce(F.when(is_object, json_indented(value)).otherwise(value), F.lit(""))


def messages_of_lines(lines: DataFrame, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """``messages`` of every example in JSON ``lines(value)``; answers may be objects or texts.

    A list of at least two messages passes through; otherwise the two turns are built
    from ``question`` and ``LLMans``. Narrow, and each line by itself, so one file may
    mix all forms.
    """
    line = F.col("value")
    found = F.from_json(line, f"messages {CHAT_MESSAGES}, question STRING")
    read = lines.select(*keep_cols, found.alias("_r"), line_completion(line).alias("LLMans"))
    return to_messages(read.select(*keep_cols, "_r.*", "LLMans"), keep_cols)


def to_messages(df: DataFrame, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """``messages`` of every example, all other columns dropped.

    A list of at least two messages passes through; otherwise the two turns are
    built from ``question`` and ``LLMans``. Narrow: only these columns are read.
    """
    columns = df.columns

    def text_or_empty(name: str, value: Column) -> Column:
        return F.coalesce(value, F.lit("")) if name in columns else F.lit("")

    question = text_or_empty("question", F.col("question"))
    answer = text_or_empty("LLMans", completion_text(df)) if "LLMans" in columns else F.lit("")
    built = F.array(
        F.struct(F.lit("user").alias("role"), question.alias("content")),
        F.struct(F.lit("assistant").alias("role"), answer.alias("content")),
    ).cast(CHAT_MESSAGES)
    if "messages" in columns:
        given = F.col("messages").cast(CHAT_MESSAGES)
        built = F.when(F.size("messages") >= 2, given).otherwise(built)
    return df.select(*keep_cols, built.alias("messages"))


def chat_text(messages: Column, add_generation_prompt: bool = False) -> Column:
    """Messages as one chat text, led by a system turn.

    A first system message is that turn, else the default line is. Runs of tool
    messages share one user turn; other roles are not rendered.
    """

    def render(ms: Column) -> Column:
        roles = F.transform(ms, lambda m: m.role)

        def role_at(i: Column) -> Column:
            return F.coalesce(F.get(roles, i), F.lit(""))

        def turn(m: Column, i: Column) -> Column:
            content = F.coalesce(m.content, F.lit(""))
            plain = F.concat(F.lit(TURN_START), m.role, F.lit("\n"), content, F.lit(TURN_END))
            tool = F.concat(
                F.when(role_at(i - 1) != "tool", F.lit(TURN_START + "user")).otherwise(F.lit("")),
                F.lit(TOOL_OPEN),
                content,
                F.lit(TOOL_CLOSE),
                F.when(role_at(i + 1) != "tool", F.lit(TURN_END)).otherwise(F.lit("")),
            )
            return F.when(m.role.isin(*PLAIN_ROLES), plain).when(m.role == "tool", tool).otherwise(
                F.lit("")
            )

        default = F.lit(f"{TURN_START}system\n{DEFAULT_SYSTEM}{TURN_END}")
        head = F.when(role_at(F.lit(0)) == "system", F.lit("")).otherwise(default)
        tail = F.lit(f"{TURN_START}assistant\n" if add_generation_prompt else "")
        return F.concat(head, F.array_join(F.transform(ms, turn), ""), tail)

    return let(messages, render)


def render_chat(df: DataFrame, add_generation_prompt: bool = False) -> DataFrame:
    """Add ``text``, the rendered ``messages``."""
    return df.withColumn("text", chat_text(F.col("messages"), add_generation_prompt))


def completion_span(df: DataFrame, marker: str = RESPONSE_TEMPLATE) -> DataFrame:
    """Add the part of ``text`` that counts in training: all after the last marker.

    ``start`` is the 1-based character position of the completion and ``length``
    its size; without a marker nothing counts.
    """
    has_marker = F.col("text").contains(marker)
    completion = F.when(
        has_marker, F.substring_index("text", marker, -1)
    ).otherwise(F.lit(""))
    return (
        df.withColumn("completion_text", completion)
        .withColumn("length", F.length("completion_text"))
        .withColumn("start", F.length("text") - F.col("length") + 1)
        .withColumn("prompt_text", F.substring(F.col("text"), F.lit(1), F.col("start") - 1))
    )


def flag_over_budget(
    df: DataFrame,
    max_tokens: int = MAX_TOKENS,
    counter: Callable[[Column], Column] = ws_tokens,
    text_col: str = "text",
) -> DataFrame:
    """Add ``n_tokens`` and ``over_budget``; nothing is cut. ``counter`` may be a pandas UDF."""
    return df.withColumn("n_tokens", counter(F.col(text_col))).withColumn(
        "over_budget", F.col("n_tokens") > max_tokens
    )
