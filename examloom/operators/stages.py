"""Model stages as Spark batch jobs: one client per task, failures as data.

Only the prompt travels to Python; all other columns stay in the JVM. A stage
costs money, so every stage is written before anything reads it, and a rerun
calls the client only for rows that have no stored reply.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from itertools import groupby
from operator import and_
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from examloom.functions.prompts import fill
from examloom.functions.text import is_blank
from examloom.operators.cleaning import resolve_review
from examloom.functions.verdicts import parse_verdict_json
from examloom.session import fresh_path

# Stage names and how the prompt of each stage is put together.
GENERATE_PROMPT = "{prompt}\n\n格式要求：\n{generator_rules}\n請根據主題「{topic}」出一題。"
COMMENT_PROMPT = "{comment_rules}\n\n題目如下：\n{generator_text}"
REFINE_PROMPT = (
    "{refine_rules}\n\n【原題目】\n{generator_text}\n\n【建議】\n{comment_text}\n"
)
BEAUTIFY_PROMPT = "{beautify_rules}\n{refine_text}"
REVIEW_PROMPT = "{review_rules}\n{beautify_text}"
FLAT_GENERATE_PROMPT = "{generate_rules}\n請根據主題「{topic}」出一題。"
EMPTY_QUESTION = "題目（回傳空白）請出與 {topic} 有關的題目。"

ON_ERROR = ("raise", "error_row", "blank", "passthrough")
REPLY = "text STRING, out_tokens INT, in_tokens INT, latency_s DOUBLE, error STRING, again BOOLEAN"
REPLY_TYPE = pa.struct(
    [("text", pa.string()), ("out_tokens", pa.int32()), ("in_tokens", pa.int32()),
     ("latency_s", pa.float64()), ("error", pa.string()), ("again", pa.bool_())]
)
PIECE_BYTES = 4 << 20  # of prompts that a task has as Python strings at a time


class TryAgain(Exception):
    """A client's error that a later call may not meet: an overloaded or restarting server."""


class Reply(NamedTuple):
    """A client's answer; token counts are optional."""

    text: str | None
    out_tokens: int | None = None
    in_tokens: int | None = None


#: A client answers one prompt, or has ``ask_many`` for a list of them, in whose result
#: an exception stands for a row that failed.
Client = Callable[[str], "Reply | str | None"]


@dataclass(frozen=True)
class Stage:
    """One step of a chain.

    ``prompt`` is a text with column names in braces. ``passthrough`` names the
    column used when ``on_error`` is ``passthrough``; ``if_empty`` is a text
    with column names used when the reply is empty. Errors of the kinds ``retry_on``
    are asked again, ``tries`` times in all with ``wait_s`` between rounds; any other
    error costs one call. ``batch`` prompts go into one call of a client that has
    ``ask_many``, and a task has at most ``in_flight`` calls open.
    """

    name: str
    prompt: str
    on_error: str = "error_row"
    tries: int = 1
    wait_s: float = 0.0
    retry_on: tuple[type[BaseException], ...] = ()
    passthrough: str | None = None
    if_empty: str | None = None
    strip_reply: bool = True
    batch: int = 64
    in_flight: int = 1

    def __post_init__(self):
        if not self.retry_on:
            object.__setattr__(self, "retry_on", (TryAgain, ConnectionError, TimeoutError))


RICH_CHAIN = (
    Stage("generator", GENERATE_PROMPT, tries=3, wait_s=10.0, if_empty=EMPTY_QUESTION),
    Stage("comment", COMMENT_PROMPT, tries=3, wait_s=10.0),
    Stage("refine", REFINE_PROMPT, tries=3, wait_s=10.0),
    Stage("beautify", BEAUTIFY_PROMPT, tries=3, wait_s=10.0),
    Stage("review", REVIEW_PROMPT, tries=3, wait_s=10.0),
)

FLAT_CHAIN = (
    Stage(
        "generate", FLAT_GENERATE_PROMPT, on_error="blank", tries=5, wait_s=1.0,
        if_empty=EMPTY_QUESTION, strip_reply=False, retry_on=(Exception,),
    ),
    Stage(
        "beautify", "{beautify_rules}\n{generate_text}", on_error="passthrough",
        passthrough="generate_text",
    ),
    Stage("review", "{review_rules}\n{beautify_text}"),
    Stage(
        "fix", "{fix_rules}\n{final_question}", on_error="passthrough",
        passthrough="final_question",
    ),
)


NO_PROMPT = "no prompt"
DIGEST = "_digest"  # of the prompt that a stored reply answers
SLICE_ROWS = 20_000  # rows whose replies are committed together


Answer = tuple["Reply | str | None", "Exception | None", float]


def _one(client: Client, prompt: str) -> Answer:
    started = time.perf_counter()
    try:
        answer, error = client(prompt), None
    except Exception as exc:
        answer, error = None, exc
    return answer, error, time.perf_counter() - started


def _many(client, prompts: list[str]) -> list[Answer]:
    """One call for all prompts; an exception in a place of the result is that row's error."""
    started = time.perf_counter()
    try:
        found = list(client.ask_many(prompts))
        if len(found) != len(prompts):
            raise ValueError(f"{len(found)} replies to {len(prompts)} prompts")
    except Exception as exc:
        found = [exc] * len(prompts)
    spent = time.perf_counter() - started
    return [(None, x, spent) if isinstance(x, Exception) else (x, None, spent) for x in found]


def _answers(client, prompts: list[str], stage: Stage) -> list[Answer]:
    """An answer for each prompt, in their order, with at most ``stage.in_flight`` calls at a time."""
    if hasattr(client, "ask_many"):
        size = max(stage.batch, 1)
        calls = [prompts[k : k + size] for k in range(0, len(prompts), size)]
        ask = lambda part: _many(client, part)
    else:
        calls, ask = prompts, lambda prompt: [_one(client, prompt)]
    if stage.in_flight > 1 and len(calls) > 1:
        with ThreadPoolExecutor(stage.in_flight) as pool:
            found = list(pool.map(ask, calls))
    else:
        found = map(ask, calls)
    return [answer for part in found for answer in part]


def _reply_row(prompt: str, answer: Answer, stage: Stage) -> dict[str, object]:
    given, error, spent = answer
    reply = given if isinstance(given, Reply) else Reply(given)
    text = (reply.text or "") if error is None else None
    if text is not None and stage.strip_reply:
        text = text.strip()
    counted = len(text.split()) if text is not None else None
    return {
        "text": text,
        "out_tokens": counted if reply.out_tokens is None else int(reply.out_tokens),
        "in_tokens": len(prompt.split()) if reply.in_tokens is None else int(reply.in_tokens),
        "latency_s": spent,
        "error": None if error is None else str(error),
        "again": isinstance(error, stage.retry_on),
    }


def ask_all(client, prompts: list[str], stage: Stage) -> list[dict[str, object]]:
    """Replies in the order of the prompts; errors are text unless they must be raised.

    Rows whose error is one of ``stage.retry_on`` are asked again together, after one
    wait a round, up to ``stage.tries`` times; other errors are final at once.
    """
    rows: list = [None] * len(prompts)
    open_rows = list(range(len(prompts)))
    for attempt in range(1, stage.tries + 1):
        answers = _answers(client, [prompts[k] for k in open_rows], stage)
        for k, answer in zip(open_rows, answers):
            spent = rows[k]["latency_s"] if rows[k] else 0.0
            rows[k] = _reply_row(prompts[k], answer, stage)
            rows[k]["latency_s"] += spent
            if answer[1] is not None and stage.on_error == "raise":
                if attempt == stage.tries or not rows[k]["again"]:
                    raise answer[1]
        open_rows = [k for k in open_rows if rows[k]["again"]]
        if not open_rows or attempt == stage.tries:
            break
        time.sleep(stage.wait_s)
    return rows


def call_once(client, prompt: str, stage: Stage) -> dict[str, object]:
    """``ask_all`` for one prompt."""
    return ask_all(client, [prompt], stage)[0]


def _pieces(batch: tuple[pa.Array, ...]) -> Iterator[tuple[list, ...]]:
    """The rows of a batch as lists, ``PIECE_BYTES`` of its last column at a time, one row at least.

    Texts stay Arrow bytes until their piece is asked for, so a task holds Python
    strings and replies of one piece only, however many or long the rows of a batch are.
    """
    sizes = pc.fill_null(pc.binary_length(batch[-1]), 0).to_pylist()
    first = 0
    while first < len(sizes):
        last, room = first, 0
        while last < len(sizes) and (last == first or room + sizes[last] <= PIECE_BYTES):
            room += sizes[last]
            last += 1
        yield tuple(column.slice(first, last - first).to_pylist() for column in batch)
        first = last


def _reply_udf(stage: Stage, factory: Callable[[str], Client], warm_up: bool) -> Callable:
    """Arrow UDF (model, prompt) -> reply; keeps the client of the current model only."""

    @F.arrow_udf(REPLY)
    def replies(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model, client = None, None
        for names, prompts in (piece for batch in batches for piece in _pieces(batch)):
            rows = [dict.fromkeys(REPLY_TYPE.names) | {"error": NO_PROMPT, "again": False} for _ in prompts]
            asked = [k for k, prompt in enumerate(prompts) if prompt is not None]
            for name, group in groupby(asked, key=lambda k: names[k]):
                places = list(group)
                if client is None or name != model:
                    client, model = None, name
                    client = factory(name)
                texts = [prompts[k] for k in places]
                if warm_up:
                    ask_all(client, texts, stage)
                for k, row in zip(places, ask_all(client, texts, stage)):
                    rows[k] = row
            yield pa.array(rows, REPLY_TYPE)

    return replies.asNondeterministic()


def stage_prompt(df: DataFrame, stage: Stage, rules: dict[str, str] | None = None) -> Column:
    """The prompt of each row; null for rows that failed in an earlier stage."""
    prompt = fill(stage.prompt, _named_values(df, rules))
    return F.when(F.col("_error").isNull(), prompt) if "_error" in df.columns else prompt


def _named_values(df: DataFrame, rules: dict[str, str] | None) -> dict[str, Column]:
    values = {c: F.col(c) for c in df.columns if not c.startswith("_")}
    return values | {k: F.lit(text) for k, text in (rules or {}).items()}


def apply_stage(
    df: DataFrame,
    stage: Stage,
    client_factory: Callable[[], Client],
    rules: dict[str, str] | None = None,
    timed: bool = False,
    warm_up: bool = False,
    kinds: bool = False,
) -> DataFrame:
    """Add ``<name>_text``, ``_in``, ``_out`` and ``_error`` (``_latency_s`` if timed).

    Rows that carry an ``_error`` from an earlier stage are not sent. ``rules``
    gives fixed texts for names in the prompt. ``warm_up`` asks every prompt
    once untimed before the timed call. ``kinds`` adds ``<name>_again``: is the
    error one to try again? The result is lazy; write it before using it twice.
    """
    if stage.on_error not in ON_ERROR:
        raise ValueError(f"unknown on_error {stage.on_error!r}")
    ask = _reply_udf(stage, lambda _name: client_factory(), warm_up)
    called = df.withColumn("_reply", ask(F.lit(""), stage_prompt(df, stage, rules)))
    if kinds:
        called = called.withColumn(f"{stage.name}_again", F.col("_reply.again"))
    return _shape_reply(called, stage, _named_values(df, rules), timed)


def timed_arms(
    tasks: DataFrame, arms: dict[str, Callable[[], Client]], prompt_col: str = "prompt",
    stage: Stage = Stage("timed", ""),
) -> DataFrame:
    """Every prompt answered by each arm in turn: adds ``<arm>_text``, ``_latency_s`` and ``_error``.

    A task opens each client once and sends it its first prompt untimed; then each row is
    asked of all arms, one after the other in the same task, so that both times of a
    round come from the same machine and moment. A failed call has no text and no time.
    """
    fields = ", ".join(f"`{a}_text` STRING, `{a}_latency_s` DOUBLE, `{a}_error` STRING" for a in arms)

    kind = pa.struct([
        (f"{a}_{c}", pa.float64() if c == "latency_s" else pa.string())
        for a in arms for c in ("text", "latency_s", "error")
    ])

    @F.arrow_udf(fields)
    def timed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        clients: dict = {}
        for (prompts,) in (piece for batch in batches for piece in _pieces((batch,))):
            out = []
            for prompt in prompts:
                made = {}
                for arm, factory in arms.items():
                    row = {"text": None, "latency_s": None, "error": NO_PROMPT}
                    if prompt is not None:
                        if arm not in clients:
                            clients[arm] = factory()
                            call_once(clients[arm], prompt, stage)
                        row = call_once(clients[arm], prompt, stage)
                    if row["error"] is not None:
                        row["latency_s"] = None
                    made |= {f"{arm}_{c}": row[c] for c in ("text", "latency_s", "error")}
                out.append(made)
            yield pa.array(out, kind)

    return tasks.withColumn("_timed", timed.asNondeterministic()(F.col(prompt_col))).select(
        *tasks.columns, "_timed.*"
    )


def _shape_reply(
    called: DataFrame, stage: Stage, values: dict[str, Column], timed: bool
) -> DataFrame:
    text = F.col("_reply.text")
    if "_error" in called.columns:  # rows that failed before were not asked
        fresh = F.when(F.col("_error").isNull(), F.col("_reply.error"))
        called = called.withColumn("_reply", F.col("_reply").withField("error", fresh))
    failed = F.col("_reply.error").isNotNull()
    if stage.on_error == "passthrough":
        text = F.when(failed, F.col(stage.passthrough)).otherwise(text)
    elif stage.on_error == "blank":
        text = F.when(failed, F.lit("")).otherwise(text)
    if stage.if_empty is not None:
        text = F.when(is_blank(text), fill(stage.if_empty, values)).otherwise(text)
    out = (
        called.withColumn(f"{stage.name}_text", text)
        .withColumn(f"{stage.name}_in", F.col("_reply.in_tokens"))
        .withColumn(f"{stage.name}_out", F.col("_reply.out_tokens"))
        .withColumn(f"{stage.name}_error", F.col("_reply.error"))
    )
    if timed:
        out = out.withColumn(f"{stage.name}_latency_s", F.col("_reply.latency_s"))
    if stage.on_error == "error_row":
        earlier = F.col("_error") if "_error" in called.columns else F.lit(None).cast("string")
        out = out.withColumn("_error", F.coalesce(earlier, F.col("_reply.error")))
    return out.drop("_reply")


def replay_stage(df: DataFrame, stage: Stage, replies: DataFrame, key: str) -> DataFrame:
    """``apply_stage`` with stored replies (key, text, in_tokens, out_tokens, error).

    An equi-join on the row key; a row without a stored reply is an error row.
    """
    values = {c: F.col(c) for c in df.columns if not c.startswith("_")}
    stored = replies.select(
        key, F.struct("text", "in_tokens", "out_tokens", "error").alias("_stored")
    )
    joined = df.join(stored, key, "left").withColumn(
        "_reply",
        F.coalesce(
            "_stored",
            F.struct(
                F.lit(None).cast("string").alias("text"),
                F.lit(None).cast("int").alias("in_tokens"),
                F.lit(None).cast("int").alias("out_tokens"),
                F.lit("no stored reply").alias("error"),
            ),
        ),
    )
    return _shape_reply(joined.drop("_stored"), stage, values, timed=False)


def _store(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if there is none yet; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _held(rows: DataFrame, slice_rows: int) -> DataFrame:
    """``rows`` written once, in files of which as many make a slice as tasks run at a time.

    A slice that names more files costs more to list, open and write, and keeps no more tasks busy.
    """
    path = fresh_path(rows.sparkSession, "calls")
    per_file = max(slice_rows // rows.sparkSession.sparkContext.defaultParallelism, 1)
    rows.write.option("maxRecordsPerFile", per_file).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _slices(held: DataFrame, slice_rows: int) -> Iterator[DataFrame]:
    """The rows of ``_held`` in parts of at most ``slice_rows``, by their files.

    The driver sees one count for each file.
    """
    name = F.col("_metadata.file_path")
    sizes = sorted(tuple(r) for r in held.groupBy(name.alias("file")).count().collect())
    group, n = [], 0
    for file, count in [*sizes, (None, slice_rows + 1)]:
        if group and n + count > slice_rows:
            yield held.sparkSession.read.schema(held.schema).parquet(*group)
            group, n = [], 0
        group.append(file)
        n += count


def _commit_each(
    spark: SparkSession, slices: Iterator[DataFrame], step: Callable[[DataFrame], DataFrame], commit: Callable
) -> None:
    """``commit`` of every slice that went through ``step``, one at a time and in order.

    The next slice is planned while one is worked on. An error of either is raised
    once the slice in work has ended, and no further one begins.
    """
    with ThreadPoolExecutor(1) as pool:
        running = None
        for rows in slices:
            made = step(rows)
            if running is not None:
                running.result()
            running = pool.submit(inheritable_thread_target(spark)(commit), made)
        if running is not None:
            running.result()


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys])


def stored_once(
    todo: DataFrame,
    key: str | list[str],
    path: str,
    step: Callable[[DataFrame], DataFrame],
    failed: Column | None = None,
    prompt: Column | None = None,
    again: Column | None = None,
    rounds: int = 1,
    wait_s: float = 0.0,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``todo`` with the columns that ``step`` adds, made once for each key and prompt and stored.

    The store at ``path`` holds the key, a digest of the ``prompt`` and the added columns
    only. ``todo`` is computed and written once; its rows are worked on in slices of at
    most ``slice_rows``, one after the other, each committed alone, so an interrupted run
    loses the calls of one slice at most, however long the job. A later call runs ``step`` for rows whose
    key and prompt have no stored row, and for those whose row is ``failed``: a changed
    prompt is asked anew, its old reply stays in the store and is not used. Rows that are
    failed and ``again`` are asked in up to ``rounds - 1`` further rounds of this call,
    each after ``wait_s`` seconds, in which no task waits. Of several stored rows of a key
    and prompt the one that did not fail counts, else the newest; rows of ``todo`` that
    repeat a key and prompt are asked each and get the same one. ``step`` must pass the
    column ``_digest`` on.
    """
    spark = todo.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    marks = [*keys, DIGEST]
    digest = F.lit("") if prompt is None else F.coalesce(F.sha2(prompt, 256), F.lit(""))
    held = _held(todo.withColumn(DIGEST, digest), slice_rows)
    before = _store(spark, path)
    attempt, pending = 0, held
    if before is not None:
        attempt = (before.agg(F.max("_attempt")).first()[0] or 0) + 1
        settled = (before if failed is None else before.where(~failed)).select(*marks)
        pending = _held(held.join(settled, _same(held, settled, marks), "left_anti"), slice_rows)
    for left in range(rounds, 0, -1):

        def commit(made: DataFrame, attempt: int = attempt) -> None:
            added = [c for c in made.columns if c not in todo.columns or c == "_error"]
            stored = [*keys, *[c for c in added if c != DIGEST]]
            own = made.select(*stored, DIGEST, F.lit(attempt).alias("_attempt"))
            own.write.mode("append").parquet(path)

        _commit_each(spark, _slices(pending, slice_rows), step, commit)
        if left == 1 or again is None or failed is None:
            break
        found = _store(spark, path)
        open_rows = None if found is None else found.where((F.col("_attempt") == attempt) & failed & again)
        if open_rows is None or open_rows.isEmpty():
            break
        open_rows = open_rows.select(*marks).distinct()
        pending = _held(held.join(open_rows, _same(held, open_rows, marks), "left_semi"), slice_rows)
        attempt += 1
        time.sleep(wait_s)
    stored = _store(spark, path)
    if stored is None:  # nothing to do, ever
        empty = step(held.limit(0))
        return empty.drop(DIGEST)
    names = [c for c in stored.columns if c not in (*marks, "_attempt")]
    whole = F.lit(True) if failed is None else ~failed
    best = stored.groupBy(*marks).agg(
        F.max_by(F.struct(*names), F.struct(whole, "_attempt")).alias("_made")
    )
    kept = [held[c] for c in todo.columns if c not in names]
    return held.join(best, _same(held, best, marks)).select(*kept, "_made.*")


def run_stages(
    tasks: DataFrame,
    chain: tuple[Stage, ...],
    clients: dict[str, Callable[[], Client]],
    rules: dict[str, str],
    key: str,
    path: str,
) -> DataFrame:
    """Fold the stages over the tasks, one stored table per stage under ``path``.

    A ``review`` stage also yields its parsed outcome: ``keep`` and ``reason``
    in the rich chain, ``review`` and ``final_question`` in the flat one.
    """
    flat = any(s.name == "fix" for s in chain)
    current = tasks
    for i, stage in enumerate(chain, start=1):

        once = replace(stage, tries=1)  # later tries are rounds over the stored failures

        def step(rows: DataFrame, stage: Stage = once) -> DataFrame:
            out = apply_stage(rows, stage, clients[stage.name], rules, kinds=True)
            if stage.name != "review":
                return out
            return _flat_review(out) if flat else _rich_review(out)

        failed = F.col(f"{stage.name}_error").isNotNull()
        if stage.on_error == "error_row" or "_error" in current.columns:
            failed = failed | F.col("_error").isNotNull()  # also rows that were not sent
        current = stored_once(
            current, key, f"{path}/{i}-{stage.name}", step, failed, stage_prompt(current, stage, rules),
            F.col(f"{stage.name}_again"), stage.tries, stage.wait_s,
        ).drop(f"{stage.name}_again")
    return current


def _rich_review(out: DataFrame) -> DataFrame:
    return (
        out.withColumn("_v", parse_verdict_json(F.col("review_text")))
        .withColumn("keep", F.col("_v.keep"))
        .withColumn("reason", F.col("_v.reason"))
        .drop("_v")
    )


def _flat_review(out: DataFrame) -> DataFrame:
    failed = F.col("review_error").isNotNull()
    reviewed = out.withColumn(
        "review", resolve_review(F.col("review_text"), F.col("beautify_text"), failed)
    )
    return reviewed.withColumn("final_question", F.col("review.final_question")).withColumn(
        "_error", F.lit(None).cast("string")
    )


def generate_responses(
    grid: DataFrame,
    client_factory: Callable[[str], Client],
    prompt_col: str = "prompt",
    partitions: int | None = None,
    stage: Stage = Stage("response", "", on_error="error_row"),
    timed: bool = False,
    warm_up: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Long responses table of a (task_id, model, prompt) grid.

    Rows are ranged by model and task into even partitions: a model with many
    rows fills several, small ones share one, and every partition loads its few
    models one at a time. With a ``path`` the responses are stored there, and a
    rerun asks only for the missing ones and for those whose prompt has changed;
    without it the result is lazy.
    """
    n = partitions or int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ask = _reply_udf(stage if path is None else replace(stage, tries=1), client_factory, warm_up)
    status = F.when(F.col("_reply.error").isNull(), F.lit("ok")).otherwise(F.lit("error"))
    latency = F.col("_reply.latency_s") if timed else F.lit(None).cast("double")

    spread = grid.repartitionByRange(n, "model", F.xxhash64("task_id"))

    def generate(cells: DataFrame) -> DataFrame:
        called = cells.sortWithinPartitions("model").withColumn(
            "_reply", ask(F.col("model"), F.col(prompt_col))
        )
        return called.select(
            "task_id",
            "model",
            *[c for c in cells.columns if c == DIGEST],
            F.col("_reply.again").alias("again"),
            F.col("_reply.text").alias("text"),
            status.alias("status"),
            F.col("_reply.in_tokens").alias("in_tokens"),
            F.col("_reply.out_tokens").alias("out_tokens"),
            latency.alias("latency_s"),
        )

    if path is None:
        return generate(spread).drop("again")
    made = stored_once(
        spread, ["task_id", "model"], path, generate, F.col("status") == "error", F.col(prompt_col),
        F.col("again"), stage.tries, stage.wait_s,
    )
    return made.select(
        "task_id", "model", "text", "status", "in_tokens", "out_tokens", "latency_s"
    )
