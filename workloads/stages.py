"""Model stages with deterministic clients, and stages replayed from stored replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examloom.operators import logs, stages
from examloom.plans import flows
from examloom.session import fresh_path, ship_packages
from workloads import judging
from workloads.registry import query, sql_strip, sql_tokens, table


class RefusedPrompt(Exception):
    """What the deterministic client raises for prompts it does not take."""


def rewriting_client():
    """Replies with the prompt, spaced out; refuses prompts of one source."""

    def ask(prompt: str) -> stages.Reply:
        if prompt.startswith("src3:"):
            raise RefusedPrompt("refused")
        text = prompt.replace("e", "3")
        return stages.Reply(f"  {text}\n", in_tokens=len(prompt))

    return ask


def _ship(spark: SparkSession) -> None:
    ship_packages(spark, "examloom", "workloads")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


_STAGE_SQL = f"""SELECT doc_id, source, p, failed,
  CASE WHEN NOT failed THEN {sql_strip("replace(p, 'e', '3')")} END AS reply
  FROM (SELECT *, starts_with(p, 'src3:') AS failed
        FROM (SELECT doc_id, source, source || ': ' || text AS p FROM documents))"""


@query(
    "apply_stage",
    f"""SELECT doc_id, reply AS rewrite_text,
    CASE WHEN failed THEN {sql_tokens('p')}::INTEGER ELSE length(p)::INTEGER END AS rewrite_in,
    CASE WHEN NOT failed THEN {sql_tokens('reply')}::INTEGER END AS rewrite_out,
    CASE WHEN failed THEN 'refused' END AS _error FROM ({_STAGE_SQL})""",
)
def apply_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = stages.Stage("rewrite", "{source}: {text}", on_error="error_row")
    done = stages.apply_stage(_documents(spark, sf_dir), stage, rewriting_client)
    return done.select("doc_id", "rewrite_text", "rewrite_in", "rewrite_out", "_error")


@query(
    "apply_stage_passthrough",
    f"""SELECT doc_id, CASE WHEN failed THEN source ELSE reply END AS rewrite_text
    FROM ({_STAGE_SQL})""",
)
def apply_stage_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = stages.Stage(
        "rewrite", "{source}: {text}", on_error="passthrough", passthrough="source"
    )
    done = stages.apply_stage(_documents(spark, sf_dir), stage, rewriting_client)
    return done.select("doc_id", "rewrite_text")


@query(
    "stages_replay",
    f"""SELECT d.doc_id, CASE WHEN text IS NOT NULL AND quality IS NOT NULL THEN text END AS judge_text,
    CASE WHEN quality IS NOT NULL THEN {sql_tokens('text')}::INTEGER END AS judge_out,
    CASE WHEN quality IS NULL THEN 'no stored reply' END AS _error
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def stages_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stored = docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id",
        "text",
        F.lit(0).alias("in_tokens"),
        F.size(F.split("text", r"\s+")).alias("in_words"),
        F.regexp_count("text", F.lit(r"\S+")).alias("out_tokens"),
        F.lit(None).cast("string").alias("error"),
    )
    done = stages.replay_stage(
        docs.select("doc_id", "source"), stages.Stage("judge", ""), stored, "doc_id"
    )
    return done.select("doc_id", "judge_text", "judge_out", "_error")


def sizing_client(name: str):
    """Client factory: replies with the stage name and the prompt size."""

    def factory():
        return lambda prompt: f"{name} {len(prompt)}"

    return factory


def reviewing_client():
    """Keeps prompts of even size; says nothing usable about every third one."""

    def ask(prompt: str) -> str:
        if len(prompt) % 3 == 0:
            return "no verdict"
        return f'so {{"keep": {str(len(prompt) % 2 == 0).lower()}, "reason": "{len(prompt)}"}}'

    return ask


CLIENTS = {s: sizing_client(s) for s in ("generator", "comment", "refine", "beautify")}
CLIENTS["review"] = lambda: reviewing_client()
RULES = {f"{s}_rules": f"rules of {s}" for s in CLIENTS}


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"), F.col("source").alias("topic"), F.col("text").alias("prompt")
    )


RICH_SQL = """g AS (SELECT doc_id AS task_id, source AS topic, text AS prompt,
  text || chr(10) || chr(10) || '格式要求：' || chr(10) || 'rules of generator' || chr(10)
  || '請根據主題「' || source || '」出一題。' AS p1 FROM documents),
c AS (SELECT *, 'generator ' || length(p1) AS t1, 'rules of comment' || chr(10) || chr(10)
  || '題目如下：' || chr(10) || 'generator ' || length(p1) AS p2 FROM g),
r AS (SELECT *, 'comment ' || length(p2) AS t2, 'rules of refine' || chr(10) || chr(10) || '【原題目】'
  || chr(10) || t1 || chr(10) || chr(10) || '【建議】' || chr(10) || 'comment ' || length(p2) || chr(10) AS p3 FROM c),
b AS (SELECT *, 'refine ' || length(p3) AS t3, 'rules of beautify' || chr(10) || 'refine ' || length(p3) AS p4 FROM r),
v AS (SELECT *, 'beautify ' || length(p4) AS t4, 'rules of review' || chr(10) || 'beautify ' || length(p4) AS p5 FROM b)"""


@query(
    "generate_rich",
    f"""WITH {RICH_SQL} SELECT task_id, topic, prompt AS question, t4 AS answer, t1 AS raw, t2 AS comment,
    t3 AS refined, length(p5) % 3 <> 0 AND length(p5) % 2 = 0 AS keep,
    CASE WHEN length(p5) % 3 = 0 THEN 'JSON parse failed' ELSE length(p5)::VARCHAR END AS reason,
    2 AS generator_out, {sql_tokens('p1')}::INTEGER AS generator_in FROM v""",
)
def generate_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = flows.generate_rich(
        _tasks(spark, sf_dir), CLIENTS, RULES, fresh_path(spark, "generate-rich")
    )
    return done.select(
        "task_id", "topic", "question", "keep", "reason", "meta.*",
        F.try_element_at("messages", F.lit(2)).content.alias("answer"),
        "tokens.generator_out", "tokens.generator_in",
    )





def model_client(model: str):
    return lambda prompt: f"{model} {len(prompt)}"


@query(
    "generate_responses",
    f"""SELECT doc_id AS task_id, source AS model, source || ' ' || length(text) AS text, 'ok' AS status,
    {sql_tokens('text')}::INTEGER AS in_tokens, 2 AS out_tokens FROM documents""",
)
def generate_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    cells = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"), F.col("source").alias("model"), F.col("text").alias("prompt")
    )
    done = stages.generate_responses(cells, model_client, path=fresh_path(spark, "responses"))
    return done.drop("latency_s")


@query(
    "latency_log",
    """SELECT doc_id AS round, source AS topic, CASE WHEN source <> 'src3' THEN 'tuned ' || length(text) END AS question_tuned,
    'teacher ' || length(text) AS question_teacher, source <> 'src3' AS timed_tuned, true AS timed_teacher FROM documents""",
)
def latency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both arms timed in every round; the times themselves differ from run to run."""
    _ship(spark)
    rounds = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"), F.col("source").alias("topic"),
        F.when(F.col("source") == "src3", F.concat(F.lit("!"), "text")).otherwise(F.col("text")).alias("prompt"),
    )

    def tuned():
        def ask(prompt: str) -> str:
            if prompt.startswith("!"):
                raise RefusedPrompt("refused")
            return f"tuned {len(prompt)}"

        return ask

    arms = {"tuned": tuned, "teacher": lambda: lambda prompt: f"teacher {len(prompt.removeprefix('!'))}"}
    log = logs.latency_log(stages.timed_arms(rounds, arms), "tuned", "teacher")
    taken = [F.coalesce(F.col(f"time_{a}") >= 0, F.lit(False)).alias(f"timed_{a}") for a in arms]
    return log.select("round", "topic", "question_tuned", "question_teacher", *taken)


def wondering_client():
    """Answers each told template with a new one, after one that is known already."""

    def ask(prompt: str) -> str:
        told = [line[2:] for line in prompt.splitlines() if line.startswith("- ")]
        return "\n".join(f"- {t}\n- {t.replace(' asks ', ' wonders about ')}" for t in told)

    return ask


@query(
    "augment_templates",
    """WITH seeds AS (SELECT s_suppkey, s_name || ' asks {topic}' AS template FROM supplier),
    fresh AS (SELECT s_suppkey, s_name || ' wonders about {topic}' AS template FROM supplier ORDER BY s_suppkey
      LIMIT (SELECT count(*) * 3 // 2 - count(*) FROM supplier))
    SELECT origin, row_number() OVER (ORDER BY origin DESC, s_suppkey) - 1 AS template_id, template
    FROM (SELECT 'seed' AS origin, * FROM seeds UNION ALL SELECT 'augmented', * FROM fresh)""",
)
def augment_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    seeds = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("ordinal"), F.concat("s_name", F.lit(" asks {topic}")).alias("template")
    )
    return flows.augment_templates(
        seeds, wondering_client, "Write {per_template} like these:\n{seeds}", 1, seeds.count() * 3 // 2,
        fresh_path(spark, "augment"),
    )


# The flat chain: generation falls back on empty replies, beautify fails, fix echoes.
def _flat_clients() -> dict:
    def broken(prompt: str) -> str:
        raise RefusedPrompt("down")

    def generate(prompt: str) -> str:
        return "" if "src3」" in prompt else f"Q {len(prompt)}\n答案：B\n解析： because"

    def review(prompt: str) -> str:
        if len(prompt) % 3 == 0:
            return "no verdict"
        return '{"decision": "rewrite", "reason": "' + str(len(prompt)) + '", "final_question": ""}'

    return {
        "generate": lambda: generate,
        "beautify": lambda: broken,
        "review": lambda: review,
        "fix": lambda: lambda prompt: prompt.split("\n", 1)[1],
    }


_FLAT_RULES = {f"{s}_rules": f"rules of {s}" for s in ("generate", "beautify", "review", "fix")}
FLAT_SQL = """g AS (SELECT doc_id AS task_id, lang || '」' || source AS topic,
  'rules of generate' || chr(10) || '請根據主題「' || lang || '」' || source || '」出一題。' AS p FROM documents),
o AS (SELECT *, CASE WHEN contains(p, 'src3」') THEN '題目（回傳空白）請出與 ' || topic || ' 有關的題目。'
  ELSE 'Q ' || length(p) || chr(10) || '答案：B' || chr(10) || '解析： because' END AS original FROM g),
r AS (SELECT *, length('rules of review' || chr(10) || original) AS n FROM o)"""


@query(
    "generate_flat",
    f"""WITH {FLAT_SQL} SELECT task_id, topic, original, original AS final,
    CASE WHEN contains(p, 'src3」') THEN 'N/A' ELSE 'B' END AS answer,
    CASE WHEN contains(p, 'src3」') THEN 'N/A' ELSE 'because' END AS explain,
    CASE WHEN n % 3 = 0 THEN 'accept' ELSE 'rewrite' END AS decision,
    CASE WHEN n % 3 = 0 THEN 'JSON parse error' ELSE n::VARCHAR END AS reason FROM r""",
)
def generate_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    tasks = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("task_id"), F.expr("lang || '」' || source").alias("topic")
    )
    done = flows.generate_flat(
        tasks, _flat_clients(), _FLAT_RULES, fresh_path(spark, "generate-flat")
    )
    return done.drop("review_json")


def longest_wins_ab():
    """Judge of two blocks: the longer one, a tie when equal."""

    def ask(prompt: str) -> str:
        a, _, b = prompt.partition("=== Response B ===\n")
        size_a, size_b = len(a) - len("=== Response A ===\n\n\n"), len(b) - len("\n\n")
        side = "Tie" if size_a == size_b else "A" if size_a > size_b else "B"
        return f"compared.\nWinner: {side}"

    return ask


@query(
    "pairwise_tournament",
    f"""WITH {judging.PAIRS_SQL},
    won AS (SELECT *, CASE WHEN length(text_1) = length(text_2) THEN 'Tie'
      WHEN length(text_1) > length(text_2) THEN model_1 ELSE model_2 END AS winner FROM pairs),
    sides AS (SELECT model_1 AS model, winner FROM won UNION ALL SELECT model_2, winner FROM won)
    SELECT pos::INTEGER AS pos, m.model, count(*) FILTER (WHERE winner = m.model) AS wins,
      count(*) FILTER (WHERE winner = 'Tie') AS ties, count(*) AS matches,
      count(*) FILTER (WHERE winner = m.model) * 100.0::DOUBLE / count(*) AS win_rate
    FROM models m JOIN sides s ON s.model = m.model GROUP BY pos, m.model""",
)
def pairwise_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    tasks = judging.tasks(spark, sf_dir).withColumn("prompt", F.col("topic"))
    _, board = flows.pairwise_tournament(
        judging.responses(spark, sf_dir), tasks, judging.MODELS, longest_wins_ab, "{responses}",
        judging.SEED, fresh_path(spark, "pairwise"),
    )
    return board


def _blocks(prompt: str) -> dict[int, str]:
    """Label to text of a labelled judge prompt."""
    import re

    parts = re.split(r"=== Model (\d+) ===\n", prompt)
    return {int(label): body.removesuffix("\n\n") for label, body in zip(parts[1::2], parts[2::2])}


def longest_wins_n():
    def ask(prompt: str) -> str:
        blocks = _blocks(prompt)
        top = max(len(b) for b in blocks.values())
        leaders = [label for label, b in blocks.items() if len(b) == top]
        return f"Winner: Model {leaders[0]}" if len(leaders) == 1 else "no single winner"

    return ask


@query(
    "best_of_n_tournament",
    f"""WITH {judging.CELLS_SQL}, {judging.MODELS_SQL},
    sized AS (SELECT *, length(CASE text WHEN '[ERROR_GENERATING]' THEN '[ERROR]' ELSE text END) AS n FROM cells),
    top AS (SELECT *, max(n) OVER (PARTITION BY task_id) AS best FROM sized),
    leaders AS (SELECT task_id, min(model) AS model FROM top WHERE n = best GROUP BY task_id HAVING count(*) = 1)
    SELECT pos::INTEGER AS pos, m.model, count(l.task_id) AS wins,
      (SELECT count(DISTINCT task_id) FROM cells) AS tasks,
      count(l.task_id) * 100.0::DOUBLE / (SELECT count(DISTINCT task_id) FROM cells) AS win_rate
    FROM models m LEFT JOIN leaders l ON l.model = m.model GROUP BY pos, m.model""",
)
def best_of_n_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    tasks = judging.tasks(spark, sf_dir).withColumn("prompt", F.col("topic"))
    _, board = flows.best_of_n_tournament(
        judging.responses(spark, sf_dir), tasks, judging.MODELS, longest_wins_n, "{responses}",
        judging.SEED, fresh_path(spark, "best-of-n"),
    )
    return board


def rates_by_size():
    """Rates every text by its size, leaving out those that rate 0."""

    def ask(prompt: str) -> str:
        rated = {label: len(b) % 11 for label, b in _blocks(prompt).items()}
        return "Final Ratings:\n" + "\n".join(f"Model {k} Score: {v}" for k, v in rated.items() if v)

    return ask


@query(
    "multi_judge",
    f"""WITH {judging.RAW_SQL}, {judging.shuffled_sql('raw')},
    sized AS (SELECT task_id, model, length(CASE WHEN NOT present THEN 'No Output' ELSE text END) % 11 AS n FROM raw)
    SELECT task_id, label, model, CASE WHEN n = 0 THEN -1 ELSE n END::INTEGER AS score
    FROM sized JOIN labels_of USING (task_id, model)""",
)
def multi_judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    tasks = judging.tasks(spark, sf_dir).withColumn("prompt", F.col("topic"))
    scores = flows.multi_judge(
        judging.responses(spark, sf_dir), tasks, judging.MODELS, rates_by_size, "{responses}",
        judging.SEED, fresh_path(spark, "multi-judge"),
    )
    return scores.select("task_id", "label", "model", "score")


def scores_by_size():
    def ask(prompt: str) -> str:
        a, _, b = prompt.removeprefix("A:\n").partition("\n\nB:\n")
        return f"Score: {len(a) % 10 + 1}\nScore: {len(b.removesuffix(chr(10) * 2)) % 10 + 1}"

    return ask


@query(
    "two_arm_comparison",
    f"""WITH {judging.ARMS_SQL} SELECT count(*) AS rounds, sum(length(text_x) % 10 + 1)::BIGINT AS total_x,
    sum(length(text_y) % 10 + 1)::BIGINT AS total_y FROM arms""",
)
def two_arm_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ship(spark)
    x, y = judging.arm_texts(spark, sf_dir)
    _, totals = flows.two_arm_comparison(
        x, y, scores_by_size, "{responses}", judging.SEED, fresh_path(spark, "two-arm")
    )
    return totals
