"""Explicit schemas of the tables the library reads and writes.

JSON sources are always read with one of these, never with inference.
"""

CHAT_MESSAGES = "ARRAY<STRUCT<role: STRING, content: STRING>>"

STAGES = ("generator", "comment", "refine", "beautify", "review")

TOKEN_FIELDS = [f"{stage}_{side}" for stage in STAGES for side in ("in", "out")]

TOKENS = "STRUCT<" + ", ".join(f"{name}: INT" for name in TOKEN_FIELDS) + ">"

MCQ = (
    "STRUCT<stem: STRING, "
    "options: STRUCT<A: STRING, B: STRING, C: STRING, D: STRING>>"
)

GEN_RECORD = (
    f"topic STRING, question STRING, messages {CHAT_MESSAGES}, keep BOOLEAN, "
    "reason STRING, meta STRUCT<raw: STRING, comment: STRING, refined: STRING>, "
    f"tokens {TOKENS}, _error STRING, content STRING"
)

# Same record with ``keep`` left as found, for ``keep_gate(mode="truthy")``.
GEN_RECORD_VARIANT_KEEP = GEN_RECORD.replace("keep BOOLEAN", "keep VARIANT")

FLAT_RECORD = (
    "topic STRING, original STRING, final STRING, answer STRING, explain STRING, "
    "decision STRING, reason STRING, review_json STRING"
)

FLAT_DATASET = f"topic STRING, messages {CHAT_MESSAGES}"

CLEAN_RECORD = f"question STRING, LLMans {MCQ}"

CLEAN_RECORD_FLAT = "question STRING, LLMans STRING"

REMOVED_RECORD = "reason STRING, content STRING"

TASKS = "task_id BIGINT, topic STRING, template_id INT, prompt STRING"

RESPONSES = (
    "task_id BIGINT, model STRING, text STRING, status STRING, "
    "in_tokens INT, out_tokens INT, latency_s DOUBLE"
)

TRAINER_STATE = (
    "log_history ARRAY<STRUCT<epoch: DOUBLE, grad_norm: DOUBLE, "
    "learning_rate: DOUBLE, loss: DOUBLE, step: BIGINT>>"
)

RUN_CONFIG = (
    "base_model_name_or_path STRING, peft_type STRING, r INT, lora_alpha INT, "
    "lora_dropout DOUBLE, target_modules ARRAY<STRING>, task_type STRING"
)
