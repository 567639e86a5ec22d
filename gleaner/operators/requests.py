"""Request and response tables around text generation, and the clean-up of responses.

The generation itself happens elsewhere: requests are written as a table, and
responses come back as one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions import markdown as md
from gleaner.functions.text import TOKEN, token_count
from gleaner.operators.filters import modify, score_filter
from gleaner.operators.segments import chunk_documents, line_counts_of


@dataclass(frozen=True)
class Task:
    """Limits and prompts of one generation task."""

    name: str
    min_document_tokens: int
    min_segment_tokens: int
    max_input_tokens: int
    max_output_tokens: int
    min_response_tokens: int
    system_prompt: str
    prompt_template: str

    @property
    def max_response_tokens(self) -> int:
        """An answer that long was cut off."""
        return self.max_output_tokens - 2


_HELPFUL = "You write clear, correct texts and answer only from the text you are given."
_REWRITE = "You rewrite texts so that they keep every fact, name and number."

# Limits of the four tasks. The prompts are this project's own.
TASKS = {
    t.name: t
    for t in [
        Task(
            "diverse_qa", 30, 30, 1000, 600, 100, _HELPFUL,
            "Read the text.\n\n{text}\n\nWrite up to eight pairs of different kinds, each as a line 'Question: ...' and a line 'Answer: ...'.",
        ),
        Task(
            "distill", 30, 10, 2000, 1600, 50, _REWRITE,
            "Rewrite the text in plain and concise words.\n\n{text}\n\nBegin your answer with 'Paraphrased Text:'.",
        ),
        Task(
            "extract_knowledge", 30, 30, 1400, 1400, 50, _HELPFUL,
            "Write down as passages what can be learned from the text, and leave out what is only opinion.\n\n{text}",
        ),
        Task(
            "knowledge_list", 30, 30, 1000, 600, 50, _HELPFUL,
            "List the facts of the text as short items, each in a line that begins with '- '.\n\n{text}",
        ),
    ]
}
# Settings sent with every request.
TEMPERATURE = 0.5
TOP_P = 0.9
MAX_OUTPUT_TOKENS = 1600
STOP = "['</s>']"
TOKENS_PER_PAIR = 150


def _tokens(text: str) -> int:
    return len(re.findall(TOKEN, text))


def prompt_budget(task: Task, count=_tokens) -> int:
    """Tokens left for the segment after both prompts."""
    prefix = f"{task.system_prompt}\n{task.prompt_template.replace('{text}', '')}"
    return task.max_input_tokens - count(prefix) - 2


def _task_column(tasks: list[Task], count) -> Column:
    rows = [
        F.struct(
            F.lit(t.name).alias("task"),
            F.lit(t.min_document_tokens).alias("min_document"),
            F.lit(t.min_segment_tokens).alias("min_segment"),
            F.lit(prompt_budget(t, count)).alias("max_segment"),
            F.lit(t.system_prompt).alias("system_prompt"),
            F.lit(t.prompt_template).alias("template"),
        )
        for t in tasks
    ]
    return F.array(*rows)


def _request_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        F.concat_ws("/", "_t.task", F.col(key), "segment_id").alias("request_id"),
        F.col("_t.task").alias("task"),
        F.col(key),
        "segment_id",
        F.col("_t.system_prompt").alias("system_prompt"),
        F.replace(F.col("_t.template"), F.lit("{text}"), F.col("text")).alias("user_prompt"),
        F.lit(TEMPERATURE).alias("temperature"),
        F.lit(TOP_P).alias("top_p"),
        F.lit(MAX_OUTPUT_TOKENS).alias("max_output_tokens"),
        F.lit(STOP).alias("stop"),
    )


def build_requests(segments: DataFrame, tasks: list[Task] | None = None, key: str = "id", count=_tokens) -> DataFrame:
    """One request row per segment and task; the few tasks are an array in the row, not a join."""
    with_task = segments.withColumn("_t", F.explode(_task_column(tasks or list(TASKS.values()), count)))
    return _request_rows(with_task, key)


def requests_for_tasks(docs: DataFrame, tasks: list[Task] | None = None, key: str = "id", count=_tokens) -> DataFrame:
    """Requests of every task, each over its own segmentation of ``docs``; lines are counted once for all."""
    lines = line_counts_of(F.split(F.col("text"), "\n", -1))
    counted = docs.withColumns({"document_token_count": token_count(F.col("text")), "_line_counts": lines})
    with_task = counted.withColumn("_t", F.explode(_task_column(tasks or list(TASKS.values()), count)))
    long_enough = with_task.filter(F.col("document_token_count") >= F.col("_t.min_document"))
    segments = chunk_documents(long_enough, F.col("_t.max_segment"), F.col("_t.min_segment"), counts="_line_counts")
    return _request_rows(segments, key)


def join_responses(
    segments: DataFrame, responses: DataFrame, out: str, key: str = "id", unanswered: str = "drop"
) -> DataFrame:
    """Attach ``response`` to its segment as column ``out``.

    ``unanswered="list"`` gives the segments still without one instead.
    """
    if unanswered not in ("drop", "list"):
        raise ValueError("unanswered must be 'drop' or 'list'")
    keys = [key, "segment_id"]
    if unanswered == "list":
        return segments.join(responses.select(*keys), keys, "left_anti")
    return segments.join(responses.select(*keys, F.col("response").alias(out)), keys)


def max_response_tokens(df: DataFrame, field: str, maximum: int, count=token_count) -> DataFrame:
    """Drop answers above the limit; adds ``rephrased_segment_token_count``."""
    return score_filter(df, count(F.col(field)), "rephrased_segment_token_count", maximum=maximum)


def min_response_tokens(df: DataFrame, field: str, minimum: int, count=token_count) -> DataFrame:
    """Drop short results; adds ``rephrased_document_token_count``."""
    return score_filter(df, count(F.col(field)), "rephrased_document_token_count", minimum=minimum)


def substring_filter(df: DataFrame, field: str, substring: str, position: str, out: str = "substring") -> DataFrame:
    """Keep rows with ``substring`` at ``position`` and add the flag as ``out``."""
    return score_filter(df, md.has_substring(F.col(field), substring, position).cast("int"), out, minimum=1)


def qa_postprocess(
    df: DataFrame, field: str = "diverse_qa", text: str = "text", key: str = "id", seed: str = "qa", count=token_count
) -> DataFrame:
    """The segment's text, then its question-answer pairs in a fixed pseudo-random order.

    One pair per ``TOKENS_PER_PAIR`` tokens of the segment, at least one; rows
    without a valid pair are dropped. All inside the row, nothing is shuffled.
    """
    limit = F.greatest(F.lit(1), F.floor(count(F.col(text)) / TOKENS_PER_PAIR).cast("int"))
    row_id = F.concat_ws(":", F.lit(seed), F.col(key), F.col("segment_id"))
    ranked = F.transform(
        F.col("_pairs"),
        lambda p, i: F.struct(F.md5(F.concat_ws(":", row_id, i.cast("string"))).alias("h"), p.alias("pair")),
    )
    chosen = F.transform(F.slice(F.array_sort(ranked), F.lit(1), limit), lambda r: r["pair"])
    # Exploding a filtered one-element array finds the pairs once; see score_filter.
    found = F.filter(F.array(md.question_answer_pairs(F.col(field))), lambda pairs: F.size(pairs) > 0)
    return (
        df.select("*", F.explode(found).alias("_pairs"))
        .withColumn(field, F.concat_ws("\n\n", F.col(text), F.array_join(chosen, "\n\n")))
        .drop("_pairs")
    )


def post_diverse_qa(df: DataFrame, key: str = "id", field: str = "diverse_qa") -> DataFrame:
    task = TASKS["diverse_qa"]
    out = max_response_tokens(df, field, task.max_response_tokens)
    out = modify(out, field, md.strip_markdown)
    out = qa_postprocess(out, field, key=key)
    return min_response_tokens(out, field, task.min_response_tokens)


def post_distill(df: DataFrame, key: str = "id", field: str = "distill") -> DataFrame:
    task = TASKS["distill"]
    out = max_response_tokens(df, field, task.max_response_tokens)
    out = modify(out, field, md.strip_markdown)
    out = substring_filter(out, field, md.PARAPHRASE, "prefix")
    out = modify(out, field, lambda c: md.slice_after(c, left=md.PARAPHRASE))
    out = modify(out, field, md.strip_quotes)
    return min_response_tokens(out, field, task.min_response_tokens)


def post_extract_knowledge(df: DataFrame, key: str = "id", field: str = "extract_knowledge") -> DataFrame:
    task = TASKS["extract_knowledge"]
    out = max_response_tokens(df, field, task.max_response_tokens)
    out = modify(out, field, md.strip_markdown)
    out = modify(out, field, lambda c: md.remove_lines(c, md.PASSAGE_LINES))
    return min_response_tokens(out, field, task.min_response_tokens)


def post_knowledge_list(df: DataFrame, key: str = "id", field: str = "knowledge_list") -> DataFrame:
    task = TASKS["knowledge_list"]
    out = max_response_tokens(df, field, task.max_response_tokens)
    out = modify(out, field, md.strip_markdown)
    out = modify(out, field, md.bulleted_lines)
    return min_response_tokens(out, field, task.min_response_tokens)


POST = {
    "diverse_qa": post_diverse_qa,
    "distill": post_distill,
    "extract_knowledge": post_extract_knowledge,
    "knowledge_list": post_knowledge_list,
}


def all_tasks(answered: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Clean the answers of every task; ``(task, key, segment_id, output, both counts)``.

    Write with ``partitionBy("task")`` for one folder per task.
    """
    parts = [
        POST[name](df, key).select(
            F.lit(name).alias("task"),
            key,
            "segment_id",
            F.col(name).alias("output"),
            "rephrased_segment_token_count",
            "rephrased_document_token_count",
        )
        for name, df in answered.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
