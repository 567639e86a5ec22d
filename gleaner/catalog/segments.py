"""Segments, requests and responses."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from gleaner.catalog.base import query, table
from gleaner.catalog.filters import CANONICAL_SQL, canonical
from gleaner.functions import markdown as md
from gleaner.functions.text import token_count
from gleaner.operators import requests as req, segments as ops
from gleaner.operators.filters import modify as modify_column
from gleaner.session import spread_small_input

MAX, MIN = 60, 10


def tokens_sql(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '[^ \t\n\r\f]+'))::BIGINT"


_LINES_SQL = (
    "SELECT doc_id, generate_subscripts(l, 1)::INTEGER - 1 AS segment_id, unnest(l) AS text "
    "FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"
)


def packed_sql(source: str, maximum: str = str(MAX), carry: str = "doc_id") -> str:
    """``(carry, c.t, c.n)`` with all greedy chunks ``c`` of ``text`` in ``source``; ``i`` numbers them."""
    empty = "[]::STRUCT(t VARCHAR, n BIGINT)[]"
    return f"""
    SELECT {carry}, unnest(list_append(r.done, {{'t': r.t, 'n': r.n}})) AS c, generate_subscripts(list_append(r.done, {{'t': r.t, 'n': r.n}}), 1) AS i
    FROM (SELECT {carry}, list_reduce(kept, lambda a, x: CASE WHEN a.n + x.n + 1 <= {maximum}
        THEN {{'t': a.t || chr(10) || x.t, 'n': a.n + x.n + 1, 'done': a.done}}
        ELSE {{'t': x.t, 'n': x.n, 'done': list_append(a.done, {{'t': a.t, 'n': a.n}})}} END) AS r
      FROM (SELECT {carry}, list_filter(list_transform(string_split(text, chr(10)),
          lambda l: {{'t': l, 'n': {tokens_sql('l')}, 'done': {empty}}}), lambda x: x.n <= {maximum}) AS kept FROM ({source}))
      WHERE len(kept) > 0)
    """


def chunks_sql(source: str, maximum: str = str(MAX), minimum: str = str(MIN), carry: str = "doc_id") -> str:
    """Chunks of at least ``minimum`` tokens, numbered from 0 per ``doc_id`` (and task)."""
    keys = ", ".join(c.strip() for c in carry.split(",") if c.strip() in ("doc_id", "task"))
    return f"""
    SELECT {carry}, c.t AS text, c.n AS segment_token_count,
      (row_number() OVER (PARTITION BY {keys} ORDER BY i) - 1)::INTEGER AS segment_id
    FROM ({packed_sql(source, maximum, carry)}) WHERE c.n >= {minimum}
    """


def _docs(spark, sf_dir):
    return spread_small_input(table(spark, sf_dir, "documents")).select("doc_id", "text")


@query(
    "document_id",
    f"SELECT url, row_number() OVER (ORDER BY url) - 1 AS id, text FROM ({CANONICAL_SQL})",
)
def document_id(spark, sf_dir):
    return ops.add_document_id(canonical(spark, sf_dir).select("url", "text"), "url")


@query("token_count", f"SELECT doc_id, {tokens_sql('text')} AS tokens FROM documents")
def token_counts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", token_count(F.col("text")).alias("tokens"))


@query(
    "min_document_tokens",
    f"SELECT * FROM (SELECT doc_id, {tokens_sql('text')} AS document_token_count FROM documents) WHERE document_token_count >= 30",
)
def min_document_tokens(spark, sf_dir):
    return ops.min_document_tokens(_docs(spark, sf_dir), 30).drop("text")


def _budgets_sql() -> str:
    rows = ", ".join(
        f"('{t.name}', {t.max_input_tokens}, {_quoted(t.system_prompt)}, {_quoted(t.prompt_template)})" for t in req.TASKS.values()
    )
    return f"SELECT * FROM (VALUES {rows}) v(task, max_input, system_prompt, template)"


def _quoted(text: str) -> str:
    parts = text.split("\n")
    return "(" + " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts) + ")"


_PREFIX_SQL = "system_prompt || chr(10) || replace(template, '{text}', '')"
_BUDGET_SQL = f"SELECT *, max_input - {tokens_sql(_PREFIX_SQL)} - 2 AS max_segment FROM ({_budgets_sql()})"


@query(
    "prompt_budget",
    f"SELECT task, max_segment, count(*) AS lines_within FROM ({_BUDGET_SQL}), "
    f"(SELECT {tokens_sql('text')} AS n FROM ({_LINES_SQL})) WHERE n <= max_segment GROUP BY ALL",
)
def prompt_budget(spark, sf_dir):
    lines = ops.split_lines(_docs(spark, sf_dir)).select(token_count(F.col("text")).alias("n"))
    budgets = [F.struct(F.lit(t.name).alias("task"), F.lit(req.prompt_budget(t)).cast("bigint").alias("max_segment")) for t in req.TASKS.values()]
    return (
        lines.groupBy("n").agg(F.count(F.lit(1)).alias("lines"))
        .withColumn("b", F.explode(F.array(*budgets)))
        .filter("n <= b.max_segment")
        .groupBy("b.task", "b.max_segment")
        .agg(F.sum("lines").alias("lines_within"))
    )


@query("split_lines", _LINES_SQL)
def split_lines(spark, sf_dir):
    return ops.split_lines(_docs(spark, sf_dir))


@query("line_token_filter", f"SELECT * FROM (SELECT *, {tokens_sql('text')} AS segment_token_count FROM ({_LINES_SQL})) WHERE segment_token_count <= {MAX}")
def line_token_filter(spark, sf_dir):
    return ops.line_token_filter(ops.split_lines(_docs(spark, sf_dir)), MAX)


def _stock(spark, sf_dir):
    lines = ops.line_token_filter(ops.split_lines(_docs(spark, sf_dir)), MAX)
    return ops.greedy_join(lines, MAX, key="doc_id")


_DOCS_SQL = "SELECT doc_id, text FROM documents"
_PACKED_SQL = f"SELECT doc_id, (i - 1)::INTEGER AS segment_id, c.t AS text, c.n AS segment_token_count FROM ({packed_sql(_DOCS_SQL)})"


@query("greedy_join", _PACKED_SQL)
def greedy_join(spark, sf_dir):
    return _stock(spark, sf_dir)


@query("min_segment_tokens", f"SELECT * FROM ({_PACKED_SQL}) WHERE segment_token_count >= {MIN}")
def min_segment_tokens(spark, sf_dir):
    return ops.min_segment_tokens(_stock(spark, sf_dir), MIN)


@query("chunk_documents", chunks_sql(_DOCS_SQL))
def chunk_documents(spark, sf_dir):
    return ops.chunk_documents(_docs(spark, sf_dir), MAX, MIN)


def _minimum_sql(maximum: int) -> str:
    return f"SELECT doc_id, segment_id, text, segment_token_count FROM ({chunks_sql(_DOCS_SQL, str(maximum))})"


@query(
    "chunk_equivalence",
    f"""
    SELECT (SELECT count(*) FROM ({_minimum_sql(MAX)})) AS compared, 0::BIGINT AS different,
      (SELECT count(*) FROM ({_minimum_sql(MAX)}) a FULL JOIN ({_minimum_sql(MAX - 7)}) b USING (doc_id, segment_id)
       WHERE a.text IS DISTINCT FROM b.text OR a.segment_token_count IS DISTINCT FROM b.segment_token_count) AS different_maximum
    """,
)
def chunk_equivalence(spark, sf_dir):
    """Both ways to segment agree, minimum included; another maximum is told apart."""
    packed = ops.min_segment_tokens(_stock(spark, sf_dir), MIN)
    place = Window.partitionBy("doc_id").orderBy("segment_id")
    stock = packed.withColumn("segment_id", F.row_number().over(place) - 1)
    fused, other = (ops.chunk_documents(_docs(spark, sf_dir), m, MIN) for m in (MAX, MAX - 7))
    sides = [
        stock.select(F.lit(0).alias("kind")),
        ops.chunk_equivalence(stock, fused, key="doc_id").select(F.lit(1).alias("kind")),
        ops.chunk_equivalence(fused, other, key="doc_id").select(F.lit(2).alias("kind")),
    ]
    counts = [F.count_if(F.col("kind") == k).alias(n) for k, n in enumerate(("compared", "different", "different_maximum"))]
    return sides[0].union(sides[1]).union(sides[2]).agg(*counts)


_REQUEST_SQL = """
SELECT task || '/' || doc_id || '/' || segment_id AS request_id, task, doc_id, segment_id, system_prompt,
  replace(template, '{{text}}', text) AS user_prompt, 0.5::DOUBLE AS temperature, 0.9::DOUBLE AS top_p,
  1600 AS max_output_tokens, '[''</s>'']' AS stop
FROM ({source})
"""


def requests_sql(source: str) -> str:
    """Requests of all four tasks over ``(doc_id, text)`` of ``source``."""
    minimum = "CASE WHEN task = 'distill' THEN 10 ELSE 30 END"
    long_enough = f"SELECT doc_id, text, b.* FROM ({source}), ({_BUDGET_SQL}) b WHERE {tokens_sql('text')} >= 30"
    return _REQUEST_SQL.format(
        source=chunks_sql(long_enough, "max_segment", minimum, "doc_id, task, system_prompt, template, max_segment")
    )


@query("build_requests", _REQUEST_SQL.format(source=f"SELECT * FROM ({chunks_sql(_DOCS_SQL)}), ({_BUDGET_SQL})"))
def build_requests(spark, sf_dir):
    return req.build_requests(ops.chunk_documents(_docs(spark, sf_dir), MAX, MIN), key="doc_id")


# User turns stand in for segments, the assistant turn that follows for the answer.
_SEGMENTS_SQL = "SELECT conv_id AS id, turn::INTEGER AS segment_id, text FROM conversations WHERE role = 'user'"
_RESPONSES_SQL = "SELECT conv_id AS id, (turn - 1)::INTEGER AS segment_id, text AS response FROM conversations WHERE role = 'assistant'"


def _segments(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter("role = 'user'")
    return turns.select(F.col("conv_id").alias("id"), F.col("turn").cast("int").alias("segment_id"), "text")


def _responses(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    return turns.select(F.col("conv_id").alias("id"), (F.col("turn") - 1).cast("int").alias("segment_id"), F.col("text").alias("response"))


@query(
    "join_responses",
    f"SELECT s.id, s.segment_id, s.text, r.response AS answer, CASE WHEN r.id IS NULL THEN 'pending' ELSE 'answered' END AS state "
    f"FROM ({_SEGMENTS_SQL}) s LEFT JOIN ({_RESPONSES_SQL}) r ON s.id = r.id AND s.segment_id = r.segment_id",
)
def join_responses(spark, sf_dir):
    segments, responses = _segments(spark, sf_dir), _responses(spark, sf_dir)
    answered = req.join_responses(segments, responses, "answer").withColumn("state", F.lit("answered"))
    pending = req.join_responses(segments, responses, "answer", unanswered="list").withColumn("state", F.lit("pending"))
    return answered.unionByName(pending, allowMissingColumns=True)


# The answers dressed up the way generated text comes back, alike on both sides.
_NL = "chr(10)"
_DRESSED_SQL = {
    "diverse_qa": f"'**Question:** ' || text || {_NL} || 'Answer: `' || response || '`' || {_NL} || {_NL} || 'Question: [why](u)?' || {_NL} || 'Answer: *so*' || {_NL} || 'Question: none'",
    "distill": f"CASE WHEN id % 7 = 0 THEN 'Sure. ' ELSE '' END || '**Paraphrased Text:** \"' || response || '\"'",
    "extract_knowledge": f"'## Facts' || {_NL} || 'Passage 1:' || {_NL} || response || {_NL} || '---' || {_NL} || ' Passage: ' || {_NL} || '__end__'",
    "knowledge_list": f"'Here it is:' || {_NL} || '- ' || replace(response, {_NL}, {_NL} || '  * ') || {_NL} || 'done'",
}


def _dressed(name: str):
    nl, text, response = F.lit("\n"), F.col("text"), F.col("response")
    return {
        "diverse_qa": lambda: F.concat(
            F.lit("**Question:** "), text, F.lit("\nAnswer: `"), response,
            F.lit("`\n\nQuestion: [why](u)?\nAnswer: *so*\nQuestion: none"),
        ),
        "distill": lambda: F.concat(
            F.when(F.col("id") % 7 == 0, F.lit("Sure. ")).otherwise(F.lit("")), F.lit('**Paraphrased Text:** "'), response, F.lit('"')
        ),
        "extract_knowledge": lambda: F.concat(F.lit("## Facts\nPassage 1:\n"), response, F.lit("\n---\n Passage: \n__end__")),
        "knowledge_list": lambda: F.concat(F.lit("Here it is:\n- "), F.replace(response, nl, F.lit("\n  * ")), F.lit("\ndone")),
    }[name]()


_PAIRED_SQL = f"SELECT s.*, r.response FROM ({_SEGMENTS_SQL}) s JOIN ({_RESPONSES_SQL}) r ON s.id = r.id AND s.segment_id = r.segment_id"


def _dressed_sql(name: str) -> str:
    return f"SELECT id, segment_id, text, {_DRESSED_SQL[name]} AS {name} FROM ({_PAIRED_SQL})"


def _answered(spark, sf_dir, name: str):
    paired = req.join_responses(_segments(spark, sf_dir), _responses(spark, sf_dir), "response")
    return paired.withColumn(name, _dressed(name)).drop("response")


def markdown_sql(text: str) -> str:
    for pattern, replacement in [
        (r"`([^`\n]+)`", r"\1"),
        (r"\*\*([^*\n]+)\*\*", r"\1"),
        (r"__([^_\n]+)__", r"\1"),
        (r"\*([^* \n][^*\n]*)\*", r"\1"),
        (r"\[([^\]\n]*)\]\([^)\n]*\)", r"\1"),
        (r"(?m)^#{1,6} +", ""),
        (r"(?m)^(?:-{3,}|\*{3,}|_{3,})[ \t]*$", ""),
    ]:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def _strip_sql(text: str) -> str:
    return rf"trim({text}, e' \t\n\r\f')"


def _unquote_sql(text: str) -> str:
    return f"""regexp_replace({text}, '(?s)^"(.*)"\\z', '\\1')"""


def _after_sql(text: str, mark: str) -> str:
    return _strip_sql(f"CASE WHEN contains({text}, '{mark}') THEN substr({text}, strpos({text}, '{mark}') + {len(mark)}) ELSE {text} END")


_PASSAGES = ", ".join(f"'{p}'" for p in ["Passage:", "Passage 1:", "Passage 2:", "Passage 3:"])


def _unlined_sql(text: str) -> str:
    return f"array_to_string(list_filter(string_split({text}, chr(10)), lambda l: {_strip_sql('l')} NOT IN ({_PASSAGES})), chr(10))"


_BULLET_RE = r"^[ \t]*[-*•][ \t]+"


def _bullets_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '{_BULLET_RE}')), "
        f"lambda l: regexp_replace(l, '{_BULLET_RE}', '')), chr(10))"
    )


def _qa_sql(source: str) -> str:
    """``source`` has ``(id, segment_id, text, qa)`` and more; replaces ``qa``."""
    part_q, part_a = _strip_sql("split_part(p, 'Answer:', 1)"), _after_sql("p", "Answer:")
    pairs = (
        r"list_filter(list_transform(regexp_split_to_array(qa, '(?:^|\n)[ \t]*Question:')[2:], lambda p: "
        f"CASE WHEN contains(p, 'Answer:') AND {part_q} <> '' AND {part_a} <> '' "
        f"THEN 'Question: ' || {part_q} || chr(10) || 'Answer: ' || {part_a} END), lambda p: p IS NOT NULL)"
    )
    ranked = (
        "list_sort(list_transform(pairs, lambda p, i: {'h': md5('qa:' || id || ':' || segment_id || ':' || (i - 1)), 'p': p}))"
    )
    limit = f"greatest(1, floor({tokens_sql('text')} / 150)::INTEGER)"
    return (
        f"SELECT * EXCLUDE (pairs) REPLACE (text || chr(10) || chr(10) || array_to_string(list_transform(({ranked})[1:{limit}], "
        f"lambda r: r.p), chr(10) || chr(10)) AS qa) FROM (SELECT *, {pairs} AS pairs FROM ({source})) WHERE len(pairs) > 0"
    )


def _post_sql(name: str) -> str:
    """Dressed answers of a task, cleaned and filtered like the operator does."""
    task = req.TASKS[name]
    out = f"SELECT id, segment_id, text, {name} AS a, {tokens_sql(name)} AS rephrased_segment_token_count FROM ({_dressed_sql(name)})"
    out = f"SELECT * FROM ({out}) WHERE rephrased_segment_token_count <= {task.max_output_tokens - 2}"
    out = f"SELECT * REPLACE ({markdown_sql('a')} AS a) FROM ({out})"
    if name == "diverse_qa":
        out = f"SELECT * RENAME (qa AS a) FROM ({_qa_sql(f'SELECT * RENAME (a AS qa) FROM ({out})')})"
    elif name == "distill":
        out = f"SELECT *, 1 AS substring FROM ({out}) WHERE starts_with(a, 'Paraphrased Text:')"
        out = f"SELECT * REPLACE ({_unquote_sql(_after_sql('a', 'Paraphrased Text:'))} AS a) FROM ({out})"
    elif name == "extract_knowledge":
        out = f"SELECT * REPLACE ({_unlined_sql('a')} AS a) FROM ({out})"
    else:
        out = f"SELECT * REPLACE ({_bullets_sql('a')} AS a) FROM ({out})"
    out = f"SELECT *, {tokens_sql('a')} AS rephrased_document_token_count FROM ({out})"
    return f"SELECT * RENAME (a AS {name}) FROM ({out}) WHERE rephrased_document_token_count >= {task.min_response_tokens}"


@query(
    "max_response_tokens",
    f"SELECT * FROM (SELECT id, segment_id, {tokens_sql('diverse_qa')} AS rephrased_segment_token_count FROM ({_dressed_sql('diverse_qa')})) WHERE rephrased_segment_token_count <= 250",
)
def max_response_tokens(spark, sf_dir):
    return req.max_response_tokens(_answered(spark, sf_dir, "diverse_qa"), "diverse_qa", 250).drop("text", "diverse_qa")


_ALL_DRESSED_SQL = " UNION ALL ".join(f"SELECT id, segment_id, '{n}' AS task, {n} AS answer FROM ({_dressed_sql(n)})" for n in _DRESSED_SQL)


@query("strip_markdown", f"SELECT id, segment_id, task, {markdown_sql('answer')} AS answer FROM ({_ALL_DRESSED_SQL})")
def strip_markdown(spark, sf_dir):
    paired = req.join_responses(_segments(spark, sf_dir), _responses(spark, sf_dir), "response")
    kinds = F.array(*[F.struct(F.lit(n).alias("task"), _dressed(n).alias("answer")) for n in _DRESSED_SQL])
    dressed = paired.select("id", "segment_id", F.explode(kinds).alias("k")).select("id", "segment_id", "k.*")
    return modify_column(dressed, "answer", md.strip_markdown)


@query("substring_filter", f"SELECT id, segment_id, distill, 1 AS substring FROM ({_dressed_sql('distill')}) WHERE starts_with(distill, '**Para')")
def substring_filter(spark, sf_dir):
    return req.substring_filter(_answered(spark, sf_dir, "distill"), "distill", "**Para", "prefix").drop("text")


@query("slice_after", f"SELECT id, segment_id, {_after_sql('distill', 'Text:**')} AS distill FROM ({_dressed_sql('distill')})")
def slice_after(spark, sf_dir):
    return modify_column(_answered(spark, sf_dir, "distill"), "distill", lambda c: md.slice_after(c, left="Text:**")).drop("text")


_QUOTED_SQL = "CASE WHEN id % 2 = 0 THEN '\"' || text || chr(10) || '\"' ELSE '\"' || text END"


@query("strip_quotes", f"SELECT id, segment_id, {_unquote_sql(_QUOTED_SQL)} AS text FROM ({_SEGMENTS_SQL})")
def strip_quotes(spark, sf_dir):
    quoted = F.when(F.col("id") % 2 == 0, F.concat(F.lit('"'), "text", F.lit('\n"'))).otherwise(F.concat(F.lit('"'), "text"))
    return modify_column(_segments(spark, sf_dir).withColumn("text", quoted), "text", md.strip_quotes)


@query("remove_lines", f"SELECT id, segment_id, {_unlined_sql('extract_knowledge')} AS extract_knowledge FROM ({_dressed_sql('extract_knowledge')})")
def remove_lines(spark, sf_dir):
    return modify_column(
        _answered(spark, sf_dir, "extract_knowledge"), "extract_knowledge", lambda c: md.remove_lines(c, md.PASSAGE_LINES)
    ).drop("text")


@query("qa_postprocess", f"SELECT id, segment_id, qa AS diverse_qa FROM ({_qa_sql(f'SELECT id, segment_id, text, ' + markdown_sql('diverse_qa') + f' AS qa FROM ({_dressed_sql("diverse_qa")})')})")
def qa_postprocess(spark, sf_dir):
    stripped = modify_column(_answered(spark, sf_dir, "diverse_qa"), "diverse_qa", md.strip_markdown)
    return req.qa_postprocess(stripped).drop("text")


@query("list_postprocess", f"SELECT id, segment_id, {_bullets_sql('knowledge_list')} AS knowledge_list FROM ({_dressed_sql('knowledge_list')})")
def list_postprocess(spark, sf_dir):
    return modify_column(_answered(spark, sf_dir, "knowledge_list"), "knowledge_list", md.bulleted_lines).drop("text")


@query(
    "min_response_tokens",
    f"SELECT * FROM (SELECT id, segment_id, {tokens_sql('distill')} AS rephrased_document_token_count FROM ({_dressed_sql('distill')})) WHERE rephrased_document_token_count >= 50",
)
def min_response_tokens(spark, sf_dir):
    return req.min_response_tokens(_answered(spark, sf_dir, "distill"), "distill", 50).drop("text", "distill")


def _post_query(name: str):
    @query(f"post_{name}", _post_sql(name))
    def post(spark, sf_dir):
        return req.POST[name](_answered(spark, sf_dir, name))

    return post


for _name in _DRESSED_SQL:
    _post_query(_name)


@query(
    "all_tasks",
    " UNION ALL ".join(
        f"SELECT '{n}' AS task, id, segment_id, {n} AS output, rephrased_segment_token_count, rephrased_document_token_count FROM ({_post_sql(n)})"
        for n in _DRESSED_SQL
    ),
)
def all_tasks(spark, sf_dir):
    return req.all_tasks({n: _answered(spark, sf_dir, n) for n in _DRESSED_SQL})
