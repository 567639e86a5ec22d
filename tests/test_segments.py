import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions.text import token_count
from gleaner.operators import requests as req, segments


def reference_chunks(text, high, low):
    """Greedy packing in plain Python."""
    chunks, lines, total = [], None, 0
    for line in text.split("\n"):
        n = len([w for w in line.replace("\t", " ").split(" ") if w])
        if n > high:
            continue
        if lines is None:
            lines, total = [line], n
        elif total + n + 1 <= high:
            lines, total = [*lines, line], total + n + 1
        else:
            chunks.append(("\n".join(lines), total))
            lines, total = [line], n
    if lines is not None:
        chunks.append(("\n".join(lines), total))
    return [c for c in chunks if c[1] >= low]


def texts():
    rng = random.Random(4)
    made = ["\n".join(" ".join("w" * rng.randrange(0, 12)) for _ in range(rng.randrange(0, 15))) for _ in range(40)]
    return made + ["", "\n\n\n", "a b c d e f g h", "a b c\nd e f g", "a b c d e f g h i j k", "a b\n\nc d\n"]


@pytest.mark.parametrize("high, low", [(8, 3), (8, 0), (1, 1), (0, 0), (100, 8)])
def test_chunks_equal_plain_packing_and_the_line_by_line_path(spark, high, low):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "id bigint, text string").repartition(3)
    fused = segments.chunk_documents(docs, high, low)
    got = [tuple(r) for r in fused.select("id", "segment_id", "text", "segment_token_count").orderBy("id", "segment_id").collect()]
    expected = [(i, s, *c) for i, t in rows for s, c in enumerate(reference_chunks(t, high, low))]
    assert got == expected
    lines = segments.line_token_filter(segments.split_lines(docs), high)
    stock = segments.greedy_join(lines, high)
    assert segments.chunk_equivalence(stock, segments.chunk_documents(docs, high, 0)).count() == 0


def test_nothing_left_keeps_the_schema(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], "id bigint, text string, other string")
    out = segments.chunk_documents(docs, 2, 1)
    assert out.count() == 0
    assert out.columns == ["id", "text", "other", "segment_id", "segment_token_count"]


def test_equivalence_finds_differences(spark):
    schema = "id bigint, segment_id int, text string, segment_token_count bigint"
    a = spark.createDataFrame([(1, 0, "x", 1), (1, 1, "y", 1), (2, 0, None, 0)], schema)
    b = spark.createDataFrame([(1, 0, "x", 1), (1, 1, "z", 1), (2, 0, None, 0), (3, 0, "q", 1)], schema)
    assert [(r["id"], r["segment_id"]) for r in segments.chunk_equivalence(a, b, limit=10).collect()] == [(1, 1), (3, 0)]


def test_own_token_counts(spark):
    docs = spark.createDataFrame([(1, "abc\nde\nf")], "id bigint, text string")
    by_letter = lambda lines: F.transform(lines, lambda x: F.length(x).cast("bigint"))
    rows = segments.chunk_documents(docs, 4, 1, line_counts=by_letter).orderBy("segment_id").collect()
    assert [(r["text"], r["segment_token_count"]) for r in rows] == [("abc", 3), ("de\nf", 4)]


def test_ids_are_added_once_and_unique(spark):
    docs = spark.createDataFrame([(f"u{i}",) for i in range(50)], "url string").repartition(5)
    out = segments.add_document_id(docs, "url")
    assert sorted(r["id"] for r in out.collect()) == list(range(50))
    assert segments.add_document_id(out, "url") is out


def test_task_limits():
    for task in req.TASKS.values():
        assert task.max_response_tokens == task.max_output_tokens - 2
        assert 0 < req.prompt_budget(task) < task.max_input_tokens - 2


def test_requests_use_each_tasks_own_segments(spark):
    text = "\n".join(" ".join(f"w{i}" for i in range(100)) for _ in range(30))
    docs = spark.createDataFrame([(1, text), (2, "too short")], "id bigint, text string")
    rows = req.requests_for_tasks(docs).collect()
    assert {r["id"] for r in rows} == {1}
    counts = {t: sum(r["task"] == t for r in rows) for t in req.TASKS}
    assert counts["distill"] < counts["extract_knowledge"] < counts["diverse_qa"]
    assert len({r["request_id"] for r in rows}) == len(rows)
    assert all("{text}" not in r["user_prompt"] for r in rows)


def test_limits_are_inclusive(spark):
    df = spark.createDataFrame([("a b c",), ("a b c d",)], "x string")
    assert [r["x"] for r in req.max_response_tokens(df, "x", 3).collect()] == ["a b c"]
    assert [r["x"] for r in req.min_response_tokens(df, "x", 4).collect()] == ["a b c d"]
    assert df.select(token_count(F.col("x"))).first()[0] == 3
