"""Clean-up of generated text, as column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gleaner.functions.text import let

# Fixed values: (pattern, replacement), applied in this order.
MARKDOWN = [
    (r"`([^`\n]+)`", "$1"),
    (r"\*\*([^*\n]+)\*\*", "$1"),
    (r"__([^_\n]+)__", "$1"),
    (r"\*([^* \n][^*\n]*)\*", "$1"),
    (r"\[([^\]\n]*)\]\([^)\n]*\)", "$1"),
    (r"(?md)^#{1,6} +", ""),
    (r"(?md)^(?:-{3,}|\*{3,}|_{3,})[ \t]*$", ""),
]
BLANKS = " \t\n\r\f"
BULLET = r"^[ \t]*[-*•][ \t]+"
PASSAGE_LINES = ["Passage:", "Passage 1:", "Passage 2:", "Passage 3:"]
PARAPHRASE = "Paraphrased Text:"
QUESTION_START = r"(?:^|\n)[ \t]*Question:"
ANSWER = "Answer:"


def strip_markdown(text: Column) -> Column:
    """Drop the marks for code, bold, italic, links, headings and rules; keep their text."""
    for pattern, replacement in MARKDOWN:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def has_substring(text: Column, substring: str, position: str = "any") -> Column:
    """Is ``substring`` at the ``prefix``, the ``suffix``, or ``any`` place?"""
    tests = {"prefix": text.startswith, "suffix": text.endswith, "any": text.contains}
    if position not in tests:
        raise ValueError(f"position must be one of {sorted(tests)}")
    return tests[position](substring)


def slice_after(text: Column, left: str | None = None, right: str | None = None, strip: bool = True) -> Column:
    """Text after the first ``left`` and before the next ``right``, marks excluded; a mark not found cuts nothing."""
    if left is not None:
        at = F.locate(left, text)
        text = F.when(at > 0, F.substring(text, at + len(left), F.length(text))).otherwise(text)
    if right is not None:
        text = F.substring_index(text, right, 1)
    return strip_blanks(text) if strip else text


def strip_quotes(text: Column) -> Column:
    """Drop quotation marks that enclose the whole text."""
    return F.regexp_replace(text, r'(?s)^"(.*)"\z', "$1")


def remove_lines(text: Column, patterns: list[str]) -> Column:
    """Drop lines that, blanks aside, equal one of ``patterns``."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: ~strip_blanks(line).isin(patterns))
    return F.array_join(lines, "\n")


def bulleted_lines(text: Column) -> Column:
    """Keep bulleted lines only, without bullet and indentation."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(BULLET))
    return F.array_join(F.transform(lines, lambda line: F.regexp_replace(line, BULLET, "")), "\n")


def question_answer_pairs(text: Column) -> Column:
    """Array of ``Question: …\\nAnswer: …`` texts; a question without an answer is left out."""

    def pair(part: Column) -> Column:
        question = strip_blanks(F.substring_index(part, ANSWER, 1))
        answer = slice_after(part, left=ANSWER)
        ok = part.contains(ANSWER) & (question != "") & (answer != "")
        return F.when(ok, F.concat(F.lit("Question: "), question, F.lit("\nAnswer: "), answer))

    parts = let(F.split(text, QUESTION_START, -1), lambda s: F.slice(s, F.lit(2), F.size(s)))
    return F.filter(F.transform(parts, pair), lambda p: p.isNotNull())
